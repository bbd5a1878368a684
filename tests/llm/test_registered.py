"""The registered queries without SQL against plain Python, on the whole smallest sample."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from brute import components, prefix_distance, repeated_bytes
from newstape.llm import queries
from newstape.llm.tokens import default_path


@pytest.fixture(scope="module")
def docs(spark, sample):
    rows = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op1(spark):
    sample = "/root/testdata/sf0.01"  # the smallest one holds no secrets
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()}
    assign = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    kinds = [("assign", assign, lambda m: len(m[1]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    got = {r.doc_id: r for r in queries.op1_secrets(spark, sample).collect()}
    assert set(got) == set(docs)
    some = 0
    for k, text in docs.items():
        found = [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for i, (kind, rule, good) in enumerate(kinds) for m in rule.finditer(text) if good(m)]
        named = [x for *_, x in sorted(found)]
        r = got[k]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(kind) for x in named) for kind, *_ in kinds]
        assert r.base_sha256 == sha(",".join(named))
        listed = r.spans.split(",") if r.spans else []
        assert [x for x in listed if not x.startswith("learned")] == named
        some += len(named)
    assert some > 5


def test_op4(spark, sample, docs):
    got = {r.doc_id: r for r in queries.op4_suffix_dedup(spark, sample).collect()}
    ids, bodies = list(docs), [t.encode() for t in docs.values()]
    assert set(got) == set(ids)
    for k, body, flags in zip(ids, bodies, repeated_bytes(bodies, 200)):
        kept = bytes(b for b, gone in zip(body, flags) if not gone)
        spans = sum(a and not b for a, b in zip(flags, [False, *flags]))
        assert tuple(got[k]) == (k, len(body), sum(flags), spans, sha(kept))
    assert sum(r.n_removed for r in got.values()) > 1000


def test_op5(spark):
    sample = "/root/testdata/sf0.01"  # the smallest one has 19 held-out labels
    got = {r.doc_id: r for r in queries.op5_quality(spark, sample).collect()}
    assert set(got) == {r.doc_id for r in spark.read.parquet(f"{sample}/documents.parquet").select("doc_id").collect()}
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sample}/labels.parquet").collect()}
    held = [got[k].predicted == q for k, q in labels.items() if k in got and got[k].held_out and q is not None]
    assert len(held) > 50 and sum(held) >= 0.9 * len(held)


def words_of(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", text.lower())


def test_op7(spark, sample, docs):
    items = {r.item_id: words_of(r.text or "") for r in spark.read.parquet(f"{sample}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in queries.op7_decontaminate(spark, sample).collect()}
    texts = {k: words_of(t) for k, t in docs.items()}
    for (k, i), r in got.items():
        limit = int((1 - 0.8) * len(items[i]) + 1e-9)
        window = texts[k][r.first_word : r.first_word + len(items[i]) + limit]
        assert r.edits <= limit and prefix_distance(items[i], window) == r.edits
        assert prefix_distance(items[i], texts[k][r.first_word : r.first_word + r.n_words]) <= r.edits
    joined = {k: f" {' '.join(t)} " for k, t in texts.items()}
    exact = {(k, i) for k, t in joined.items() for i, x in items.items() if x and f" {' '.join(x)} " in t}
    assert exact <= set(got) and all(got[p].edits == 0 for p in exact) and exact


def test_op9(spark, sample, docs):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(default_path()).encode
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in queries.op9_pack(spark, sample).collect():
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(docs)
    for k, text in docs.items():
        ids = [*encode(text, add_special_tokens=False).ids, 0]
        cut = [(n, at, min(2048, len(ids) - at)) for n, at in enumerate(range(0, len(ids), 2048))]
        want = [(n, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())) for n, at, size in cut]
        assert sorted(by_doc[k]) == want
    for rows in by_sequence.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048


def test_op10(spark, sample, docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    prints = {}
    for k, text in docs.items():
        words = re.findall("[^\x20\x09-\x0d]+", text.translate(low))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    root = components(len(ids), lambda i, j: (prints[ids[i]] ^ prints[ids[j]]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, sample).collect()}
    assert got == {k: (f"{prints[k]:016x}", ids[root[i]]) for i, k in enumerate(ids)}
