"""First-fit decreasing against a plain search, and packings against the tokenizer's own ids."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import documents, prose

from newstape.llm import ffd, queries
from newstape.llm.tokens import default_path


def plain_first_fit(lengths, capacity):
    rooms, out = [], []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = next((i for i, room in enumerate(rooms) if room >= lengths[k]), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
            out.append([])
        rooms[at] -= lengths[k]
        out[at].append(k)
    return out


@pytest.mark.parametrize("seed", range(30))
def test_first_fit_and_completion(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 64, 4096])
    lengths = np.array([r.randint(1, r.choice([capacity, max(1, capacity // 5)])) for _ in range(r.randint(1, 400))], np.int64)
    found = ffd.first_fit(lengths, capacity)
    assert found == plain_first_fit(lengths.tolist(), capacity)
    for least in (1, 3):
        parts = ffd.completed(found, lengths, capacity, least)
        held = defaultdict(list)
        for s in parts:
            size = sum(n for _, _, n in s)
            assert s and 0 < size <= capacity and ffd.padding(size, capacity) < least
            for k, begin, n in s:
                held[k].append((begin, n))
        for k, n in enumerate(lengths.tolist()):
            at = 0
            for begin, size in sorted(held[k]):
                assert begin == at and size > 0
                at += size
            assert at == n


def whole(table, got, ids_of, capacity=4096):
    """Every id of every document once, sequences without gaps."""
    expected = defaultdict(list)
    for k, text in table:
        expected[k].append(ids_of(text))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, total, sequence, offset in got:
        by_doc[doc].append((start, length, crc, total))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(expected)
    for doc, rows in by_doc.items():
        assert sum(n for _, n, _, _ in rows) == sum(map(len, expected[doc]))
        for ids in expected[doc] if len(expected[doc]) == 1 else []:
            at = 0
            for start, length, crc, total in sorted(rows):
                assert (start, total) == (at, len(ids))
                assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
                at += length
    for rows in by_sequence.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= capacity and ffd.padding(at, capacity) == 0


@pytest.fixture(scope="module")
def ids_of():
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(default_path()).encode
    return lambda text: [*encode(text or "", add_special_tokens=False).ids, ffd.END]


def test_operator(spark, ids_of):
    table = [(k, prose(k, n)) for k, n in enumerate([0, 1, 3, 40, 900, 2500, 70, 800, 800, 12_000])]
    table += [(None, "no id"), (50, None), (51, ""), (52, "twice"), (52, "twice"), (53, "é ß 漢字 <|endoftext|>"), (54, "Same Text"), (54, "other")]
    docs = documents(spark, table).repartition(3)
    for group in (4, 4096):
        found = ffd.packed(docs, group=group)
        assert found.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        rows = [(r[0], r[1], r[2], zlib.crc32(r[3]), *r[4:]) for r in found.collect()]
        whole(table, rows, ids_of)
    assert ffd.packed(docs.limit(0)).count() == 0


def test_registered_query(spark, sample, ids_of):
    found = queries.op12_pack(spark, sample)
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()
    whole(docs, [tuple(r) for r in found.collect()], ids_of)
