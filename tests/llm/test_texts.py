"""Suffix dedup, decontamination, quality, secrets and packing against brute force and held-out labels."""

import random
import re
import zlib

import numpy as np
import pytest

from brute import documents, prefix_distance, prose, repeated_bytes
from newstape.llm import decontam, packing, quality, secretscan, suffixes, tokens


def suffix_rows():
    shared, edge = prose(77, 60), prose(78, 34)
    rows = [(k, prose(k, 50) + " " + shared[k : k + 260 + k] + " " + prose(100 + k, 50)) for k in range(30)]
    rows += [(40, "é" * 300), (41, "x" + "é" * 200), (42, None), (43, ""), (44, "a" * 199), (45, "a" * 201), (46, "abc" * 200)]
    rows += [(50, rows[0][1]), (50, rows[0][1]), (None, rows[5][1]), (51, prose(9, 30) + edge), (52, edge[:210]), (53, edge[:199])]
    rows += [(60, prose(60, 40_000))] + [(61, rows[-1][1] + prose(60, 500)[1000:1400])]
    return rows


@pytest.mark.parametrize("many", [suffixes.MANY, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(suffixes, "MANY", many)
    rows = suffix_rows()
    raw = [(t or "").encode() for _, t in rows]
    want = []
    for (k, _), t, flags in zip(rows, raw, repeated_bytes(raw, 200)):
        want.append((str(k), bytes(b for b, gone in zip(t, flags) if not gone), sum(
            gone and not (i and flags[i - 1]) for i, gone in enumerate(flags))))
    out = suffixes.remove_repeats(documents(spark, rows).repartition(3)).collect()
    assert sorted((str(r.doc_id), bytes(r._kept), len(r._spans or [])) for r in out) == sorted(want)


def test_repeats_of_an_empty_table(spark):
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0


def edited(words, n, seed):
    r = random.Random(seed)
    words = list(words)
    for _ in range(n):
        at = r.randrange(len(words))
        kind = r.randrange(3)
        if kind == 0:
            words[at] = f"new{r.randrange(999)}"
        elif kind == 1:
            words.insert(at, f"more{r.randrange(999)}")
        else:
            del words[at]
    return words


def test_decontamination_equals_brute_force(spark):
    items = [(k, prose(500 + k, 12 + 5 * k)) for k in range(8)] + [(20, None), (21, " .. "), (22, "the"), (23, "Only Three-words"), (3, prose(503, 27))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for k in range(64):
        words = items[k % 8][1].split()
        allowed = int(0.2 * len(words))
        inner = edited(words, (k // 8) % (allowed + 1), k)
        rows.append((k, prose(k, 40) + " " + " ".join(inner) + " " + prose(1000 + k, 40)))
    rows += [(70, items[5][1].upper().replace(" ", "!! ")), (71, None), (72, ""), (73, "only three WORDS"), (None, items[2][1])]
    rows += [(74, prose(74, 250_000) + " " + items[7][1]), (75, items[4][1]), (75, items[4][1])]
    split = lambda t: re.findall("[a-z0-9\x80-\U0010ffff]+", (t or "").lower())
    want = set()
    for k, t in rows:
        doc = split(t)
        for i, x in items:
            item = split(x)
            limit = int((1 - 0.8) * len(item) + 1e-9)
            first = set(item[: limit + 1])
            if item and any(doc[a] in first and prefix_distance(item, doc[a : a + len(item) + limit]) <= limit for a in range(len(doc))):
                want.add((k, i))
    found = decontam.contaminated(documents(spark, rows), bench).collect()
    got = {(None if r._id == -(2**63) else r._id, r.item_id) for r in found}
    assert got <= want and len(got) == len(found)
    assert len(got) >= 0.98 * len(want) and len(want) > 60
    exact = {(k, i) for k, i in want if k in (70, 73, 74, 75, None)}
    assert exact <= got


def test_decontamination_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(documents(spark, [(1, "a b")]), none).count() == 0
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontam.contaminated(documents(spark, []), bench).count() == 0


@pytest.mark.parametrize("n", [40, 400, 1500])
def test_walks_reach_the_recall_on_other_trials(n):
    """Edited copies inside other words, edits of other kinds and places than those that calibrate."""
    items = [np.random.default_rng(k).integers(1, 2**62, n).astype(np.uint64) for k in range(12)]
    shape = decontam.calibrated(decontam.class_of(n, 0.8), items, 0.99)
    r = random.Random(n)
    trials, met = 100 if n < 1000 else 50, 0
    every = list(range(shape.walks))
    own = [decontam.walk_keys(x, np.array([0]), np.array([n]), shape, every)[:, 0] for x in items]
    for k in range(trials):
        words = [w if isinstance(w, int) else 2**62 + zlib.crc32(w.encode()) for w in edited(items[k % 12].tolist(), int(0.2 * n), 7 * k)]
        text = np.array([*(r.randrange(2**62) for _ in range(5)), *words, *(r.randrange(2**62) for _ in range(50))], np.uint64)
        starts = np.arange(5, 15)
        found = decontam.walk_keys(text, starts, np.full(len(starts), len(text)), shape, every)
        met += bool((found == own[k % 12][:, None]).any())
    assert met >= 0.97 * trials and shape.walks > 1


def test_a_recall_out_of_reach_is_an_error(monkeypatch):
    monkeypatch.setattr(decontam, "MOST_WALKS", 3)
    with pytest.raises(ValueError, match="walks"):
        decontam.calibrated(decontam.class_of(400, 0.8), [np.arange(1, 401, dtype=np.uint64)], 0.99)


def test_quality_separates_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs, labels)
    held = quality.score(docs.where(quality.remainder() == 0), model).join(labels, "doc_id").toPandas()
    assert ((held._score >= 0.3) == (held.quality == 1)).mean() > 0.95


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "x" * 2_000_000), (3, "again"), (3, "again"), (4, "\n\n\n")]
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    model = quality.train(documents(spark, rows), labels)
    out = quality.score(documents(spark, rows), model).collect()
    assert len(out) == len(rows) and all(0 <= r._score <= 1 for r in out)
    assert quality.score(documents(spark, []), model).count() == 0
    assert quality.train(documents(spark, []), labels.limit(0)).raw is not None


def test_pair_term_equals_the_double_sum():
    r = np.random.default_rng(0)
    model = quality.Machine(0.5, r.normal(size=quality.BUCKETS), r.normal(size=(quality.BUCKETS, quality.RANK)))
    idx, val = quality.features("some words, and Some more words: some", (("size", 3), ("none", None)))
    slow = 0.5 + (model.w[idx] * val).sum() + sum(
        model.v[a] @ model.v[b] * x * y for i, (a, x) in enumerate(zip(idx, val)) for b, y in list(zip(idx, val))[:i])
    assert model.raw(idx, val, np.array([0]))[0] == pytest.approx(slow)


def test_secret_rules_and_learned_spans(spark):
    r = random.Random(4)
    token = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows = []
    for k in range(300):
        kind = k % 3
        secret = (f'token = "{token(40, "0123456789abcdef")}"', token(36, "0123456789abcdef"), str(r.randrange(10**16)).zfill(16))[kind]
        rows.append((k, f"{prose(k, 20)} {secret} {prose(k + 1, 9)}"))
    planted = f"auth: {token(40, b62)}1"
    rows += [(900, f"words before {planted} words after"), (901, None), (902, ""), (903, 'Ähm PASSWORD: "s3cret-value" ende'),
             (904, "AKIA" + "A1" * 8 + " AKIASHORT"), (905, "token=abc"), (None, "api_key=abcdef"), (906, "x" * 3_000_000 + " secret=abcdef1")]
    docs = documents(spark, rows)
    network = secretscan.train(docs)
    out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secretscan.scan(docs, network).collect()}
    assert out[903] == [("assign", 4, 27)] and out[904] == [("access", 0, 20)] and out[905] == [] == out[901] == out[902]
    assert out[None] == [("assign", 0, 14)] and out[906] == [("assign", 3_000_001, 3_000_015)]
    assert all(out[k][0][0] == "assign" for k in range(0, 300, 3))
    numbers = sum(any(s[0] == "learned" for s in out[k]) for k in range(2, 300, 3))
    assert numbers <= 5  # card numbers are no secrets
    at = rows[300][1].index(planted) + 6
    assert ("learned", at, at + 41) in out[900]
    assert secretscan.scan(documents(spark, []), network).count() == 0


def test_token_ids_are_the_tokenizers():
    own = tokens.Encoder()
    texts = ["", " ", "Don't 'sand IT'S 12,345 (a)b", "<|endoftext|> hi", "É é ñ ß Straße", "é combining", "\x01 a\x85b",
             "İstanbul ΣΑΣ", "½ ²x", "日本語 text", "’s “quoted”—dash", prose(1, 3000), "a_b __ c"]
    want = own.whole.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        assert [x.tolist() for x in own.encode(texts)] == [w.ids for w in want]


@pytest.mark.parametrize("seed", range(6))
def test_packing_holds_every_length(seed):
    r = np.random.default_rng(seed)
    some = r.integers(1, [60, 2049, 1200, 700, 1100, 300][seed], 400)
    if seed % 2:
        some = np.where(r.random(400) < 0.3, 1000, some)
    out = packing.pack(some, 2048)
    assert sorted(x for s in out for x in s) == sorted(some.tolist()) and max(map(sum, out)) <= 2048
    assert packing.lower_bound(some, 2048) <= len(out) <= len(packing.best_fit(some, 2048))


def test_bin_completion_beats_best_fit():
    assert len(packing.best_fit(np.array([4, 3, 3, 2, 2, 2]), 8)) == 3
    assert len(packing.pack(np.array([4, 3, 3, 2, 2, 2]), 8)) == 2


def fewest(lengths, capacity):
    """The least number of sequences, by trying every place for every piece."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[i]}):
            k = rooms.index(room)
            go(i + 1, [*rooms[:k], room - lengths[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_search_without_bounds_is_exact():
    r = random.Random(0)
    for _ in range(150):
        capacity = r.choice([10, 20, 50])
        some = [r.randint(1, capacity) if r.random() < 0.3 else r.randint(max(1, capacity // 6), capacity // 2) for _ in range(r.randint(1, 10))]
        out = packing.pack(np.array(some), capacity, None, None, None)
        assert sorted(x for s in out for x in s) == sorted(some) and max(map(sum, out)) <= capacity
        assert len(out) == fewest(some, capacity)


def test_packed_pieces(spark):
    own = tokens.Encoder()
    rows = [(k, prose(k, 10 + 37 * k)) for k in range(20)] + [(30, None), (31, ""), (None, "word"), (1, prose(1, 47)), (1, prose(1, 47)), (40, prose(2, 5000))]
    out = packing.packed(documents(spark, rows), block=10).collect()
    want, have, filled = [], [], {}
    for k, t in rows:
        ids = [*own.whole.encode(t or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            some = np.array(ids[at : at + 2048], "<u4")
            want.append((str(k), p, at, len(some), zlib.crc32(some.tobytes())))
    for r in out:
        have.append((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(have) == sorted(want)
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(documents(spark, [])).count() == 0
