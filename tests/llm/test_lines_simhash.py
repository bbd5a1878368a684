import random

import numpy as np
import pytest
import xxhash

from brute import components, documents, dropped_lines, prose
from newstape.llm import components as cc, lines, simhash

LINE = "This line is long enough to count, and stands in many texts."


def test_components_of_a_chain_a_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1100)]
    links = chain + star + [(5, 5), (1000, 1001), (2001, 2000), (3000, 3000)]
    random.Random(3).shuffle(links)
    out = {r.node: r.root for r in cc.components(spark.createDataFrame(links, "u long, v long").repartition(7)).collect()}
    assert out == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}, 2000: 2000, 2001: 2000}


def test_components_of_nothing(spark):
    assert cc.components(spark.createDataFrame([], "u long, v long")).count() == 0


def line_rows():
    rows = [(k, f"own line {k} {prose(k, 12)}\n  {LINE.upper() if k % 2 else LINE}\t\nshort") for k in range(6)]
    rows += [(10, LINE + "\n" + LINE), (11, None), (12, ""), (13, "\n\n"), (None, LINE), (14, "é" * 39), (15, "É" * 40)]
    rows += [(20 + k, "\n".join([prose(900, 20)] * (k + 1))) for k in range(5)]
    rows += [(3, rows[3][1]), (30, prose(31, 9) * 3000 + "\n" + LINE)]
    rows += [(40 + k, "ü" * 40) for k in range(5)] + [(50 + k, "ü" * 39) for k in range(5)]
    return rows


@pytest.mark.parametrize("parts", [1, 16])
def test_lines_equal_brute_force(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = line_rows()
        out = lines.drop_lines(documents(spark, rows).repartition(3))
        got = sorted((str(r.doc_id), r.text or "", r._n_lines, r._n_dropped) for r in out.collect())
        assert out.columns[:9] == ["doc_id", "text", "lang", "source", "n_chars", "_id", "_h", "key", "root"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == sorted((str(k), *x) for (k, _), x in zip(rows, dropped_lines(rows)))


def test_a_hot_line_spans_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, LINE + "\n" + prose(k, 15)) for k in range(400)] + [(7, LINE)] * 30
        out = lines.drop_lines(documents(spark, rows))
        got = sorted((r.doc_id, r.text, r._n_lines, r._n_dropped) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == sorted((k, *x) for (k, _), x in zip(rows, dropped_lines(rows)))


def test_lines_of_an_empty_table(spark):
    assert lines.drop_lines(documents(spark, [])).count() == 0
    assert lines.line_bitmaps(documents(spark, [(1, "a")])).count() == 0


def plain_print(text, width=3):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    some = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rows = []
    for k in range(25):
        words = prose(k, 120).split()
        for c in range(8):
            rows.append((len(rows), " ".join(words)))
            words[random.Random(k * 31 + c).randrange(len(words))] = "other"
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "a b c d")]
    rows += [(None, rows[0][1]), (0, rows[0][1]), (907, prose(5, 40_000)), (None, "alone with no id"), (None, "alone with no id")]
    prints = [plain_print(t) for _, t in rows]
    group = components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    low = {}
    for (k, _), g in zip(rows, group):
        if k is not None:
            low[g] = min(low.get(g, k), k)
    want = sorted((str(k), p, str(low.get(g))) for (k, _), p, g in zip(rows, prints, group))
    out = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in out) == want
    assert len(set(group)) < len(rows) - 20  # some do link


def test_pigeonring_finds_every_pair(spark):
    r = np.random.default_rng(1)
    prints = r.integers(0, 2**63, 60, dtype=np.uint64)
    for a in range(64):  # every pair of bits, over all segments
        prints = np.append(prints, prints[a % 60] ^ np.uint64(1 << a) ^ np.uint64(1 << int(r.integers(64))))
    rows = [(i, int(p.view(np.int64))) for i, p in enumerate(prints)]
    found = cc.components(simhash.links(spark.createDataFrame(rows, "i long, fp long"))).collect()
    root = {x.node: x.root for x in found}
    group = components(len(prints), lambda i, j: int(prints[i] ^ prints[j]).bit_count() <= 2)
    pair = lambda i: root.get(rows[i][1], rows[i][1])
    assert all((pair(i) == pair(j)) == (group[i] == group[j]) for i in range(len(rows)) for j in range(i))


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
