"""The manifest against a plain version: every level, proof and fold."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newstape.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _hash string, leaf int, root string"


def leaf(row, extra=0):
    k, text, lang, source, n = row
    n = None if n is None else n + extra
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (k, source, lang, n, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][k : k + 2])) for k in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, at):
    out = []
    for nodes in levels[:-1]:
        out.append((nodes[at ^ 1] if at ^ 1 < len(nodes) else None, at & 1))
        at >>= 1
    return out


def plain(rows, tampered):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), leaf(row, 1) if tampered(row[0]) else leaf(row), row[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    crown = tree([trees[g][-1][0] for g in order])
    root = crown[-1][0] if order else None
    out = []
    for top, g in enumerate(order):
        for at, (_, _, own, claim, k) in enumerate(sorted(groups[g])):
            steps = path(trees[g], at) + path(crown, top)
            for other, right in steps:
                claim = H(claim) if other is None else H(other + claim if right else claim + other)
            out.append((k, own, trees[g][-1][0], root, H("".join(o for o, _ in steps if o)), claim, claim == root))
    return out


def rows_of(n):
    rows = [(k * 3 % 101, f"text {k} é\n", ["en", "de", None, "ü", ""][k % 5 if k % 3 else 0], f"s{k % 4}" if k % 7 else None, k if k % 6 else None) for k in range(n)]
    return rows + [(None, "no id", "en", "s", 3), (None, None, None, None, None), (5, "", "en", "", 0), (5, "", "en", "", 0), (5, None, "en", None, 0), (10**15, "x" * 300_000, "de", "s", 1)]


@pytest.mark.parametrize("n, levels", [(90, 2), (90, 10), (3, 1)])
def test_equals_plain(spark, n, levels):
    rows = rows_of(n)
    tampered = lambda k: k is not None and k % 4 == 0
    docs = spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA).repartition(5)
    claimed = F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(docs, claimed={"n_chars": claimed}, levels=levels)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, H("".join(r.proof)), r.folded_root, r.verified) for r in found.collect()]
    key = lambda r: (r[0] is None, *map(str, r))
    assert sorted(got, key=key) == sorted(plain(rows, tampered), key=key)
    assert all(merkle.fold(r.leaf, r.proof, r.sides) == r.root for r in found.collect())


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(7, "a", "en", "s", 1, "a", "b", 1, "c")], SCHEMA)
    row = merkle.manifest(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof == [] and row.sides == ""
    assert merkle.manifest(one.limit(0)).count() == 0


def test_a_group_of_equal_rows_is_spread(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    found = merkle.manifest(docs, levels=4)
    assert found.select(F.count_distinct("place"), F.count_if("verified"), F.count_distinct("leaf")).first() == (3000, 3000, 1)
