"""Periodic runs against a plain search over all periods, and the registered query against plain Python."""

import hashlib
import random
import zlib

from newstape.llm import queries, runs

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, _runs string, _collapsed int, start string"


def plain_runs(w, min_words, min_periods):
    n, out = len(w), set()
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(min_words, min_periods * q):
                smaller = any(q % d == 0 and all(w[k] == w[k + d] for k in range(i, i + length - d)) for d in range(1, q))
                if not smaller:
                    out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c not in BLANKS:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def kept(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [x for i, x in enumerate(w) if i not in gone]


def test_runs_of_random_words():
    r = random.Random(1)
    for _ in range(1500):
        least = r.choice([(24, 3), (6, 2), (4, 2), (9, 3), (1, 2)])
        n, letters = r.randint(0, 90), r.choice([1, 2, 2, 3, 5])
        w = [b"%d" % r.randrange(letters) for _ in range(n)]
        if n and r.random() < 0.6:
            a = r.randrange(n)
            p = r.randint(1, max(1, (n - a) // 3))
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        finder = runs.Finder(*least)
        numbers = [finder.numbered(w)]
        some = finder.stretches(numbers)
        got = [tuple(x) for x in finder.runs(numbers[0], some[0]).tolist()] if 0 in some else []
        assert got == plain_runs(w, *least)


def test_operator(spark):
    r = random.Random(2)
    some = [" ".join(r.choice("abcdé") for _ in range(60)) for _ in range(30)]
    table = [(k, t) for k, t in enumerate(some)] + [
        (None, "x " * 50), (7, "x y " * 40), (7, "x y " * 40), (8, None), (9, ""), (10, " \n\t"), (11, "\x1cz\x1f " * 30),
        (12, "one two three " * 20 + "\n" + "end " + "four five\t" * 30), (13, "long " + "a b c d e f g " * 60_000), (14, "w" * 500_000),
    ]
    docs = spark.createDataFrame([(k, t, "r", 1, "s") for k, t in table], SCHEMA)
    got = runs.periodic_runs(docs).collect()
    assert len(got[0]) == 8 and got[0][:5] == (0, some[0], "r", 1, "s")
    for row, (_, text) in zip(sorted(got, key=lambda r: (str(r[0]), r[1] or "")), sorted(table, key=lambda r: (str(r[0]), r[1] or ""))):
        w = words_of(text)
        found = [tuple(x) for x in row[6]]
        assert row[5] == len(w) and row[7] == " ".join(kept(w, found))
        assert found == ([(1, len(w) - 1, 7)] if len(w) > 10_000 else plain_runs(w, 24, 3))
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def changed(k, w):
    h = zlib.crc32(str(k).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_registered_query(spark, sample):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: tuple(r) for r in queries.op13_runs(spark, sample).collect()}
    docs = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    some = 0
    for k, text in docs:
        w = changed(k, words_of(text))
        found = plain_runs(w, 24, 3)
        some += len(found)
        best = (None,) * 4
        if found:
            s, n, q = min(found, key=lambda r: (-(r[1] * 10**12 // r[2]), r[0], r[2]))
            best = (s, n, q, 1000 * n // q)
        assert got[k] == (k, len(found), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept(w, found))))
    assert some > 10
