"""Plain versions of the operators' answers, for small tables."""

import random
from collections import Counter, defaultdict

DOC = "doc_id long, text string, lang string, source string, n_chars long, _id string, _h string, key int, root string"


def documents(spark, rows):
    """rows: (doc_id, text); the other columns clash with names the operators use."""
    data = [(k, t, "en", "src", None if t is None else len(t), "x", "y", 1, "z") for k, t in rows]
    return spark.createDataFrame(data, DOC)


def prose(seed, n):
    r = random.Random(seed)
    syllables = "an en the st or ing ha re ti ou wh ly ed nd ble".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def components(n, linked):
    """Smallest member of each element's component; ``linked(i, j)`` says whether two elements link."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def dropped_lines(rows, min_chars=40, min_docs=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(low)
    holders = defaultdict(set)
    for k, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(-(2**63) if k is None else k)
    out = []
    for k, t in rows:
        k = -(2**63) if k is None else k
        lines = (t or "").split("\n")
        left = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != k)]
        out.append(("\n".join(left), len(lines), len(lines) - len(left)))
    return out


def repeated_bytes(texts, length):
    """A flag per byte of each text: covered by a string of ``length`` bytes that starts anywhere else too."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                flags[i : i + length] = [True] * length
        out.append(flags)
    return out


def prefix_distance(item, window):
    """Least edit distance of a sequence to a prefix of another."""
    row = list(range(len(window) + 1))
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(window, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
