"""Periodic runs of words: suffix-tree LCE, Lyndon roots extended to both sides.

A run is a stretch of words that repeats with a smallest period and cannot be extended.
By the runs theorem each run has a root that is, for one of two opposite orders of the
alphabet, the longest Lyndon word at its place.  So for both orders every place gives one
candidate, from it to the next smaller suffix, and the run around a candidate is as far
as the text agrees with itself shifted by the candidate's length: to the right by the
longest common extension of two suffixes, to the left by that of two prefixes.

Extensions are lowest common ancestors in suffix trees of the text and of its reversal.
Both trees are built by Ukkonen's algorithm; a tour visits the leaves in order and keeps
the least string depth it comes by between neighbours, so the ancestor of two leaves is a
range minimum, answered in constant time from minima of blocks.

Most texts repeat nothing.  All windows of a run of three periods and 24 words occur
again in that run, so only stretches in which every short window occurs elsewhere in the
document can hold one, and each run lies in one stretch whole.  Only they become trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newstape.llm.common import neutral, rows, texts

#: a run has this many words and this many periods at least
MIN_WORDS, MIN_PERIODS = 24, 3
#: words looked at together for repeated windows
SPAN = 1 << 19
#: entries of a minimum block, and distinct words a worker numbers before it starts anew
BLOCK, WORDS = 16, 300_000
_M = np.uint64(0x9E3779B97F4A7C15)


def ukkonen(text: list[int], base: int) -> tuple[dict[int, int], list[int], list[int]]:
    """The suffix tree of a text whose last symbol is unique; symbols are below ``base``.

    Returns the edges (node * base + first symbol -> child), the string depth of inner
    nodes, and the suffix of each leaf (-1 for inner nodes).
    """
    n = len(text)
    start, stop, link, depth, suffix = [0], [0], [0], [0], [-1]
    edges: dict[int, int] = {}
    node = edge = length = born = 0
    for i, symbol in enumerate(text):
        pending = 0
        while born <= i:
            if not length:
                edge = i
            key = node * base + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i), stop.append(n), link.append(0), depth.append(0), suffix.append(born)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                first = start[child]
                size = stop[child] - first
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if text[first + length] == symbol:
                    if pending:
                        link[pending] = node
                    length += 1
                    break
                middle = len(start)
                edges[key] = middle
                start.append(first), stop.append(first + length), link.append(0), depth.append(i - born), suffix.append(-1)
                edges[middle * base + symbol] = middle + 1
                start.append(i), stop.append(n), link.append(0), depth.append(0), suffix.append(born)
                start[child] = first + length
                edges[middle * base + text[first + length]] = child
                if pending:
                    link[pending] = middle
                pending = middle
            born += 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = born
    return edges, depth, suffix


class SuffixTree:
    """Leaf order and longest common extensions of a text; the first ``ends`` symbols are unique marks."""

    def __init__(self, text: np.ndarray, base: int):
        self.base = base
        edges, depth, suffix = ukkonen(text.tolist(), base)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.parent, self.symbol = keys // base, keys % base
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.depth, self.suffix = depth, suffix
        self.size = len(text)

    def tour(self, rank_of_symbol: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, and the least depth between neighbours."""
        symbol = self.symbol if rank_of_symbol is None else rank_of_symbol[self.symbol]
        order = np.lexsort((-symbol, self.parent))  # a stack takes the last child first
        owner, kids = self.parent[order], self.child[order].tolist()
        nodes = len(self.depth)
        low = np.searchsorted(owner, np.arange(nodes + 1)).tolist()
        above = np.zeros(nodes, np.int64)
        above[self.child] = self.parent
        above, depth, suffix = above.tolist(), self.depth, self.suffix
        leaves: list[int] = []
        least: list[int] = []
        stack = kids[low[0] : low[1]]
        up = False
        while stack:
            v = stack.pop()
            if up:
                least.append(depth[above[v]])
            if suffix[v] >= 0:
                leaves.append(suffix[v])
                up = True
            else:
                stack += kids[low[v] : low[v + 1]]
                up = False
        return np.array(leaves, np.int64), np.array(least, np.int64)


class Extensions:
    """Longest common extensions of suffixes: range minima over the tour, in constant time."""

    def __init__(self, leaves: np.ndarray, least: np.ndarray):
        self.place = np.empty(len(leaves), np.int64)
        self.place[leaves] = np.arange(len(leaves))
        padded = np.full(-(-max(len(least), 1) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(least)] = least
        blocks = padded.reshape(-1, BLOCK)
        self.least = padded
        self.upto = np.minimum.accumulate(blocks, 1).ravel()
        self.since = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [blocks.min(1)]
        while 2 << (len(self.table) - 1) <= len(blocks):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common length of different suffixes ``a`` and ``b``."""
        a, b = self.place[a], self.place[b]
        low, high = np.minimum(a, b), np.maximum(a, b) - 1
        first, last = low // BLOCK, high // BLOCK
        out = np.minimum(self.since[low], self.upto[high])
        same = np.flatnonzero(first == last)
        if len(same):
            lo, hi = low[same], high[same]
            best = self.least[lo]
            for k in range(1, BLOCK):
                best = np.minimum(best, self.least[np.minimum(lo + k, hi)])
            out[same] = best
        wide = np.flatnonzero(last - first > 1)
        if len(wide):
            lo, hi = first[wide] + 1, last[wide] - 1
            level = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                at = level == k
                table = self.table[k]
                got = np.minimum(table[lo[at]], table[hi[at] - (1 << k) + 1])
                out[wide[at]] = np.minimum(out[wide[at]], got)
        return out.astype(np.int64)


def _next_smaller(leaves: np.ndarray) -> np.ndarray:
    """For each suffix the next one to its right that is smaller: there its longest Lyndon word ends."""
    rank = np.empty(len(leaves), np.int64)
    rank[leaves] = np.arange(len(leaves))
    rank = rank.tolist()
    out = [0] * len(rank)
    stack: list[int] = [len(rank)]
    rank.append(-1)
    for i in range(len(out) - 1, -1, -1):
        mine = rank[i]
        while rank[stack[-1]] > mine:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(
    words: np.ndarray, ends: int = 1, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> np.ndarray:
    """Rows (start, length, period) of all runs.

    ``words`` are numbers from 0; the first ``ends`` of them each stand once, as marks that
    no run crosses, and the last symbol is one of them.
    """
    base = int(words.max()) + 1
    tree = SuffixTree(words, base)
    leaves, least = tree.tour()
    forward = Extensions(leaves, least)
    # both orders keep the marks below all words, in one order
    opposite = np.concatenate([np.arange(ends), np.arange(base - 1, ends - 1, -1)])
    other_leaves, _ = tree.tour(opposite)
    back = np.concatenate([words[-2::-1], words[-1:]])
    backward = Extensions(*SuffixTree(back, base).tour())
    found = []
    last = len(words) - 1
    for order in (leaves, other_leaves):
        root = np.flatnonzero(words >= ends)
        period = _next_smaller(order)[root] - root
        fits = period * min_periods <= last
        root, period = root[fits], period[fits]
        begin = root.copy()
        inner = np.flatnonzero(root > 0)
        begin[inner] -= backward.of(last - root[inner], last - root[inner] - period[inner])
        end = root + period
        end += forward.of(root, end)
        length = end - begin
        good = (length >= min_words) & (length >= min_periods * period)
        found.append(np.stack([begin[good], length[good], period[good]], 1))
    found = np.concatenate(found)
    return np.unique(found[np.lexsort((found[:, 2], found[:, 0]))], axis=0) if len(found) else found


def _window(min_words: int, min_periods: int) -> int:
    """The longest window of which each in a run occurs again in the same run.

    With period q in n words that takes windows of at most (n - 2 q + 1) words or so: of
    the shortest runs, q = min_words / min_periods is the worst.
    """
    return min(max(n - 2 * q + 1, 1) for q in range(1, min_words + 1) for n in [max(min_words, min_periods * q)])


class Finder:
    """Runs of many documents; keeps the numbers of the words it has met."""

    def __init__(self, min_words: int, min_periods: int):
        self.min_words, self.min_periods = min_words, min_periods
        self.window = _window(min_words, min_periods)
        self.numbers: dict[bytes, int] = {}

    def numbered(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers
        if len(numbers) > WORDS:
            numbers.clear()
        # a word met first takes the next number
        return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))

    def stretches(self, documents: list[np.ndarray]) -> dict[int, list[tuple[int, int]]]:
        """Of each document that has them: stretches (begin, end) that may hold runs."""
        size = self.window
        owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
        words = np.concatenate(documents) if documents else np.empty(0, np.int64)
        n = len(words) - size + 1
        if n <= 0:
            return {}
        key = owner[:n].astype(np.uint64)
        for k in range(size):
            key = (key ^ words[k : n + k].astype(np.uint64)) * _M
            key ^= key >> np.uint64(29)
        valid = owner[:n] == owner[size - 1 :]
        # equal windows have equal keys; an accidental equality only makes a stretch longer
        order = np.argsort(key)
        sorted_keys = key[order]
        twin = sorted_keys[1:] == sorted_keys[:-1]
        again = np.zeros(n, bool)
        again[order[1:][twin]] = True
        again[order[:-1][twin]] = True
        again &= valid
        edge = np.diff(np.concatenate([[False], again, [False]]).astype(np.int8))
        begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
        first = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
        out: dict[int, list[tuple[int, int]]] = {}
        for a, b in zip(begin.tolist(), (end + size - 1).tolist()):
            if b - a >= self.min_words:
                k = int(owner[a])
                out.setdefault(k, []).append((a - int(first[k]), b - int(first[k])))
        return out

    def runs(self, words: np.ndarray, stretches: list[tuple[int, int]]) -> np.ndarray:
        """Runs (start, length, period) of one document, by start and period."""
        ends = len(stretches)
        used, number = np.unique(np.concatenate([words[a:b] for a, b in stretches]), return_inverse=True)
        parts, shift, at = [], [], 0
        for k, (a, b) in enumerate(stretches):
            parts += [number[at : at + b - a] + ends, [k]]
            shift.append(np.full(b - a + 1, a - at - k))
            at += b - a
        found = runs_of(np.concatenate(parts).astype(np.int64), ends, self.min_words, self.min_periods)
        if len(found):
            found[:, 0] += np.concatenate(shift)[found[:, 0]]
            found = found[np.lexsort((found[:, 2], found[:, 0]))]
        return found


def collapsed(words: list[bytes], runs: list[list[int]]) -> bytes:
    """The words that no run holds after its first period, joined by blanks."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([w for w, kept in zip(words, keep.tolist()) if kept])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``_n_words``, ``_runs`` (start, length, period in words) and ``_collapsed``.

    Words are what stands between ASCII white space.  ``_runs`` holds all runs of at least
    ``min_words`` words and ``min_periods`` periods, by start and period; ``_collapsed`` is
    the text without what repeats in them, its words joined by single blanks.  ``edit``
    may change a row's words (given its id and words) before they are looked at.  Texts
    that are NULL, empty or blank have no words, no runs and an empty ``_collapsed``.
    Rows are looked at one by one, so NULL or repeated ids and repeated rows need no rule.
    A task holds one batch of rows and the words of one long text.
    """
    names = neutral(docs)
    body, key = names[docs.columns.index(text_col)], names[docs.columns.index(id_col)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    plain = docs.toDF(*names)
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(min_words, min_periods)

        def finish(some: pa.RecordBatch, words: list[list[bytes]]) -> pa.RecordBatch:
            # the table of numbers may start anew between rows, so equal words are numbered per row
            documents = [finder.numbered(w) for w in words]
            possible = finder.stretches(documents)
            found = [finder.runs(documents[k], possible[k]).tolist() if k in possible else [] for k in range(len(words))]
            left = [collapsed(w, r) if r else b" ".join(w) for w, r in zip(words, found)]
            listed = [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in found]
            return rows(
                **{c: some.column(c) for c in names}, _n_words=pa.array([len(w) for w in words], pa.int64()),
                _runs=pa.array(listed, kind), _collapsed=pa.array(left, pa.binary()).cast(pa.string()),
            )

        for batch in batches:
            ids, bodies = batch.column(key).to_pylist(), texts(batch.column(body))
            low, held, n = 0, [], 0
            for k, text in enumerate(bodies):
                words = (text or b"").split()
                if edit:
                    words = edit(ids[k], words)
                held.append(words)
                n += len(words)
                if n >= SPAN:
                    yield finish(batch.slice(low, k + 1 - low), held)
                    low, held, n = k + 1, [], 0
            if held:
                yield finish(batch.slice(low), held)

    listed = "_n_words long, _runs array<struct<start: long, length: long, period: long>>, _collapsed string"
    return plain.mapInArrow(run, f"{schema}, {listed}").toDF(*docs.columns, "_n_words", "_runs", "_collapsed")
