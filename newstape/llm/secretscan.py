"""Secret scan: rules find what they know, a character convolution judges every other candidate.

A candidate is what no rule covers: a run of 16 or more value characters with a digit, of
24 or more without one, or of 6 or more after ``:`` or ``=``; not one of only one or two
different characters (rules, leaders).  Its characters and its
surroundings go through a small convolutional network in numpy.  The network learns from
labelled findings: a labelled set made by the rules below (:func:`secret_example`,
:func:`harmless_example`), with the table's own words around it, and the table's own
findings of the rules.  Candidates of the table that no rule accepts may be secrets nobody
listed, so they are no harmless examples as they stand: a first network judges them, and
only those it holds for harmless are learnt as such.  Scores are calibrated on findings
held back, and a candidate is reported from the highest threshold that keeps the wanted
recall there.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newstape.llm.common import mapped, rows, stage, text_of, unstage

#: fixed values: the rules
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "learned")
#: other runs that may be secrets: long ones, those without a digit, and those after ``:`` or ``=``
RUN, LETTERS, AFTER_SIGN = 16, 24, 6
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{RUN},}}+")
SIGNED = re.compile(rf"""(?<=[:=])\s?["']?([A-Za-z0-9+/_.-][A-Za-z0-9+/_.=-]{{{AFTER_SIGN - 1},}}+)""")
KEYED = re.compile(r"[:=]\s*[\"']?$")
DIGIT = re.compile(r"[0-9]")

#: what the network sees: characters before, of the candidate (longer ones part by part), and after
BEFORE, INSIDE, AFTER = 32, 48, 16
WIDTH = BEFORE + INSIDE + AFTER
#: sizes of the network
SYMBOLS, EMBED, SPAN, FILTERS = 98, 8, 5, 24
#: documents looked at for training, findings of each label from them, at most, and examples made for each label
SAMPLE_DOCS, SAMPLE_FINDINGS, MADE = 20_000, 1_000, 4_000
RECALL, SURE = 0.995, 0.9

_VALUE = np.zeros(256, bool)
_VALUE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_HEXED = np.zeros(256, bool)
_HEXED[list(b"0123456789abcdef")] = True


def rule_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules, in the order of start and kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the runs that may be secrets and overlap no finding of a rule, in order."""
    spans = [m.span() for m in CANDIDATE.finditer(text) if m.end() - m.start() >= LETTERS or DIGIT.search(m[0])]
    if ":" in text or "=" in text:
        long = {a for a, _ in spans}
        signed = [m.span(1) for m in SIGNED.finditer(text)]
        inside = np.array(spans, np.int64).reshape(-1, 2)
        for a, b in signed:
            # what follows the sign may be part of a longer run, as in key=value&other=value
            k = int(np.searchsorted(inside[:, 0], a, "right")) - 1
            if a not in long and not (k >= 0 and inside[k, 1] > a):
                spans.append((a, b))
        spans.sort()
    out, k = [], 0
    reach: list[int] = []
    for _, _, end in taken:  # furthest end so far: findings of different kinds may lie inside each other
        reach.append(max(end, reach[-1] if reach else 0))
    for a, b in spans:
        while k < len(taken) and taken[k][0] < b:
            k += 1
        if not (k and reach[k - 1] > a) and len(set(text[a:b])) > 2:
            out.append((a, b))
    return out


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def suspects(values: list[bytes]) -> np.ndarray:
    """Which texts may hold a finding or a candidate, from runs of byte classes over all texts at once."""
    joined = b"\n".join(values)
    data = np.frombuffer(joined, np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(v) + 1 for v in values])])
    flag = np.zeros(len(values), bool)
    start, end = _runs(_VALUE[data], RUN)
    if len(start):
        digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
        start = start[(digits[end] > digits[start]) | (end - start >= LETTERS)]
        flag[np.searchsorted(begins, start, "right") - 1] = True
    # signs with a value character among the three characters after them
    sign = np.flatnonzero((data == 58) | (data == 61))
    near = np.zeros(len(sign), bool)
    for k in (1, 2, 3):
        near |= _VALUE[data[np.minimum(sign + k, len(data) - 1)]]
    flag[np.searchsorted(begins, sign[near], "right") - 1] = True
    start, _ = _runs(_HEXED[data], LEAST_HEX)
    flag[np.searchsorted(begins, start, "right") - 1] = True
    low = joined.lower()
    for word, where in ((b"AKIA", joined), *((k, low) for k in KEYWORDS)):
        at = where.find(word)
        while at >= 0:
            k = int(np.searchsorted(begins, at, "right")) - 1
            flag[k] = True
            at = where.find(word, int(begins[k + 1]))
    return flag


def views(text: str, start: int, end: int) -> list[np.ndarray]:
    """A candidate as symbol numbers, a view per ``INSIDE`` characters, the surroundings with each."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
    after = text[end : end + AFTER].ljust(AFTER, "\0")
    out = []
    for at in range(start, end, INSIDE):
        line = before + text[at : min(at + INSIDE, end)].ljust(INSIDE, "\0") + after
        codes = np.fromiter(map(ord, line), np.int64, WIDTH)
        # 0 nothing, 1 other controls and blanks, 2 to 96 printable ASCII, 97 all else
        out.append(np.where(codes == 0, 0, np.where(codes < 32, 1, np.where(codes < 127, codes - 30, SYMBOLS - 1))))
    return out


@dataclass
class Network:
    """Embedding, one convolution, a maximum over each of the three regions, a logistic output; then calibration."""

    embed: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    #: lowest score reported, for candidates after ``:`` or ``=`` and for others
    least: tuple[float, float] = (2.0, 2.0)

    @staticmethod
    def fresh(seed: int = 11) -> "Network":
        r = np.random.default_rng(seed)
        return Network(
            r.normal(0, 0.3, (SYMBOLS, EMBED)), r.normal(0, 0.2, (SPAN * EMBED, FILTERS)), np.zeros(FILTERS),
            r.normal(0, 0.2, 3 * FILTERS), 0.0,
        )

    def _forward(self, x: np.ndarray):
        padded = np.pad(x, ((0, 0), (SPAN // 2, SPAN // 2)))
        near = np.lib.stride_tricks.sliding_window_view(padded, SPAN, axis=1)
        columns = self.embed[near].reshape(len(x), WIDTH, SPAN * EMBED)
        hidden = np.maximum(columns @ self.kernel + self.shift, 0)
        parts = (hidden[:, :BEFORE], hidden[:, BEFORE : BEFORE + INSIDE], hidden[:, BEFORE + INSIDE :])
        pooled = np.concatenate([p.max(axis=1) for p in parts], axis=1)
        return near, columns, parts, pooled, pooled @ self.out + self.bias

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.concatenate([self._forward(x[at : at + 256])[-1] for at in range(0, len(x), 256)])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.offset, -30, 30)))

    def step(self, x: np.ndarray, y: np.ndarray, moments: dict, t: int, rate: float = 0.01) -> None:
        """One step of Adam on the log loss."""
        near, columns, parts, pooled, raw = self._forward(x)
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / len(y)
        pull = error[:, None] * self.out[None, :]
        hidden = np.zeros((len(x), WIDTH, FILTERS))
        at = 0
        for k, part in enumerate(parts):
            top = part.argmax(axis=1)
            g = pull[:, k * FILTERS : (k + 1) * FILTERS] * (part.max(axis=1) > 0)
            np.put_along_axis(hidden, (top + at)[:, None, :], g[:, None, :], axis=1)
            at += part.shape[1]
        grads = {
            "out": pooled.T @ error, "bias": error.sum(), "shift": hidden.sum(axis=(0, 1)),
            "kernel": columns.reshape(-1, SPAN * EMBED).T @ hidden.reshape(-1, FILTERS),
        }
        back = (hidden.reshape(-1, FILTERS) @ self.kernel.T).reshape(-1, EMBED)
        flat = near.reshape(-1)
        grads["embed"] = np.stack([np.bincount(flat, back[:, k], SYMBOLS) for k in range(EMBED)], axis=1)
        for name, g in grads.items():
            m, v = moments.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
            moments[name] = (m, v)
            setattr(self, name, getattr(self, name) - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8))


#: fixed values: what the labelled examples are made of
NAMES = (
    "password", "passwd", "secret", "token", "api_key", "apikey", "key", "credential", "client_secret", "access_key", "passphrase",
    "login", "user_pass", "private_key", "signing_secret", "session_token", "PASSPHRASE", "SECRET_KEY", "authorization", "cookie",
)
PREFIXES = ("sk_live_", "pk_", "xoxb-", "glpat-", "key-", "tok_", "npm_", "SG.", "shpat_", "dop_v1_")
SIGNS = (" = ", "=", ": ", ":", ' = "', "='", '": "', ' "', " ", ' -> "')
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (
    DIGITS + "abcdef", DIGITS + "ABCDEF", UPPER + DIGITS, LOWER + DIGITS, UPPER + LOWER + DIGITS, UPPER + LOWER, UPPER + LOWER + DIGITS + "+/",
    UPPER + LOWER + DIGITS + "_-",
)
FIELDS = (
    "name", "status", "color", "title", "Note", "author", "type", "lang", "city", "date", "id", "version", "path", "file", "page",
    "total", "order", "card", "phone", "Tel", "mail", "contact", "ref", "isbn", "class", "href", "src", "width", "mode", "unit",
)
PARTS = (
    "usr", "lib", "python3", "packages", "get", "set", "by", "class", "data", "index", "config", "user", "test", "main", "src", "node",
    "modules", "file", "value", "item", "list", "type", "error", "message", "build", "v2", "static", "image", "service", "Handler",
)


def _drawn(letters: str, size: int, random: np.random.Generator) -> str:
    return "".join(letters[i] for i in random.integers(0, len(letters), size))


def _pick(some, random: np.random.Generator):
    return some[int(random.integers(len(some)))]


def secret_example(words: list[str], random: np.random.Generator) -> tuple[str, int, int, int]:
    """A random value among words: after a name or bare, with a prefix or without; a short one has a name."""
    before = " ".join(_pick(words, random) for _ in range(int(random.integers(1, 6)))) + " "
    named = random.random() < 0.65
    size = int(random.integers(6, 24)) if named and random.random() < 0.4 else int(random.integers(16 if named else 28, 65))
    value = _drawn(_pick(ALPHABETS, random), size, random)
    if size >= 16 and random.random() < 0.25:
        value = _pick(PREFIXES, random) + value
    if named:
        before += _pick(NAMES, random) + (_pick(SIGNS, random) if size >= 16 else _pick(SIGNS[:7], random))
    after = _pick(('"', "'", " ", "\n", ".", ", ", ")"), random) + " ".join(_pick(words, random) for _ in range(3))
    return before + value + after, len(before), len(before) + len(value), 1


def harmless_example(words: list[str], random: np.random.Generator) -> tuple[str, int, int, int]:
    """What looks like a candidate and is none: numbers, addresses, paths, names of things, words."""
    word = lambda: re.sub(r"[^A-Za-z0-9]", "", _pick(words, random)) or "word"
    digits = lambda n: _drawn(DIGITS, n, random)
    part = lambda: _pick(PARTS, random) if random.random() < 0.5 else word()
    some = lambda: digits(int(random.integers(0, 3)))
    slug = lambda: "-".join(part().lower() for _ in range(int(random.integers(2, 7)))) if random.random() < 0.3 else part()
    kind = int(random.integers(14))
    after = " "
    if kind == 0:  # card and account numbers
        value = _pick((digits(16), "-".join(digits(4) for _ in range(4)), digits(int(random.integers(17, 25)))), random)
    elif kind == 1:  # dates, times, telephone numbers
        value = _pick((f"20{digits(2)}-{digits(2)}-{digits(2)}T{digits(2)}", f"+{digits(2)}-{digits(3)}-{digits(7)}", f"{digits(2)}.{digits(2)}.{digits(4)}"), random)
    elif kind == 2:  # the name of a mailbox, or its host
        value, after = f"{word()}.{word()}{digits(int(random.integers(1, 4)))}".lower(), "@example.org "
    elif kind == 3:  # addresses and paths
        value = f"{_pick(('www.', '/', '/', './', '', f'{word().lower()}.{word().lower()}.org/'), random)}{'/'.join(slug() + _pick(('', '', some(), digits(4), '.' + digits(1)), random) for _ in range(int(random.integers(2, 7))))}{_pick(('.html', '/', '', '-2021.pdf', '.py', '/index.php'), random)}"
    elif kind == 4:  # names in programs
        value = _pick("_-.", random).join(part() for _ in range(int(random.integers(2, 6)))) + some()
    elif kind == 5:
        value = _pick((word().lower(), ""), random) + "".join(part().capitalize() for _ in range(int(random.integers(3, 7)))) + some()
    elif kind == 6:  # rules and leaders
        value = _pick("=-_./", random) * int(random.integers(16, 60))
    elif kind == 7:  # compounds
        value = "".join(word().lower() for _ in range(int(random.integers(4, 9))))
    elif kind == 8:  # versions and sizes
        value = f"{word().lower()}-{digits(1)}.{digits(2)}.{digits(1)}-{_pick(('rc1', 'beta', 'linux-x86', 'amd64'), random)}"
    elif kind == 9:  # queries
        value = "=".join(word().lower() for _ in range(3)) + digits(3)
    else:  # a plain word or number after a sign
        value = _pick((word() + word().lower(), word().lower() + word().lower(), digits(int(random.integers(6, 12))), word() + "-" + word(), word().lower() + "." + word().lower()), random)
    before = " ".join(_pick(words, random) for _ in range(int(random.integers(1, 6)))) + " "
    if kind == 2 and random.random() < 0.5:
        before, value, after = f"{before}{word().lower()}.{digits(2)}@", f"{_pick(('mail', 'smtp', 'post'), random)}{digits(1)}.{word().lower()}.{_pick(('com', 'org', 'de'), random)}", " "
    elif kind == 3 and random.random() < 0.5:
        before += _pick(("http:", "https:", "https:", "ftp:", "file:"), random)
        value = "//" + value.lstrip("./")
    elif kind >= 10 or random.random() < 0.4:
        before += (_pick(FIELDS, random) if random.random() < 0.6 else word()) + _pick(SIGNS[:7], random)
    value = value.ljust(AFTER_SIGN, "e")
    return before + value + after + " ".join(_pick(words, random) for _ in range(3)), len(before), len(before) + len(value), 0


def labelled_set(words: list[str], size: int = MADE, seed: int = 7) -> list[tuple[str, int, int, int]]:
    """``size`` examples of each label, with ``words`` around them."""
    random = np.random.default_rng(seed)
    return [make(words, random) for _ in range(size) for make in (secret_example, harmless_example)]


def _learned(network: Network, x: np.ndarray, target: np.ndarray, epochs: int, random: np.random.Generator) -> None:
    moments: dict = {}
    t = 0
    for epoch in range(epochs):
        order = random.permutation(len(x))
        for at in range(0, len(order), 64):
            t += 1
            some = order[at : at + 64]
            network.step(x[some], target[some], moments, t, 0.01 if epoch < epochs // 2 else 0.003)


def fit(labelled: list[tuple[str, int, int, int]], epochs: int = 8, recall: float = RECALL, seed: int = 11) -> Network:
    """Train on (text, start, end, label) findings; a fourth is held back to calibrate and to set thresholds."""
    network = Network.fresh(seed)
    random = np.random.default_rng(seed)
    x = np.stack([views(text, start, end)[0] for text, start, end, _ in labelled])
    y = np.array([f[3] for f in labelled])
    if not 0 < y.sum() < len(y):
        raise ValueError("findings of both labels are needed")
    held = random.permutation(len(y)) % 4 == 3
    _learned(network, x[~held], y[~held], epochs, random)
    hy = y[held]
    keyed = np.array([bool(KEYED.search(text[:start])) for text, start, _, _ in labelled])[held]
    raw = network.raw(x[held])
    a, b = 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        a -= 0.05 * (((p - hy) * raw).mean() + 0.01 * (a - 1))
        b -= 0.05 * ((p - hy).mean() + 0.01 * b)
    network.slope, network.offset = max(a, 0.05), b
    score = network.score(x[held])
    least = []
    for kind in (True, False):
        good = np.sort(score[(keyed == kind) & (hy == 1)])
        if len(good) < 10:
            good = np.sort(score[hy == 1])
        # the highest that keeps the recall; more than so sure nobody need be of kinds that were not held back
        least.append(min(SURE, float(good[int((1 - recall) * len(good))])))
    network.least = (least[0], least[1])
    return network


FINDING = "text string, begin int, stop int, label int, draw long"


def train(docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> Network:
    """A network from labelled findings: (text around, begin, stop, label) of ``findings``, or drawn from ``docs``.

    Without ``findings`` there are always ``MADE`` made examples of each label.  From the
    table come the words around them, the rules' findings (label 1), and the candidates no
    rule accepts that a network of the others holds for harmless (label 0): of about
    ``SAMPLE_DOCS`` documents chosen by a hash of their text, and at most
    ``SAMPLE_FINDINGS`` of each; only these, with their surroundings, reach the driver.
    """
    order = ["draw", "text", "begin", "stop"]
    if findings is not None:
        draw = F.xxhash64("text", "begin", "stop").alias("draw")
        parts = [findings.where(F.col("label") == k).select("text", "begin", "stop", "label", draw).distinct().orderBy(*order)
                 .limit(MADE + SAMPLE_FINDINGS).collect() for k in (1, 0)]
        labelled = [(r["text"], r["begin"], r["stop"], r["label"]) for part in parts for r in part]
        mixed = np.random.default_rng(3).permutation(len(labelled))
        return fit([labelled[k] for k in mixed], **options)
    n = docs.count()
    text = text_of(text_col)
    draw = F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 30))
    some = docs.select(text.alias("_text"), draw.alias("_draw"))
    if n > SAMPLE_DOCS:
        some = some.where(F.col("_draw") < int((1 << 30) * SAMPLE_DOCS / n))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for text, number in zip(batch.column("_text").to_pylist(), batch.column("_draw").to_pylist()):
            if text:
                at = number % len(text)
                out.append((text[at : at + 120], 0, 0, 2, number * 4096))  # words to put around examples
            ruled = rule_findings(text)
            spans = [(a if k else ASSIGN.match(text, a).start(2), b, 1) for a, k, b in ruled]
            spans += [(a, b, 0) for a, b in candidates(text, ruled)]
            for a, b, label in spans:
                lo = max(0, a - BEFORE)
                out.append((text[lo : b + AFTER], a - lo, b - lo, label, number * 4096 + a % 4096))
        if not out:
            return None
        text, begin, stop, label, number = zip(*out)
        return rows(text=list(text), begin=pa.array(begin, pa.int32()), stop=pa.array(stop, pa.int32()),
                    label=pa.array(label, pa.int32()), draw=pa.array(number, pa.int64()))

    found = stage(mapped(some, each, FINDING), "findings")
    parts = {k: found.where(F.col("label") == k).distinct().orderBy(*order).limit(SAMPLE_FINDINGS).collect() for k in (0, 1, 2)}
    unstage(found)
    words = [w for r in parts[2] for w in r["text"].split()[1:-1]] or ["the", "of", "and", "word", "text", "other"]
    labelled = labelled_set(words) + [(r["text"], r["begin"], r["stop"], 1) for r in parts[1]]
    unknown = [(r["text"], r["begin"], r["stop"], 0) for r in parts[0]]
    mixed = np.random.default_rng(3).permutation(len(labelled))
    labelled = [labelled[k] for k in mixed]
    if unknown:
        first = fit(labelled, **{**options, "epochs": 4})
        low = first.score(np.stack([views(*u[:3])[0] for u in unknown])) < 0.5
        labelled += [u for u, harmless in zip(unknown, low) if harmless]
        mixed = np.random.default_rng(4).permutation(len(labelled))
        labelled = [labelled[k] for k in mixed]
    return fit(labelled, **options)


SPANS = "array<struct<kind: string, start: long, end: long, score: double>>"


def scan(docs: DataFrame, network: Network, text_col: str = "text", carry: list[str] = ["doc_id"]) -> DataFrame:
    """``carry`` columns and ``spans`` of every row: kind, start and end in code points, end exclusive, by start and kind.

    Findings of the rules have score 1 and always stay; ``learned`` ones carry the
    network's calibrated score.  A NULL or empty text has no spans; equal texts have equal spans.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)  # some thousand numbers
    inputs = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], text_of(text_col).alias("_text"))
    names = [f"_c{k}" for k in range(len(carry))]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        values = [v.encode("utf-8", "surrogatepass") for v in batch.column("_text").to_pylist()]
        spans: list[list[dict]] = [[] for _ in values]
        open_: list[tuple[int, int, int, int]] = []  # text, start, end, first view
        seen: list[np.ndarray] = []
        keyed: list[bool] = []
        for i in np.flatnonzero(suspects(values)):
            text = values[i].decode("utf-8", "surrogatepass")
            ruled = rule_findings(text)
            spans[i] = [{"kind": KINDS[k], "start": a, "end": b, "score": 1.0} for a, k, b in ruled]
            for a, b in candidates(text, ruled):
                open_.append((i, a, b, len(seen)))
                seen += views(text, a, b)
                keyed.append(bool(KEYED.search(text[max(0, a - BEFORE) : a])))
        if open_:
            # equal views, as of a very long repetitive run, are judged once
            alike, which = np.unique(np.stack(seen), axis=0, return_inverse=True)
            score = model.score(alike)[which.ravel()]
            best = np.maximum.reduceat(score, [f for *_, f in open_])
            for (i, a, b, _), s, k in zip(open_, best, keyed):
                if s >= model.least[0 if k else 1]:
                    spans[i].append({"kind": "learned", "start": a, "end": b, "score": float(s)})
            for i in {i for i, *_ in open_}:
                spans[i].sort(key=lambda x: (x["start"], KINDS.index(x["kind"])))
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return rows(**{c: batch.column(c) for c in names}, spans=pa.array(spans, kind))

    types = dict(inputs.dtypes)
    return mapped(inputs, each, ", ".join(f"{c} {types[c]}" for c in names) + f", spans {SPANS}").toDF(*carry, "spans")
