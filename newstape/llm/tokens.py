"""Token ids of whole texts by a public word-level BPE vocabulary, with a table of words seen.

The vocabulary drops white space and merges only inside words, so the ids of a run of
characters between blanks do not depend on its neighbours.  A worker keeps the ids of
the runs it has met.  Texts with characters whose folding or classes could depend on a
library's Unicode version, or with the vocabulary's special strings, go to the
tokenizer whole.  The ids are those of the tokenizer itself.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: entries of a worker's word table; it starts anew when full, ids do not depend on it
WORD_TABLE = 120_000
#: ASCII, Latin-1 and Latin Extended without number forms: no combining marks, nothing to
#: normalise, plain lower case
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u201f\u2026\u20ac]*+")
#: fixed values: the vocabulary's word pattern, for plain texts
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


def _byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class _Words(dict):
    """Numbers words in the order of their first lookup."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    def __init__(self, path: str | None = None, table: int = WORD_TABLE):
        self.table = table
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path or default_path())
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.words = _Words()
        self.parts: dict[str, list[int]] = {}
        self.flat = np.empty(1 << 16, "<u4")  # ids of all words, end to end
        self.ends = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        if len(self.words) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(len(self.words), len(self.ends)), np.int64)])
        parts, tokenize, split = self.parts, self.whole.model.tokenize, PARTS.findall
        ids: list[int] = []
        ends: list[int] = []
        for word in new:
            for part in split(word):
                known = parts.get(part)
                if known is None:
                    letters = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)
                    known = parts[part] = [t.id for t in tokenize(letters)]
                ids += known
            ends.append(len(ids))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.ends[len(self.words) - len(new) : len(self.words)] = self.used + np.array(ends, np.int64)
        self.used += len(ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without special tokens."""
        if len(self.words) > self.table:
            self._forget()
        lookup = self.words.__getitem__
        split: list[np.ndarray | None] = []
        for text in texts:
            if PLAIN.fullmatch(text) and not ("<|" in text and any(s in text for s in self.special)):
                words = text.lower().split()
                split.append(np.fromiter(map(lookup, words), np.int64, len(words)))
            else:
                split.append(None)
        self._learn()
        out = []
        for text, words in zip(texts, split):
            if words is None:
                out.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4"))
                continue
            ends = self.ends[words]
            starts = np.where(words > 0, self.ends[words - 1], 0)
            sizes = ends - starts
            step = np.cumsum(sizes)
            out.append(self.flat[np.repeat(ends - step, sizes) + np.arange(step[-1] if len(step) else 0)])
        return out


_loaded: dict[tuple, Encoder] = {}


def encoder(path: str | None = None, table: int = WORD_TABLE) -> Encoder:
    """The worker's encoder, loaded once; a larger table of words takes more room and less time."""
    if (path, table) not in _loaded:
        _loaded[path, table] = Encoder(path, table)
    return _loaded[path, table]
