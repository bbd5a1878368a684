"""Company phrases in article texts, and coverage of the archive's request windows."""

from __future__ import annotations

import datetime as dt
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StringType, StructField, StructType

from newstape.functions.text import words_of
from newstape.schemas import ARCHIVE_CHUNK_DAYS, ARCHIVE_REQUEST_CAP, COMPANY_PHRASES
from newstape.session import fresh_path, workers_import


def phrase_of(ticker: str, phrases: Mapping[str, str] = COMPANY_PHRASES) -> str:
    """The company phrase of a ticker; an unknown ticker stands for itself."""
    return phrases.get(ticker.upper(), ticker.upper())


#: bytes of phrases up to which an automaton is built from them, and bits of the table used beyond
AUTOMATON_BYTES, TABLE_BITS = 4 << 20, 1 << 27
#: bits of the table are gathered in pieces of so many bytes
PIECE = 1 << 16


class Automaton:
    """Aho-Corasick over words: all phrases that end at each word, in one pass over the words."""

    def __init__(self, phrases: Iterable[tuple[str, Any]]):
        self.steps: list[dict[str, int]] = [{}]
        self.found: list[tuple] = [()]
        for phrase, ticker in phrases:
            at = 0
            for word in phrase.split(" "):
                after = self.steps[at].get(word)
                if after is None:
                    after = self.steps[at][word] = len(self.steps)
                    self.steps.append({})
                    self.found.append(())
                at = after
            if ticker not in self.found[at]:
                self.found[at] += (ticker,)
        self.fallback = [0] * len(self.steps)
        line = deque(self.steps[0].values())
        while line:
            at = line.popleft()
            for word, after in self.steps[at].items():
                back = self.fallback[at]
                while back and word not in self.steps[back]:
                    back = self.fallback[back]
                self.fallback[after] = back = self.steps[back].get(word, 0)
                self.found[after] += tuple(t for t in self.found[back] if t not in self.found[after])
                line.append(after)

    def tickers(self, text: str) -> set:
        """Tickers of the phrases among the words of a text."""
        steps, found, fallback = self.steps, self.found, self.fallback
        out: set = set()
        at = 0
        for word in text.split(" "):
            after = steps[at].get(word)
            while after is None and at:
                at = fallback[at]
                after = steps[at].get(word)
            at = after or 0
            if found[at]:
                out.update(found[at])
        return out


def tag(articles: DataFrame, phrases: DataFrame, key: str, text: str = "title", limit: int = AUTOMATON_BYTES, unique: bool = False) -> DataFrame:
    """(key, ticker) pairs, each once, where a phrase of the ticker occurs in the text as whole words.

    The size of ``phrases`` (ticker, phrase) is looked up first.  Up to ``limit`` bytes an
    automaton of them is broadcast and each text is read once where it lies.  Beyond, a bit
    table of fixed size is broadcast, texts give those runs of words that the table does not
    rule out, and these, most of them real phrases, join the phrases.  Either way no text
    leaves its task.  Phrases without a word match nothing.  ``unique`` says that no two
    articles have the same key, so that the automaton's pairs are not compared again.
    """
    spark = articles.sparkSession
    workers_import(spark)
    known = phrases.select(F.trim(words_of(F.col("phrase"))).alias("phrase"), "ticker").where("phrase <> ''").distinct()
    # written once, as phrases may be cut from texts; blank texts are not looked for, which would cut texts twice
    path = fresh_path(spark, "phrases")
    known.write.parquet(path)
    known = spark.read.schema(known.schema).parquet(path)
    texts = articles.select(key, F.coalesce(F.trim(words_of(F.col(text))), F.lit("")).alias("_words"))
    size = known.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    if size <= limit:
        pairs = _by_automaton(texts, known, key)
        return pairs if unique else pairs.distinct()
    return _by_table(texts, known, key).join(known, "phrase").select(key, "ticker").distinct()


def _pairs(texts: DataFrame, key: str, name: str, kind: DataType, load: Callable[[], Callable[[str], Iterable]]) -> DataFrame:
    """``key`` with each value that the loaded function gives for a text, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = load()
        for batch in batches:
            owner, values = [], []
            for k, words in enumerate(batch.column("_words").to_pylist()):
                found = each(words)
                values.extend(found)
                owner += [k] * len(found)
            if owner:
                out = pa.array(values, to_arrow_type(kind))
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(owner)), out], [key, name])

    return texts.mapInArrow(run, StructType([texts.schema[key], StructField(name, kind)]))


def _by_automaton(texts: DataFrame, known: DataFrame, key: str) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(Automaton(tuple(r) for r in known.collect()))
    return _pairs(texts, key, "ticker", known.schema["ticker"].dataType, lambda: shared.value.tickers)


def _by_table(texts: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Runs of words of each text, as long as some phrase, that the bit table of phrases does not rule out."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(TABLE_BITS >> 3, np.uint8)
        for batch in batches:
            at = np.fromiter((zlib.crc32(p.encode()) % TABLE_BITS for p in batch.column(0).to_pylist()), np.int64)
            np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        pieces = bits.reshape(-1, min(PIECE, len(bits)))
        used = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([pieces[k].tobytes() for k in used], pa.binary())], ["piece", "bits"])

    def joined(some: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in some.column("bits").to_pylist()])
        return pa.table({"piece": some.column("piece").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})

    kinds = "piece int, bits binary"
    pieces = known.select("phrase").mapInArrow(marked, kinds).groupBy("piece").applyInArrow(joined, kinds)
    table = np.zeros(TABLE_BITS >> 3, np.uint8).reshape(-1, min(PIECE, TABLE_BITS >> 3))
    for row in pieces.collect():  # of fixed size, however many phrases there are
        table[row.piece] = np.frombuffer(row.bits, np.uint8)
    lengths = sorted(r[0] for r in known.select(F.size(F.split("phrase", " "))).distinct().collect())
    shared = texts.sparkSession.sparkContext.broadcast(table.tobytes())

    def load():
        bits, longest, wanted = shared.value, lengths[-1], set(lengths)

        def runs(text: str) -> set:
            words = text.split(" ")
            raw = [w.encode() for w in words]
            out = set()
            for at in range(len(words)):
                hashed = zlib.crc32(raw[at])
                for n in range(1, min(longest, len(words) - at) + 1):
                    if n > 1:
                        hashed = zlib.crc32(raw[at + n - 1], zlib.crc32(b" ", hashed))
                    slot = hashed % TABLE_BITS
                    if n in wanted and bits[slot >> 3] >> (slot & 7) & 1:
                        out.add(" ".join(words[at : at + n]))
            return out

        return runs

    return _pairs(texts, key, "phrase", StringType(), load)


def coverage(
    articles: DataFrame,
    tickers: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    chunk_days: int = ARCHIVE_CHUNK_DAYS,
    cap: int = ARCHIVE_REQUEST_CAP,
) -> DataFrame:
    """Articles per (ticker, request window) over ``[start, end]``, empty windows included.

    A window's number follows from the timestamp, so counting is one grouping and
    the calendar is attached by an equi-join.  ``possibly_truncated`` marks windows
    that reached the archive's cap on one answer.
    """
    length = chunk_days * 86400
    chunks = int((end - start).total_seconds()) // length + 1
    origin = F.lit(start).cast("timestamp")
    inside = (F.col("published_at") >= origin) & (F.col("published_at") <= F.lit(end).cast("timestamp"))
    number = F.floor((F.unix_micros("published_at") - F.unix_micros(origin)) / (length * 1_000_000))
    counted = articles.where(inside).groupBy("ticker", number.alias("chunk")).agg(F.count(F.lit(1)).alias("_n"))
    grid = tickers.select("ticker").distinct().select(
        "ticker", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk")
    )
    first = F.timestamp_micros(F.unix_micros(origin) + F.col("chunk") * (length * 1_000_000))
    last = F.least(
        F.timestamp_micros(F.unix_micros(origin) + (F.col("chunk") + 1) * (length * 1_000_000) - 1_000_000),
        F.lit(end).cast("timestamp"),
    )
    count = F.coalesce("_n", F.lit(0))
    return grid.join(counted, ["ticker", "chunk"], "left").select(
        "ticker", "chunk", first.alias("chunk_start"), last.alias("chunk_end"),
        count.alias("article_count"), (count >= cap).alias("possibly_truncated"),
    )


def phrase_table(spark, tickers: Sequence[str], phrases: Mapping[str, str] = COMPANY_PHRASES) -> DataFrame:
    return spark.createDataFrame([(t.upper(), phrase_of(t, phrases)) for t in tickers], "ticker string, phrase string")
