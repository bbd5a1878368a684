"""Helpers shared by the operators: session settings, staged tables, Arrow buffers, row identity."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newstape.session import tidy, work_folder  # noqa: F401

#: stands for a NULL id wherever ids are compared or ordered: below every other id
NO_ID = -(2**63)

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # whole texts travel in Arrow batches: keep a batch to some megabytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


#: where this package lies; Python workers look there too (a cluster ships it with --py-files)
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from there: cuts the lineage, survives lost executors."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def text_of(column: str = "text") -> Column:
    """A text column where NULL counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, ``_h`` and ``_text`` of every row, free of the input's other columns.

    (id, hash of the text) names a row; rows equal in both are repeats, which every
    operator treats alike.
    """
    text = text_of(text_col)
    return docs.select(id_of(id_col).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))


def matched(
    docs: DataFrame, side: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False
) -> DataFrame:
    """``docs`` joined with ``side`` on row identity (``_id``, ``_h``).

    The input's columns travel under neutral names and come back under their own, so
    none can clash; with ``keep`` they stay neutral (``_c0`` ...), for further work.
    """
    names = docs.columns
    plain = docs.toDF(*neutral(docs))
    at = {c: f"_c{k}" for k, c in enumerate(names)}
    keyed = plain.withColumns({"_id": id_of(at[id_col]), "_h": F.xxhash64(text_of(at[text_col]))})
    out = keyed.join(side, ["_id", "_h"], how)
    return out if keep else out.select(*neutral(docs)).toDF(*names)


def neutral(docs: DataFrame) -> list[str]:
    return [f"_c{k}" for k in range(len(docs.columns))]


def id_back(column: str = "_id") -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def mapped(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with one function per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = each(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column without NULLs as its bytes and the offsets between rows."""
    whole = pc.cast(column, pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], np.int64, len(whole) + 1, whole.offset * 8)
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> list[bytes]:
    return pc.cast(column, pa.binary()).to_pylist()


def longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


def unstage(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
