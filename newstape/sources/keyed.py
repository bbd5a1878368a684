"""Keyed tables: Parquet in partitions, merged by dynamic partition overwrite.

A merge reads the partitions its batch touches, joins them with the batch, and writes
them anew with Spark's ``partitionOverwriteMode=dynamic``: new files are written beside
the table and take the place of the old ones when all tasks are done, so a job that fails
before leaves the table as it was.  Merging the same batch again gives the same table,
so a job that was killed while partitions were switched is simply run again.  A table has
one writer at a time; where a catalog offers transactions (``MERGE INTO``), use its tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newstape.session import fresh_path, remove

#: hash partitions of a table whose keys have no natural order
PARTITIONS = 16
PART = T.StructField("_part", T.StringType())
#: tables and landed batches are written smaller than with Spark's default
CODEC = "zstd"
#: about how many rows of a partition a merge inside partitions puts into one file
TOGETHER = 1_000_000


def by_hash(keys: Sequence[str], partitions: int = PARTITIONS) -> Column:
    """With the hash that Spark shuffles by, so a task of a shuffle by the keys meets few partitions."""
    return F.pmod(F.hash(*keys), F.lit(partitions)).cast("string")


def by_month(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


class KeyedTable:
    """A table unique by ``keys``.

    ``part`` gives the partition of a new row.  A stored row stays where it is, so ``part``
    may look at more than the key: then a merge first looks up where the keys of its batch
    lie (``part_of_key=False``), by their hashes and only in partitions that the batch does
    not touch anyway; a hash met by chance rewrites a partition as it was.

    ``rebalance=False`` leaves out the shuffle by partition before the files are written.
    It suits :func:`by_hash` of the keys, where what a merge joined by key lies well already.

    ``derived`` holds columns of the schema that follow from others.  They are computed as
    files are written: merges neither read nor shuffle them, and batches need not have them.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], part: Column,
        part_of_key: bool = True, rebalance: bool = True, derived: dict[str, Column] | None = None,
    ):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.part, self.part_of_key, self.rebalance = F.coalesce(part, F.lit("none")), part_of_key, rebalance
        self.derived = derived or {}

    def _stored(self, schema: T.StructType) -> DataFrame | None:
        """What is stored, with ``_part``; None before the first merge."""
        schema = T.StructType([f for f in schema.fields if f.name != PART.name] + [PART])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _nothing(self) -> DataFrame:
        """No rows, in a form that Spark knows to be empty when it plans."""
        fields = [f for f in self.schema.fields if f.name != PART.name] + [PART]
        return self.spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    def read(self) -> DataFrame:
        """The current rows."""
        stored = self._stored(self.schema)
        return (self._nothing() if stored is None else stored).select(*self.schema.names)

    def _touched(self, batch: DataFrame) -> list[str]:
        """The partitions a batch touches, at most as many as the table has."""
        parts = [r[0] for r in batch.select(PART.name).distinct().collect()]
        if self.part_of_key:
            return parts
        others = self._stored(self.schema).where(~F.col(PART.name).isin(parts))
        if others.isEmpty():
            return parts
        sought = batch.select(F.xxhash64(*self.keys).alias("_key")).distinct()
        met = others.select(F.xxhash64(*self.keys).alias("_key"), PART.name).join(sought, "_key", "left_semi")
        return parts + [r[0] for r in met.select(PART.name).distinct().collect()]

    def _slot(self, stored: DataFrame, batch: DataFrame) -> Column:
        """Deals the keys of each partition into slots of about :data:`TOGETHER` rows."""
        sizes = stored.select(PART.name).unionAll(batch.select(PART.name)).groupBy(PART.name).count().collect()
        if not sizes:
            return F.lit(0).cast("long")
        slots = F.create_map(*[F.lit(x) for part, n in sizes for x in (part, -(-n // TOGETHER))])
        return F.pmod(F.xxhash64(*self.keys), F.element_at(slots, F.col(PART.name)))

    def _write(self, merged: DataFrame, rebalance: bool) -> T.StructType:
        laid = merged.hint("rebalance", PART.name) if rebalance else merged
        whole = laid.withColumns(self.derived) if self.derived else laid
        (
            whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
            .partitionBy(PART.name).parquet(self.path)
        )
        return whole.schema

    def merge(
        self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], landed: bool = False, laid: bool = False,
        within: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Merge a batch and return every row of the touched partitions, with all columns of ``combine``.

        The batch is written first where the table has rows, so whatever it takes to compute it
        happens once; ``landed`` says that it is a table already.  ``combine`` gets the stored
        rows of the touched partitions and the batch, both with a column ``_part``, reads the
        batch once and returns at least the stored columns; the others are kept in the files,
        where readers do not look.  ``laid`` says that the batch lies by partition already, so
        that a new table can be written as it lies.  ``within`` takes the place of ``combine``
        where the table has rows and the key decides the partition: both its frames have a
        column ``_slot`` as well, and what it returns lies by (``_part``, ``_slot``) and is
        written as it lies.
        """
        stored = self._stored(self.schema)
        if stored is None:
            nothing = self._nothing().drop(*self.derived)
            schema = self._write(combine(nothing, batch.withColumn(PART.name, self.part)), self.rebalance and not laid)
            return self._stored(schema).drop(PART.name)
        path = None
        if not landed:
            path = fresh_path(self.spark, "incoming")
            batch.write.option("compression", CODEC).parquet(path)
            batch = self.spark.read.schema(batch.schema).parquet(path)
        batch = batch.withColumn(PART.name, self.part)
        parts = self._touched(batch)
        old = stored.where(F.col(PART.name).isin(parts)).drop(*self.derived)
        if within and self.part_of_key:
            slot = self._slot(old, batch)
            schema = self._write(within(old.withColumn("_slot", slot), batch.withColumn("_slot", slot)).drop("_slot"), False)
        else:
            schema = self._write(combine(old, batch), self.rebalance)
        if path:
            remove(self.spark, path)
        return self._stored(schema).where(F.col(PART.name).isin(parts)).drop(PART.name)
