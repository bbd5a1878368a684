"""Writers.  Partitioned writes are rebalanced first, so a busy day or ticker
becomes several files instead of one long task, and quiet ones do not scatter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def range_tag(start: dt.date, end: dt.date) -> str:
    """``<day>`` or ``<start>_<end>``."""
    return f"{start:%Y-%m-%d}" if start == end else f"{start:%Y-%m-%d}_{end:%Y-%m-%d}"


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> str:
    writer = df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).format(fmt)
    if fmt == "csv":
        # readers tell by the names of the files
        writer = writer.option("header", True).option("escape", '"').option("compression", "gzip")
    writer.save(path)
    return path


def _write_days(df: DataFrame, path: str, fmt: str, by_month: bool) -> str:
    """One directory per date, or per month where a day's rows would make a tiny file."""
    if not by_month:
        return write_partitioned(df, path, "date", fmt)
    return write_partitioned(df.withColumn("month", F.date_format("date", "yyyy-MM")), path, "month", fmt)


def write_features(
    features: DataFrame, folder: str, start: dt.date, end: dt.date, fmt: str = "parquet", by_month: bool = False
) -> str:
    """``feature_dataset_<start>_<end>``."""
    tag = f"{start:%Y-%m-%d}_{end:%Y-%m-%d}"
    return _write_days(features, f"{folder}/feature_dataset_{tag}", fmt, by_month)


def write_dataset(
    dataset: DataFrame, folder: str, start: dt.date, end: dt.date, fmt: str = "parquet", by_month: bool = False
) -> str:
    """``ml_dataset_<tag>``."""
    return _write_days(dataset, f"{folder}/ml_dataset_{range_tag(start, end)}", fmt, by_month)


def write_enriched(articles: DataFrame, folder: str, tag: str, fmt: str = "parquet") -> str:
    """``news_sentiment_<tag>``, one directory per ticker; tickers without rows have none."""
    return write_partitioned(articles, f"{folder}/news_sentiment_{tag}", "ticker", fmt)


def write_predictions(predictions: DataFrame, path: str, fmt: str = "parquet") -> str:
    writer = predictions.write.mode("overwrite").format(fmt).option("header", True)
    (writer.option("escape", '"') if fmt == "csv" else writer).save(path)
    return path


def write_report(report: DataFrame, path: str, fmt: str = "json") -> str:
    """A report of a few rows (one per class, ticker or column) as one file."""
    report.coalesce(1).write.mode("overwrite").format(fmt).option("header", True).save(path)
    return path


def write_raw(articles: DataFrame, folder: str, kind: str, tag: str, fmt: str = "parquet") -> str:
    """``<kind>_<tag>``: fetched articles before scoring, one directory per ticker."""
    return write_partitioned(articles, f"{folder}/{kind}_{tag}", "ticker", fmt)


def write_summary(summary: DataFrame, folder: str, job: str, tag: str, fmt: str = "csv") -> str:
    """``summary_<job>_<tag>``: a job's report of a row per ticker, as one file."""
    return write_report(summary, f"{folder}/summary_{job}_{tag}", fmt)


def read_written(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """What a sink wrote, with the schema it was written with.

    Nothing is inferred, so a ticker of digits stays text, also as a directory name; CSV
    texts may hold quotes and line breaks; an empty text comes back as NULL.
    """
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(path).select(*schema.names)
