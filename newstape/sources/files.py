"""CSV and Parquet tables with a column check, and facts read from file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from newstape.errors import LoadError
from newstape.functions.numeric import null_if_nan
from newstape.functions.text import lenient_timestamp

#: Names of landed and produced files.  The tag of an archive file is its first year.
FILE_NAMES = {
    "archive": r"^([A-Z]+)_gdelt_(\d{4})-\d{2}-\d{2}_\d{4}-\d{2}-\d{2}\.csv$",
    "feed": r"^([A-Z]+)_news_(\d{4}-\d{2}-\d{2})\.csv$",
    "sentiment": r"^([A-Z]+)_sentiment_(.+)\.csv$",
}


def typed(value: Column, kind: T.DataType, have: T.DataType = T.StringType()) -> Column:
    """Read a value as a type; what cannot be read, and NaN, become NULL."""
    if isinstance(kind, T.DoubleType) and isinstance(have, (T.DoubleType, T.FloatType)):
        return null_if_nan(value.cast("double"))
    if have == kind:
        return value
    if isinstance(kind, T.StringType):
        return value.cast("string")
    if not isinstance(have, T.StringType):
        value = value.cast("string")
    if isinstance(kind, T.TimestampType):
        return lenient_timestamp(value)
    if isinstance(kind, T.DateType):
        return F.substring(value.cast("string"), 1, 10).try_cast("date")
    number = null_if_nan(value.try_cast("double"))
    return number if isinstance(kind, T.DoubleType) else number.try_cast(kind)


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise LoadError(f"{what} lacks required columns: {missing}; it has {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns named in the schema get its types; other columns stay as they are."""
    kinds = {f.name: f.dataType for f in schema.fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[typed(F.col(c), kinds[c], have[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def load_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    required: Sequence[str] = ("ticker", "date"),
    fmt: str = "csv",
    multi_line: bool = False,
) -> DataFrame:
    """Read CSV (by header name, no type inference) or Parquet and check the required columns.

    ``multi_line`` is needed for texts with line breaks and makes a CSV file unsplittable.
    """
    try:
        if fmt == "csv":
            reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
            raw = reader.csv(path)
        else:
            raw = spark.read.format(fmt).load(path)
    except AnalysisException as problem:
        raise LoadError(f"cannot read {path}: {problem}") from problem
    if not raw.columns:
        raise LoadError(f"{path} is empty")
    require_columns(raw, required, str(path))
    return conform(raw, schema)


def file_facts(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add ``kind``, ``file_ticker`` and ``tag`` from a column of file names; NULL for unknown names."""
    text = F.col(name)
    kind, ticker, tag = F.lit(None), F.lit(None), F.lit(None)
    for label, pattern in reversed(FILE_NAMES.items()):
        hit = text.rlike(pattern)
        kind = F.when(hit, F.lit(label)).otherwise(kind)
        ticker = F.when(hit, F.regexp_extract(text, pattern, 1)).otherwise(ticker)
        tag = F.when(hit, F.regexp_extract(text, pattern, 2)).otherwise(tag)
    return df.withColumns({"kind": kind, "file_ticker": ticker, "tag": tag})


def load_named_files(
    spark: SparkSession, pattern: str, schema: T.StructType, tickers: Sequence[str] | None = None,
    required: Sequence[str] = ("url",), tag: str | None = None,
) -> DataFrame:
    """Read the CSV files a glob matches, with the facts from their names; an unknown name is an error.

    ``tickers`` and ``tag`` choose files by name, from a listing; no other file is opened.
    :func:`file_report` says which tickers have none.
    """
    listed = file_facts(_listed(spark, pattern))
    unknown = listed.where(F.col("file_ticker").isNull()).limit(1).collect()
    if unknown:
        raise LoadError(f"cannot infer a ticker from file name {unknown[0]['file_name']}")
    if tickers:
        listed = listed.where(F.col("file_ticker").isin([t.upper() for t in tickers]))
    if tag is not None:
        listed = listed.where(F.col("tag") == tag)
    paths = [r["path"] for r in listed.select("path").collect()]  # of the files asked for
    if not paths:
        raw = conform(spark.createDataFrame([], schema), schema).withColumn("file_name", F.lit(None).cast("string"))
    else:
        raw = load_table(spark, paths, schema, required, multi_line=True).withColumn("file_name", F.col("_metadata.file_name"))
    return file_facts(raw)


def _listed(spark: SparkSession, pattern: str) -> DataFrame:
    """``path`` and ``file_name`` of the files of a glob; their contents are not read."""
    try:
        listed = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as problem:
        raise LoadError(f"cannot read {pattern}: {problem}") from problem
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))


def file_report(spark: SparkSession, folder: str, tickers: Sequence[str] | None = None, tag: str | None = None) -> DataFrame:
    """(ticker, files, status) of the named files in a folder; a ticker asked for without a file is ``missing``.

    Only names are read.  Without ``tickers`` every ticker found has a row.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    names = file_facts(listed.select(F.element_at(F.split("path", "/"), -1).alias("file_name")))
    names = names.where(F.col("file_ticker").isNotNull())
    if tag is not None:
        names = names.where(F.col("tag") == tag)
    found = names.groupBy(F.col("file_ticker").alias("ticker")).agg(F.count(F.lit(1)).alias("files"))
    if tickers:
        asked = spark.createDataFrame([(t.upper(),) for t in dict.fromkeys(tickers)], "ticker string")
        found = asked.join(found, "ticker", "left")
    count = F.coalesce("files", F.lit(0))
    return found.select("ticker", count.alias("files"), F.when(count > 0, "ok").otherwise("missing").alias("status"))
