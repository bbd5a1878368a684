"""Keyed merges: deduplication, upsert, and its accounting.

Copies of one key are reduced with aggregates that combine on the map side, so a key
with very many copies never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from newstape.functions.text import article_key

#: What a repeated article, result or price refreshes.
ARTICLE_REFRESH = ["source_name", "title", "description", "fetched_at"]
SENTIMENT_KEY = ["article_id", "model_name"]
SENTIMENT_REFRESH = ["sentiment_label", "sentiment_score", "sentiment_confidence", "analysed_at"]
PRICE_KEY = ["ticker", "trading_date"]
PRICE_REFRESH = ["open_price", "high_price", "low_price", "close_price", "adjusted_close", "volume"]


def keep_first(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """One row per key, the earliest by ``seq`` (an order without NULLs); of rows equal in ``seq`` one.

    Copies of a key are reduced before the shuffle, and every row is shuffled at most once.
    The other columns travel whole, so select those that are needed first.
    """
    rest = [c for c in df.columns if c not in keys and c != seq]
    # the least ``seq`` is an aggregate of its own, which Spark drops where nobody asks for it
    one = df.groupBy(*keys).agg(F.min_by(F.struct(F.lit(1).alias("_any"), *rest), seq).alias("_row"), F.min(seq).alias(seq))
    return one.select(*[F.col(c) if c in keys or c == seq else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _folded(incoming: DataFrame, keys, fixed, refresh, seq, unique) -> DataFrame:
    """One incoming row per key: the first row's fixed columns, the last row's refreshed ones."""
    if unique:
        first, last = (F.struct(F.lit(1).alias("_any"), *values) for values in (fixed, refresh))
        return incoming.select(*keys, first.alias("_first"), last.alias("_last"), F.lit(1).cast("long").alias("_copies"))
    order = F.col(seq) if seq else F.lit(0)
    return incoming.groupBy(*keys).agg(
        F.min_by(F.struct(F.lit(1).alias("_any"), *fixed), order).alias("_first"),
        F.max_by(F.struct(F.lit(1).alias("_any"), *refresh), order).alias("_last"),
        F.count(F.lit(1)).alias("_copies"),
    )


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    refresh: Sequence[str],
    seq: str | None = None,
    known: DataFrame | None = None,
    carry: Sequence[str] = (),
    latest: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """The merged table plus ``_action`` (insert, update, keep) and ``_copies`` (incoming rows of the key).

    ``existing`` is unique by ``keys``.  Inside a batch the first row of a new key
    inserts and later ones update it, in ``seq`` order; without ``seq`` a repeated key
    fails the job, because nothing says which row is the last.  A stored key keeps
    every column that is not refreshed.

    One full outer join by key.  A table of any size is kept by
    :class:`~newstape.sources.keyed.KeyedTable`, which hands over only the partitions
    that the batch touches.  ``known`` (some of the key columns, unique) leaves out
    batch keys that are not in it, after the copies of a key have been reduced to one
    row.  ``carry`` adds ``_first_<column>``: what the key's first incoming row holds there;
    ``latest`` adds ``_last_<column>``: what its last one does.  ``unique`` says that the
    batch is known to have one row per key, so nothing is folded or checked.
    """
    columns = existing.columns
    fixed = [c for c in columns if c not in keys and c not in refresh]
    carried, latest_ones = ([F.col(c).alias(f"_carry_{c}") for c in names] for names in (carry, latest))
    batch = _folded(incoming, keys, [*fixed, *carried], [*refresh, *latest_ones], seq, unique)
    if known is not None:
        batch = batch.join(known, known.columns, "left_semi")
    stored = existing.withColumn("_stored", F.lit(True))
    joined = stored.join(batch, list(keys), "full_outer")

    is_stored, is_incoming = F.col("_stored").isNotNull(), F.col("_copies").isNotNull()

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name in refresh:
            return F.when(is_incoming, F.col(f"_last.{name}")).otherwise(F.col(name)).alias(name)
        return F.when(is_stored, F.col(name)).otherwise(F.col(f"_first.{name}")).alias(name)

    action = F.when(~is_incoming, "keep").when(is_stored, "update").otherwise("insert")
    if seq is None and not unique:
        repeated = F.raise_error(F.lit(f"the batch repeats a key of {list(keys)}: name the column that orders its rows"))
        action = F.when(F.col("_copies") > 1, repeated).otherwise(action)
    return joined.select(
        *[value(c) for c in columns], action.alias("_action"), F.coalesce("_copies", F.lit(0)).alias("_copies"),
        *[F.col(f"_first._carry_{c}").alias(f"_first_{c}") for c in carry],
        *[F.col(f"_last._carry_{c}").alias(f"_last_{c}") for c in latest],
    )


def upsert_within(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], refresh: Sequence[str], lies: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """:func:`upsert` of a batch with one row per key, where rows of a key are equal in the columns ``lies`` too.

    Both are shuffled once, by ``lies``, and so the result lies; there is no join.
    """
    columns = [c for c in existing.columns if c not in keys and c not in lies]
    extra = [f"_carry_{c}" for c in carry]
    new = incoming.select(*lies, *keys, *columns, *[F.col(c).alias(x) for c, x in zip(carry, extra)], F.lit(True).alias("_fresh"))
    old = existing.select(*lies, *keys, *columns, F.lit(False).alias("_fresh"))
    rows = old.unionByName(new, allowMissingColumns=True).repartition(*lies)
    one = rows.groupBy(*lies, *keys).agg(
        F.first(F.when(~F.col("_fresh"), F.struct(F.lit(1).alias("_any"), *columns)), ignorenulls=True).alias("_stored"),
        F.first(F.when(F.col("_fresh"), F.struct(F.lit(1).alias("_any"), *columns, *extra)), ignorenulls=True).alias("_new"),
    )
    is_stored, is_incoming = F.col("_stored").isNotNull(), F.col("_new").isNotNull()

    def value(name: str) -> Column:
        if name in columns:
            first, other = ("_new", "_stored") if name in refresh else ("_stored", "_new")
            return F.when(F.col(first).isNotNull(), F.col(f"{first}.{name}")).otherwise(F.col(f"{other}.{name}")).alias(name)
        return F.col(name)

    action = F.when(~is_incoming, "keep").when(is_stored, "update").otherwise("insert")
    return one.select(
        *[value(c) for c in existing.columns], action.alias("_action"), is_incoming.cast("long").alias("_copies"),
        *[F.col(f"_new.{x}").alias(f"_first_{c}") for c, x in zip(carry, extra)],
    )


def upsert_articles(existing: DataFrame, incoming: DataFrame, seq: str | None = None, **options) -> DataFrame:
    """Merge articles by url; rows without a url are left out (see :func:`accounting`)."""
    return upsert(existing, incoming.where(F.col("url") != ""), ["url"], ARTICLE_REFRESH, seq, **options)


def attach_articles(records: DataFrame, articles: DataFrame) -> DataFrame:
    """Sentiment records with the id of their article; NULL where the url is unknown.

    Rows without a url, which may be many, have no article and stay out of the join.
    """
    named = F.coalesce(F.col("url") != "", F.lit(False))
    linked = records.where(named).join(articles.select("url", "article_id"), "url", "left")
    kind = articles.schema["article_id"].dataType
    return linked.unionByName(records.where(~named).withColumn("article_id", F.lit(None).cast(kind)))


def upsert_sentiments(
    existing: DataFrame, records: DataFrame, articles: DataFrame, model_name: str, seq: str | None = None, **options
) -> DataFrame:
    """Merge one model's results; other models' rows are not touched, unknown urls are skipped.

    An article's id is a function of its url, so records find theirs without a join
    and only one row per article is checked against the stored articles.
    """
    keyed = records.where(F.col("url") != "").withColumns(
        {"article_id": article_key(F.col("url")), "model_name": F.lit(model_name)}
    )
    return upsert(
        existing, keyed, SENTIMENT_KEY, SENTIMENT_REFRESH, seq, known=articles.select("article_id"), **options
    )


def upsert_prices(existing: DataFrame, incoming: DataFrame, seq: str | None = None, **options) -> DataFrame:
    """Merge price rows; a repeated day refreshes every value."""
    return upsert(existing, incoming, PRICE_KEY, PRICE_REFRESH, seq, **options)


def accounting(merged: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """One row: inserted, updated, skipped, total.

    A new key counts once as inserted; its further copies, and every copy of a
    stored key, count as updated.  ``skipped`` holds the rows that were left out.
    """
    inserted = F.sum(F.when(F.col("_action") == "insert", 1).otherwise(0))
    updated = F.sum(
        F.when(F.col("_action") == "insert", F.col("_copies") - 1)
        .when(F.col("_action") == "update", F.col("_copies")).otherwise(0)
    )
    parts = merged.agg(inserted.alias("inserted"), updated.alias("updated")).withColumn("skipped", F.lit(0).cast("long"))
    if skipped is not None:
        left_out = skipped.agg(F.count(F.lit(1)).alias("skipped")).select(
            F.lit(0).cast("long").alias("inserted"), F.lit(0).cast("long").alias("updated"), "skipped"
        )
        parts = parts.unionByName(left_out)
    return parts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("inserted", "updated", "skipped")]
    ).withColumn("total", F.col("inserted") + F.col("updated"))


def accounting_by(incoming: DataFrame, by: str, valid: Column, inserted: DataFrame | None = None) -> DataFrame:
    """inserted, updated and skipped per value of ``by`` (a ticker, a file).

    ``inserted`` holds the rows that a merge inserted, with ``by`` of their first incoming
    row; every other valid row is an update.  A row whose validity is unknown is skipped.
    """
    sure = F.coalesce(valid, F.lit(False))
    rows = incoming.groupBy(by).agg(F.count_if(sure).alias("_used"), F.count_if(~sure).alias("skipped"))
    if inserted is None:
        return rows.select(by, F.lit(0).cast("long").alias("inserted"), F.col("_used").alias("updated"), "skipped")
    fresh = inserted.groupBy(F.col(by).alias("_by")).agg(F.count(F.lit(1)).alias("inserted"))
    count = F.coalesce("inserted", F.lit(0))
    return rows.join(fresh, F.col(by).eqNullSafe(F.col("_by")), "left").select(
        by, count.alias("inserted"), (F.col("_used") - count).alias("updated"), "skipped"
    )
