"""DuckDB text of the sample views, shared by the oracle statements."""

from __future__ import annotations

CTES = {
    "line_articles": """
        SELECT p_brand AS ticker,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey AS source_id,
               CASE (l_orderkey + l_linenumber) % 5 WHEN 0 THEN 'Yahoo Finance' WHEN 1 THEN 'Benzinga'
                    WHEN 2 THEN 'CNBC' WHEN 3 THEN 'Reuters' END AS source_name,
               CAST(NULL AS VARCHAR) AS author,
               p_name AS title, l_returnflag AS description,
               'http://news.example/' || l_orderkey || '/' || l_linenumber AS url,
               o_orderdate AS published_at,
               CAST(NULL AS VARCHAR) AS content,
               l_shipdate AS fetched_at,
               CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'N' THEN 'neutral' ELSE 'negative' END AS sentiment_label,
               CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 ELSE -1 END AS sentiment_score,
               l_tax + 0.5e0 AS sentiment_confidence,
               l_shipdate AS analysed_at,
               (l_extendedprice, l_quantity, l_partkey, l_suppkey, l_discount, l_tax,
                l_shipdate, l_returnflag, l_linestatus) AS seq,
               l_linestatus AS batch,
               CAST(o_orderdate AS DATE) AS date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "line_prices": """
        SELECT ticker, trading_date, arg_min(px, (k, px)) AS open_price, max(px) AS high_price,
               min(px) AS low_price, arg_max(px, (k, px)) AS close_price,
               CAST(sum(q) AS BIGINT) AS volume
        FROM (SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trading_date,
                     l_extendedprice / l_quantity AS px, l_orderkey * 10 + l_linenumber AS k, l_quantity AS q
              FROM lineitem JOIN part ON l_partkey = p_partkey)
        GROUP BY ticker, trading_date""",
    "event_articles": """
        SELECT 'T' || (user_id % 10) AS ticker, event_id, event_type,
               CASE event_id % 5 WHEN 0 THEN 'Yahoo Finance' WHEN 1 THEN 'Benzinga'
                    WHEN 2 THEN 'CNBC' WHEN 3 THEN 'Reuters' END AS source_name,
               'http://news.example/e/' || event_id AS url, ts AS published_at, CAST(ts AS DATE) AS date,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive'
                    WHEN event_type = 'error' THEN 'negative' ELSE 'neutral' END AS sentiment_label,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 1
                    WHEN event_type = 'error' THEN -1 ELSE 0 END AS sentiment_score,
               0.9e0 AS sentiment_confidence
        FROM events""",
    "event_prices": """
        SELECT 'T' || (user_id % 10) AS ticker, CAST(ts AS DATE) AS trading_date,
               arg_min(value, (ts, event_id)) AS open_price, max(value) AS high_price, min(value) AS low_price,
               arg_max(value, (ts, event_id)) AS close_price, count(*) AS volume
        FROM events GROUP BY 1, 2""",
    # needs event_articles
    "stored_sentiments": """
        SELECT url, 'keyword-v1' AS model_name, sentiment_label, sentiment_score, sentiment_confidence
        FROM event_articles WHERE event_type <> 'signup'
        UNION ALL
        SELECT url, 'keyword-v2', 'positive', 1, 0.6e0 FROM event_articles WHERE event_type IN ('view', 'click')""",
    # needs line_articles
    "line_daily": """
        SELECT ticker, date, count(*) AS article_count,
               count(*) FILTER (sentiment_label = 'positive') AS positive_count,
               count(*) FILTER (sentiment_label = 'neutral') AS neutral_count,
               count(*) FILTER (sentiment_label = 'negative') AS negative_count,
               avg(CAST(sentiment_score AS DOUBLE)) AS daily_mean,
               count(sentiment_score) AS daily_count,
               coalesce(stddev_samp(CAST(sentiment_score AS DOUBLE)), 0e0) AS score_std,
               CAST(min(sentiment_score) AS BIGINT) AS sentiment_score_min,
               CAST(max(sentiment_score) AS BIGINT) AS sentiment_score_max,
               count(DISTINCT source_name) AS unique_source_count,
               count(*) FILTER (contains(lower(source_name), 'yahoo')) AS yahoo_article_count,
               count(*) FILTER (contains(lower(source_name), 'benzinga')) AS benzinga_article_count,
               count(*) FILTER (contains(lower(source_name), 'cnbc')) AS cnbc_article_count
        FROM line_articles GROUP BY ticker, date""",
    # needs line_prices
    "series": """
        SELECT ticker, trading_date, close_price AS c, high_price AS h, low_price AS l,
               CAST(volume AS DOUBLE) AS v, row_number() OVER w AS rn, lag(close_price) OVER w AS pc,
               lag(close_price, 5) OVER w AS pc5, lag(close_price, 10) OVER w AS pc10,
               lag(CAST(volume AS DOUBLE)) OVER w AS pv
        FROM line_prices WINDOW w AS (PARTITION BY ticker ORDER BY trading_date)""",
    # needs series
    "smoothed": """
        SELECT ticker, rn, c AS e10, c AS e20, c AS e12, c AS e26,
               CAST(NULL AS DOUBLE) AS ag, CAST(NULL AS DOUBLE) AS al, h - l AS atr, CAST(NULL AS DOUBLE) AS sig
        FROM series WHERE rn = 1
        UNION ALL
        SELECT s.ticker, s.rn,
               e10 + (c - e10) * (2e0 / 11e0), e20 + (c - e20) * (2e0 / 21e0),
               e12 + (c - e12) * (2e0 / 13e0), e26 + (c - e26) * (2e0 / 27e0),
               CASE WHEN s.rn = 2 THEN greatest(c - pc, 0e0) ELSE ag + (greatest(c - pc, 0e0) - ag) / 14e0 END,
               CASE WHEN s.rn = 2 THEN greatest(pc - c, 0e0) ELSE al + (greatest(pc - c, 0e0) - al) / 14e0 END,
               atr + (greatest(h - l, abs(h - pc), abs(l - pc)) - atr) / 14e0,
               CASE WHEN s.rn < 26 THEN NULL
                    WHEN s.rn = 26 THEN e12 + (c - e12) * (2e0 / 13e0) - (e26 + (c - e26) * (2e0 / 27e0))
                    ELSE sig + (e12 + (c - e12) * (2e0 / 13e0) - (e26 + (c - e26) * (2e0 / 27e0)) - sig) * 0.2e0 END
        FROM smoothed e JOIN series s ON s.ticker = e.ticker AND s.rn = e.rn + 1""",
    # needs series, smoothed
    "technical": """
        SELECT s.ticker, s.trading_date,
               CASE WHEN s.rn >= 10 THEN avg(c) OVER (w ROWS 9 PRECEDING) END AS sma_10,
               CASE WHEN s.rn >= 20 THEN avg(c) OVER (w ROWS 19 PRECEDING) END AS sma_20,
               CASE WHEN s.rn >= 10 THEN e10 END AS ema_10,
               CASE WHEN s.rn >= 20 THEN e20 END AS ema_20,
               CASE WHEN s.rn >= 15 THEN CASE WHEN al = 0 THEN 100e0 ELSE 100e0 - 100e0 / (1e0 + ag / al) END END AS rsi_14,
               CASE WHEN s.rn >= 26 THEN e12 - e26 END AS macd,
               CASE WHEN s.rn >= 34 THEN sig END AS macd_signal,
               CASE WHEN s.rn >= 34 THEN e12 - e26 - sig END AS macd_histogram,
               CASE WHEN s.rn >= 20 THEN avg(c) OVER (w ROWS 19 PRECEDING)
                    + 2e0 * stddev_samp(c) OVER (w ROWS 19 PRECEDING) END AS bb_upper,
               CASE WHEN s.rn >= 20 THEN avg(c) OVER (w ROWS 19 PRECEDING)
                    - 2e0 * stddev_samp(c) OVER (w ROWS 19 PRECEDING) END AS bb_lower,
               CASE WHEN s.rn >= 14 THEN atr END AS atr_14,
               CASE WHEN s.rn >= 21 THEN stddev_samp(c / pc - 1) OVER (w ROWS 19 PRECEDING) END AS volatility_20d,
               c / pc - 1 AS price_chg_1d, c / pc5 - 1 AS price_chg_5d, c / pc10 - 1 AS price_chg_10d,
               v / pv - 1 AS volume_change_pct,
               CASE WHEN s.rn >= 5 THEN avg(v) OVER (w ROWS 4 PRECEDING) END AS volume_avg_5d,
               CASE WHEN s.rn >= 5 THEN v / avg(v) OVER (w ROWS 4 PRECEDING) END AS volume_ratio
        FROM series s JOIN smoothed e ON s.ticker = e.ticker AND s.rn = e.rn
        WINDOW w AS (PARTITION BY s.ticker ORDER BY s.rn)""",
    # needs line_daily
    "line_windows": """
        SELECT *, article_count AS articles_last_24h,
               CAST(sum(article_count) OVER d3 AS BIGINT) AS articles_last_3d,
               CAST(sum(article_count) OVER d7 AS BIGINT) AS articles_last_7d,
               avg(daily_mean) OVER d3 AS mean_3d, avg(daily_mean) OVER d7 AS mean_7d,
               CAST(sum(daily_count) OVER d3 AS BIGINT) AS rolling_3d_article_volume,
               CAST(sum(daily_count) OVER d7 AS BIGINT) AS rolling_7d_article_volume
        FROM line_daily
        WINDOW d3 AS (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW),
               d7 AS (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    # needs line_prices
    "future": """
        SELECT ticker, trading_date, close_price,
               lead(close_price, 1) OVER w AS future_close_1d, lead(close_price, 3) OVER w AS future_close_3d,
               lead(close_price, 5) OVER w AS future_close_5d, lead(close_price, 7) OVER w AS future_close_7d
        FROM line_prices WINDOW w AS (PARTITION BY ticker ORDER BY trading_date)""",
}


def r(value: str, places: int) -> str:
    """Round half to even; ``+ 0`` turns a negative zero into zero."""
    return f"(round_even(CAST({value} AS DOUBLE), {places}) + 0e0)"


CTES["returns"] = "SELECT *, " + ", ".join(
    f"CASE WHEN close_price <> 0 THEN {r(f'(future_close_{n}d - close_price) / close_price', 8)} END AS return_{n}d"
    for n in (1, 3, 5, 7)
) + " FROM future"

CTES["labels_of"] = "SELECT *, " + ", ".join(
    f"CASE WHEN return_{n}d > 0 THEN 1 WHEN return_{n}d IS NOT NULL THEN 0 END AS label_up_{n}d" for n in (1, 3, 5, 7)
) + """, CASE WHEN return_5d > 0.02e0 THEN 'BUY' WHEN return_5d < -0.02e0 THEN 'SELL'
              WHEN return_5d IS NOT NULL THEN 'HOLD' END AS label_direction FROM returns"""


def with_ctes(names: str, select: str) -> str:
    """``WITH RECURSIVE`` over the named views, in the order given."""
    parts = [f"{name} AS ({CTES[name]})" for name in names.split()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


#: Published indicators have 8 places; the comparison keeps fewer, because the engines add in different
#: orders.  The shift keeps 8-place values off the ties of the coarser rounding.
OFF_TIE = "3e-9"


def coarse(value: str, places: int) -> str:
    return r(f"{r(value, 8)} + {OFF_TIE}", places)


def technical_sql(column: str, alias: str = "") -> str:
    prefix = f"{alias}." if alias else ""
    value = f"({prefix}bb_upper - {prefix}bb_lower) / {prefix}sma_20" if column == "bb_width" else prefix + column
    return f"{coarse(value, 6)} AS {column}"


def daily_sql(column: str) -> str:
    """A feature column over ``line_windows`` / ``line_daily``."""
    if column.endswith("_ratio"):
        return f"{r(column.replace('_ratio', '_count') + ' / article_count', 6)} AS {column}"
    if column == "mean_sentiment_score":
        return f"{r('daily_mean', 6)} AS {column}"
    if column == "sentiment_score_std":
        return f"{r('score_std', 6)} AS {column}"
    if column.endswith("_mean_sentiment"):
        return f"{r('mean_' + column.split('_')[1], 6)} AS {column}"
    return column
