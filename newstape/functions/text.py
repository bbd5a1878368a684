"""String and timestamp clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: every character that counts as surrounding white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

#: Timestamp layouts found in landed payloads and files.
ARCHIVE_STAMP = "yyyyMMdd'T'HHmmss'Z'"


def stripped(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def text_or_null(value: Column) -> Column:
    """Strip; an empty string becomes NULL."""
    return F.nullif(stripped(value), F.lit(""))


def ticker_symbol(value: Column) -> Column:
    return F.upper(stripped(value))


def lenient_timestamp(value: Column, layout: str | None = None) -> Column:
    """Parse to a timestamp; anything unreadable becomes NULL."""
    if layout is None:
        return F.try_to_timestamp(value.cast("string"))
    return F.try_to_timestamp(value, F.lit(layout))


def utc_day(value: Column) -> Column:
    """The calendar day; the session time zone is UTC (see ``session.tune``)."""
    return F.to_date(value)


def url_digest(url: Column, length: int = 16) -> Column:
    """Leading hex digits of SHA-256; an empty or missing url has an empty digest."""
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("")).otherwise(F.substring(F.sha2(url, 256), 1, length))


def article_key(url: Column) -> Column:
    """Stable 128-bit article id derived from the url.

    A 64-bit hash would collide at some 10^10 articles; 32 hex digits do not.
    """
    return url_digest(url, 32)


def model_text(title: Column, description: Column) -> Column:
    """``title. description``, or whichever is not blank, else NULL."""
    return F.nullif(F.concat_ws(". ", text_or_null(title), text_or_null(description)), F.lit(""))


def words_of(text: Column) -> Column:
    """Lower-cased letters and digits separated by single spaces, with one space at either end."""
    return F.concat(F.lit(" "), stripped(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
