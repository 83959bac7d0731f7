"""Column functions with the library's exact semantics, all built from Spark's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pad_cik(x: Column | str) -> Column:
    """Zeros in front up to ten characters; longer values stay (``lpad`` would cut them)."""
    s = col(x).cast("string")
    return F.when(F.length(s) < 10, F.lpad(s, 10, "0")).otherwise(s)


def iso_date(x: Column | str) -> Column:
    """A strict yyyy-MM-dd date, or null."""
    s = col(x)
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(s, "yyyy-MM-dd"))


def utc_timestamp(x: Column | str) -> Column:
    """An ISO timestamp up to the first point; ``Z`` and offsets count, none means UTC; bad ones are null.

    The session's time zone must be UTC.
    """
    s = F.split_part(col(x), F.lit("."), F.lit(1))
    shaped = s.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2})?(Z|[+-]\d{2}:?\d{2})?)?$")
    return F.when(shaped, s.try_cast("timestamp"))


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def numeric_value(x: Column | str) -> Column:
    """The finite number that a string holds, or null."""
    s = col(x)
    n = F.when(s.rlike(NUMBER), F.trim(s).try_cast("double"))
    return F.when(F.abs(n) < float("inf"), n)


def text_value(x: Column | str) -> Column:
    """The string itself if it holds no finite number."""
    return F.when(numeric_value(x).isNull(), col(x))


def digits(x: Column | str, kind: str = "bigint") -> Column:
    """An integer from a string of digits only, or null."""
    s = col(x).cast("string")
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast(kind))


def truthy(x: Column | str) -> Column:
    """Null stays null; the literals 0 and false and the empty string are false, all else is true.

    For texts of which no more is known; ``variants.truthy`` tells a document's false from its "false".
    """
    s = F.lower(col(x).cast("string"))
    return F.when(s.isNull(), F.lit(None).cast("boolean")).otherwise(~s.isin("", "0", "0.0", "false"))


def filled(x: Column | str) -> Column:
    """Null for the empty string."""
    s = col(x)
    return F.when(s != "", s)


def url(template: str, **parts: Column | str) -> Column:
    """``template`` with each {name} replaced by a column."""
    out = F.lit(template)
    for name, x in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), col(x))
    return out


def filing_url(base: str, cik: Column | str, accession: Column | str, document: Column | str) -> Column:
    """Place of a filing's document below ``base``; the accession number loses its hyphens."""
    return F.concat_ws("/", F.lit(base), col(cik), F.replace(col(accession), F.lit("-"), F.lit("")), col(document))


def dotted_ticker(x: Column | str) -> Column:
    return F.replace(col(x), F.lit("-"), F.lit("."))


def lookup_ticker(x: Column | str) -> Column:
    return F.upper(F.trim(col(x)))


def cik_of_file(x: Column | str) -> Column:
    """The digits of CIK….json, the empty string if there are none."""
    return F.regexp_extract(col(x), r"CIK(\d+)\.json", 1)


def epoch_ms_date(x: Column | str) -> Column:
    return F.to_date(F.timestamp_millis(col(x)))


def percent(x: Column | str) -> Column:
    """A decimal from a percentage; what is no number is null."""
    return col(x).try_cast("double") / 100


def permanent_error(x: Column | str) -> Column:
    """Client errors that a later try won't mend; throttling (429) isn't one."""
    return col(x).rlike("400|Bad Request|404|Not Found|Client Error") & ~throttled(x)


def throttled(x: Column | str) -> Column:
    return col(x).rlike("(?i)429|too many requests")


def retryable_error(x: Column | str) -> Column:
    return col(x).rlike("(?i)429|too many requests|unable to open database file")


def error_bucket(x: Column | str) -> Column:
    s = col(x)
    return F.when(s.rlike("404|(?i)not found"), "404").when(throttled(s), "429").otherwise("other")


def clamp_start(start: Column | str, end: Column | str, days: int) -> Column:
    """The start, moved forward so that the range spans ``days`` at most."""
    return F.greatest(col(start), F.date_sub(col(end), days))


def html_text(x: Column | str) -> Column:
    """Text of an HTML filing: no scripts, styles, tables or tags; common entities decoded; one blank between words."""
    s = F.regexp_replace(col(x), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<table\b.*?</table\s*>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    for old, new in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        s = F.replace(s, F.lit(old), F.lit(new))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def window_text(x: Column | str, chars: int) -> Column:
    return F.substring(col(x), 1, chars)


def batch_id_of_file(x: Column | str) -> Column:
    return F.regexp_extract(col(x), r"(\d{8}_\d{6}(?:_\d+)?)", 1)


def batch_time_of_file(x: Column | str) -> Column:
    return F.try_to_timestamp(F.substring(batch_id_of_file(x), 1, 15), F.lit("yyyyMMdd_HHmmss"))
