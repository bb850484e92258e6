"""Column expressions (C1-C18). All built-in Spark functions: they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of raw timestamps.
TS_FORMAT = "yyyy/MM/dd HH:mm"


def c(name) -> Column:
    """Column by name; names with spaces or dots are quoted."""
    if isinstance(name, Column):
        return name
    return F.col(f"`{name}`")


def parse_ts(col, fmt: str = TS_FORMAT) -> Column:
    """Raw wall-clock text -> timestamp (the instant of that wall clock in UTC), NULL
    when malformed. The text is parsed with an explicit +0000 offset, so no result depends
    on the session time zone; lenient digits (``2022/3/5 1:02``) are accepted."""
    lenient = fmt.replace("MM", "M").replace("dd", "d").replace("HH", "H").replace("mm", "m")
    return F.try_to_timestamp(F.concat(c(col), F.lit(" +0000")), F.lit(lenient + " Z"))


def epoch_seconds(ts) -> Column:
    """Timestamp -> seconds since 1970-01-01 00:00 UTC (long)."""
    return F.unix_timestamp(c(ts)).cast("long")


def midnight_epoch(ts) -> Column:
    """C4+C2: epoch seconds of the (UTC) day's midnight."""
    return (F.floor(epoch_seconds(ts) / 86400) * 86400).cast("long")


def _utc_date(ts) -> Column:
    return F.date_from_unix_date(F.floor(epoch_seconds(ts) / 86400).cast("int"))


def date_parts(ts) -> tuple[Column, Column, Column]:
    """(day, month, year) of the UTC wall clock."""
    d = _utc_date(ts)
    return F.dayofmonth(d), F.month(d), F.year(d)


def midnight(ts) -> Column:
    """C4: midnight of the timestamp's (UTC) day."""
    return F.timestamp_seconds(midnight_epoch(ts))


def parse_double(col) -> Column:
    """Text -> double, NULL when malformed."""
    return F.expr(f"try_cast({_q(col)} AS DOUBLE)")


def parse_long(col) -> Column:
    """Text -> long, NULL when malformed."""
    return F.expr(f"try_cast({_q(col)} AS BIGINT)")


def concat_key(*cols, delimiter: str = "") -> Column:
    """Account key = bank code + account (no delimiter by default, as in the source data)."""
    return F.concat_ws(delimiter, *[c(x) for x in cols]) if delimiter else F.concat(*[c(x) for x in cols])


def last_part(col, sep: str = "_") -> Column:
    """C11: last element after splitting on ``sep``."""
    return F.element_at(F.split(c(col), sep), -1)


def basename(col) -> Column:
    """Final path component."""
    return F.substring_index(F.regexp_replace(c(col), "/+$", ""), "/", -1)


def minmax_scale(col, lo, hi) -> Column:
    """(x - min) / (max - min); 0 for a constant column (scikit-learn rule)."""
    x, lo, hi = c(col), _lit(lo), _lit(hi)
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo)).cast("double")


def argmax(arr) -> Column:
    """0-based position of the largest element of an array column."""
    a = c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("long")


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _q(col) -> str:
    return col if isinstance(col, str) and col.startswith("`") else f"`{col}`"
