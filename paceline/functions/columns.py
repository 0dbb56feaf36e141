"""Column expressions shared by the operators: lenient parsing, keyword flags, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(c: str | Column) -> Column:
    """Number or NULL; text that is no number, and NaN, become NULL."""
    col = F.col(c) if isinstance(c, str) else c
    d = col.try_cast("double")
    return F.when(~F.isnan(d), d)


def seconds(c: str | Column, dtype: str) -> Column:
    """Duration or clock time as seconds: intervals, timestamps and plain numbers."""
    col = F.col(c) if isinstance(c, str) else c
    if dtype.startswith("interval"):
        return (F.extract(F.lit("DAY"), col) * 86400 + F.extract(F.lit("HOUR"), col) * 3600
                + F.extract(F.lit("MINUTE"), col) * 60 + F.extract(F.lit("SECOND"), col)).cast("double")
    if dtype == "timestamp_ntz":
        return clock_seconds(col)
    if dtype.startswith("timestamp"):
        return F.unix_micros(col) / F.lit(1_000_000.0)
    return col.cast("double")


def clock_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 on the clock the timestamp shows, whatever the session time zone."""
    day = F.unix_date(ts.cast("date")).cast("double") * 86400
    return (day + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double"))


def has_any(text: Column, words: Sequence[str]) -> Column:
    """True when the text contains one of the words."""
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def lookup(c: str | Column, table: Mapping, default: Column | None = None) -> Column:
    """Value of a small fixed map; the default (the key itself unless given) where it has none."""
    col = F.col(c) if isinstance(c, str) else c
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(entries[col], col if default is None else default)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))
