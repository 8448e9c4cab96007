"""Small scalar, time and array expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def ntz(value: str | dt.datetime | Column | None) -> Column:
    """A naive UTC time; the present one for ``None``."""
    if isinstance(value, Column):
        return value
    return F.lit(str(now_utc() if value is None else value)).cast("timestamp_ntz")


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds (fractions kept) to a naive UTC time, whatever the session zone is."""
    micros = F.floor(seconds.cast("double") * 1_000_000 + 0.5).cast("long")
    return F.timestamp_add("MICROSECOND", micros, ntz("1970-01-01 00:00:00"))


def to_epoch(time: Column) -> Column:
    return F.timestamp_diff("SECOND", ntz("1970-01-01 00:00:00"), time)


def exact_mean(value: Column, digits: int = 6) -> Column:
    """Mean through an integer sum, so that it does not depend on row order.

    Exact for values of up to ``digits`` decimals, as sentiment scores are.
    """
    unit = 10**digits
    total = F.sum(F.floor(value * unit + 0.5).cast("long"))
    return total.cast("double") / F.lit(float(unit)) / F.count(value)


def argmax(values: Column) -> Column:
    """Index of the largest element; the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def first_n(values: Column, n: int) -> Column:
    return F.slice(values, 1, n)


def joined(values: Column, n: int, separator: str = ",") -> Column:
    return F.concat_ws(separator, first_n(values, n))


def topic_label(topic_id: Column) -> Column:
    return F.concat(F.lit("Topic "), topic_id.cast("string"))


def topic_name(topic_id: Column, keywords: Column) -> Column:
    """``Topic 3: first - second``; only the label when there are fewer than two."""
    full = F.concat(
        topic_label(topic_id), F.lit(": "), F.get(keywords, F.lit(0)), F.lit(" - "),
        F.get(keywords, F.lit(1)),
    )
    return F.coalesce(full, topic_label(topic_id))


def unit_interval(value: Column) -> Column:
    """Rescale [-1, 1] to [0, 1]."""
    return (value + 1) / 2
