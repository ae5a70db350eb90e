"""Text and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_name(name: Column) -> tuple[Column, Column]:
    """Split a pair name ``X-Y`` on the first dash only.

    ``A-B-C`` gives (``A``, ``B-C``); a name with no dash gives (name, NULL).
    """
    parts = F.split(name, "-", 2)
    return F.get(parts, 0), F.get(parts, 1)


def clock_label(ts: Column) -> Column:
    """12-hour clock label ``hh:mm AM`` of a timestamp."""
    return F.date_format(ts, "hh:mm a")


def minutes_since(last: Column, as_of: Column) -> Column:
    """Whole minutes from ``last`` to ``as_of`` (floor); -1 when undefined."""
    secs = F.timestamp_diff("SECOND", last, as_of)
    return F.coalesce(F.floor(secs / F.lit(60.0)), F.lit(-1)).cast("bigint")
