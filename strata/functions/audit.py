"""Audit columns. A run passes one ``as_of`` instant so that every table of
the run carries the same time and reruns are repeatable."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts(as_of: _dt.datetime | str | Column | None) -> Column:
    """The run instant. Strings and datetimes without a zone are UTC, so the
    result does not depend on the session time zone."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    text = as_of.strip()
    if len(text) == 10:                       # a date alone means its midnight
        text += " 00:00:00"
    return F.lit(text + "Z" if _naive(text) else text).cast("timestamp")


def _naive(text: str) -> bool:
    t = text.strip()
    return not (t.endswith("Z") or "+" in t[10:] or t[10:].count("-") > 0)


def calculation_timestamp(as_of=None) -> Column:
    return _ts(as_of)


def audit_columns(df: DataFrame, as_of=None, *, partition_from: Column | str | None = None,
                  with_partitions: bool = True) -> DataFrame:
    """Add ``update_timestamp``, ``etl_date`` and (unless ``with_partitions``
    is false) ``year``, ``month``.

    ``year``/``month`` come from the run date by default (the source layout);
    ``partition_from`` takes them from an event-time column instead.
    """
    ts = _ts(as_of)
    if not with_partitions:
        return df.withColumns({"update_timestamp": ts, "etl_date": F.to_date(ts)})
    src = F.to_date(F.col(partition_from) if isinstance(partition_from, str) else partition_from) \
        if partition_from is not None else F.col("etl_date")
    return (df.withColumns({"update_timestamp": ts, "etl_date": F.to_date(ts)})
              .withColumns({"year": F.year(src), "month": F.month(src)}))
