"""Numeric profile of a value per group (count, moments, quartiles, IQR)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import rounded_mean


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def profile_columns(value: str, name: str | None = None, *, count_of: str | None = None,
                    count_name: str = "n", digits: int | None = None,
                    accuracy: int = 10000) -> list[Column]:
    """Aggregate expressions: n, avg, min, max, stddev, variance, q1, median, q3.

    Quartiles are ``percentile_approx`` (a mergeable sketch: partial per task,
    merged after the shuffle); all three come from one sketch, so a hot group
    costs one sketch per task. With ``digits`` the mean is summed exactly.
    ``accuracy`` trades sketch size for exactness (1/accuracy relative rank
    error); raise it for large groups if the quartiles must be exact.
    """
    name = name or value
    v = F.col(value)
    cnt = F.count(F.col(count_of)) if count_of else F.count(F.lit(1))
    quartiles = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
    mean = F.avg(v) if digits is None else rounded_mean(v, digits)
    return [
        cnt.alias(count_name),
        mean.alias(f"avg_{name}"),
        _r(F.min(v), digits).alias(f"min_{name}"),
        _r(F.max(v), digits).alias(f"max_{name}"),
        _r(F.stddev(v), digits).alias(f"stddev_{name}"),
        _r(F.variance(v), digits).alias(f"variance_{name}"),
        _r(quartiles[0], digits).alias(f"q1_{name}"),
        _r(quartiles[1], digits).alias(f"median_{name}"),
        _r(quartiles[2], digits).alias(f"q3_{name}"),
    ]


def profile(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None, *,
            count_of: str | None = None, count_name: str = "n", digits: int | None = None,
            accuracy: int = 10000) -> DataFrame:
    """One row per group: profile columns plus ``iqr_<name> = q3 - q1``."""
    name = name or value
    agg = df.groupBy(*keys).agg(*profile_columns(
        value, name, count_of=count_of, count_name=count_name, digits=digits, accuracy=accuracy))
    return agg.withColumn(f"iqr_{name}", F.col(f"q3_{name}") - F.col(f"q1_{name}"))
