"""Gold tables from mergeable parts.

An hourly run should read the rows that arrived, not all of silver. Here every
arrival becomes a small table of parts, one row per group: exact sums, extremes
and a KLL quantile sketch. Parts are stored, and the gold profile of any set of
arrivals, or of coarser groups, comes from merging them. A part has a fixed size
(the sketch's k bounds it), so a stored table of parts grows with groups times
arrivals and never with rows; :func:`compact_parts` folds arrivals together.

Counts, extremes, means and moments equal the one-pass result exactly, in any
order of arrival (see :mod:`strata.functions.moments`). Quartiles are within the
sketch's rank error: with k = 800, 0.4 % of the rank in 99 % of cases, whatever
the number of merges.

Defined cases: null keys are a group; null and NaN values count only toward the
rows; a group without a value has null statistics; no parts give no groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.moments import SCALE, add_sums, moment_sums, moments_of

#: The sketch's size parameter.
K = 800
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def profile_parts(df: DataFrame, keys: Sequence[str], value: str, *, scale: int = SCALE, k: int = K) -> DataFrame:
    """One part per group of ``keys``: ``keys``, ``n_rows``, sums, extremes, sketch."""
    v = F.col(value).cast("double")
    rows = df.select(*keys, F.when(~F.isnan(v), v).alias("_v"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), *moment_sums("_v", "v", scale),
        F.min("_v").alias("least"), F.max("_v").alias("most"),
        F.kll_sketch_agg_double("_v", k).alias("sketch"))


def compact_parts(parts: DataFrame, keys: Sequence[str], *, k: int = K) -> DataFrame:
    """Parts folded to one per group of ``keys``; columns left out of ``keys``
    (an arrival's date, a finer group) are rolled up."""
    return parts.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), *add_sums("v"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))


def store_parts(rows: DataFrame, path: str, arrival: Sequence[str], keys: Sequence[str], value: str, *,
                scale: int = SCALE, k: int = K) -> None:
    """Write the parts of one run's rows below ``path``, partitioned by the
    ``arrival`` columns. Only the partitions that the rows lie in are replaced, so
    a run reads and writes what arrived and a repeated run changes nothing; the
    rows must be all of those partitions'."""
    parts = profile_parts(rows, [*arrival, *keys], value, scale=scale, k=k)
    (parts.hint("rebalance", *arrival).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*arrival).parquet(path))


def profile_of_parts(parts: DataFrame, keys: Sequence[str], name: str, *, digits: int | None = None,
                     scale: int = SCALE, k: int = K) -> DataFrame:
    """The profile per group: ``n``, mean, extremes, stddev, variance, quartiles and
    the distance between them, named as those of :func:`strata.operators.profile`."""
    merged = compact_parts(parts, keys, k=k)
    has = F.col("v_n") > 0

    def shown(c):
        return c if digits is None else F.round(c, digits)

    m = moments_of("v", scale)
    points = {q: F.when(has, F.kll_sketch_get_quantile_double("sketch", F.lit(at))) for q, at in QUARTILES.items()}
    out = merged.select(
        *keys, F.col("n_rows").alias("n"), shown(m["mean"]).alias(f"avg_{name}"),
        shown(F.col("least")).alias(f"min_{name}"), shown(F.col("most")).alias(f"max_{name}"),
        shown(m["stddev"]).alias(f"stddev_{name}"), shown(m["variance"]).alias(f"variance_{name}"),
        *[shown(c).alias(f"{q}_{name}") for q, c in points.items()])
    return out.withColumn(f"iqr_{name}", F.col(f"q3_{name}") - F.col(f"q1_{name}"))
