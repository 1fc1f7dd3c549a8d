"""Exact percentiles without gathering a group into one task.

Spark's ``percentile``/``median`` keeps every distinct value of a group in one
aggregation buffer, so a group that holds a third of the data lands, whole, in
one task. Here a quantile sketch, whose rank error is bounded, gives two values
that surely enclose the wanted rank. One pass then counts what lies below them
and keeps only the values between, which are a few hundred-thousandths of the
group, as (value, number) rows. Nothing is written; the input is read twice.

The result equals ``percentile(value, p)``: position ``p * (n - 1)``, linear
interpolation between the neighbouring order statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import exact

#: The sketch's rank error is n / ACCURACY; the bracket is that and a reserve.
ACCURACY = 100_000
MARGIN = 4 / ACCURACY
#: Parts that a group's rows are dealt into, at most.
PARTS = 64


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    """``left.k <=> right.k`` for every key (null keys are a group too)."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float,
                     out: str = "percentile", digits: int | None = None) -> DataFrame:
    """One row per group of ``keys`` (null keys included): ``keys + [out]``.

    Groups whose values are all null are absent; join the result onto the
    group's other aggregates with a left join. With ``digits`` the
    interpolation is done in decimal and rounded HALF_UP, so a median that
    falls exactly half-way rounds the same on every run. NaN counts as the
    largest value. A bracket that misses the rank, which the sketch's bound
    rules out, raises and does not answer wrongly.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be within [0, 1]")
    keys = list(keys)
    rows = df.select(*[F.col(k) for k in keys], F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sketch = F.percentile_approx("_v", [max(0.0, p - MARGIN), min(1.0, p + MARGIN)], ACCURACY)
    if keys:
        # A group's rows meet its bounds in parts by a hash of the value, so that no task
        # gets a whole group; bounds are made for the parts that have rows.
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("_v"), F.lit(PARTS)))
        bounds = rows.groupBy(*keys).agg(sketch.alias("_q"), F.collect_set("_part").alias("_parts")).select(
            *keys, "_q", F.explode("_parts").alias("_part"))
        r, b = rows.alias("r"), bounds.alias("b")
        rows = r.join(b, null_safe_on(r, b, keys) & (F.col("r._part") == F.col("b._part"))).select(*[F.col(f"r.{k}").alias(k) for k in keys], "_v", "_q")
    else:
        rows = rows.withColumn("_q", rows.select(sketch.alias("_q")).scalar())
    zone = F.when(F.col("_v") < F.col("_q")[0], -1).when(F.col("_v") > F.col("_q")[1], 1).otherwise(0)
    counted = (rows.select(*keys, "_v", zone.alias("_z"), F.when(zone == 0, F.col("_v")).alias("_in"))
                   .groupBy(*keys, "_z", "_in").agg(F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_top"),
                                                    F.min("_v").alias("_least")))
    group = Window.partitionBy(*keys)                    # a group's values between the bounds, and two rows
    ranked = counted.select(
        *keys, "_z", "_c", F.when(F.col("_z") < 0, F.col("_top")).otherwise(F.col("_least")).alias("_v"),
        F.sum("_c").over(group.orderBy("_z", "_in").rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        (F.lit(float(p)) * (F.sum("_c").over(group) - 1).cast("double")).alias("_pos"))
    ranked = ranked.withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")})
    # the first row beyond a position; of the rows outside, only the value next to the bounds is known
    at = {e: F.min(F.when(F.col("_cum") > F.col(e), F.struct("_cum", "_c", "_z", "_v"))) for e in ("_lo", "_hi")}
    picked = ranked.groupBy(*keys).agg(at["_lo"].alias("_a"), at["_hi"].alias("_b"), F.max("_pos").alias("_pos"),
                                       F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))

    def known(row: str, place: str):
        z, cum = F.col(f"{row}._z"), F.col(f"{row}._cum")
        return (z == 0) | ((z < 0) & (cum - 1 == F.col(place))) | ((z > 0) & (cum - F.col(f"{row}._c") == F.col(place)))

    missed = F.raise_error(F.lit("quantile bracket missed")).cast("double")
    picked = picked.select(
        *keys, "_pos", "_lo", "_hi",
        F.when(known("_a", "_lo") & known("_b", "_hi"), F.col("_a._v")).otherwise(missed).alias("_vlo"),
        F.col("_b._v").alias("_vhi"))
    same = (F.col("_lo") == F.col("_hi")) | (F.col("_vlo") == F.col("_vhi"))
    plain = F.when(same, F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo")
        + (F.col("_pos") - F.col("_lo")) * F.col("_vhi"))
    if digits is None:
        return picked.select(*keys, plain.alias(out))
    # Null, not an error, where a decimal cannot hold a value; the plain
    # double interpolation answers then.
    lo, hi = exact("_vlo"), exact("_vhi")
    res = F.round(F.when(same, lo).otherwise(
        exact(F.col("_hi") - F.col("_pos")) * lo
        + exact(F.col("_pos") - F.col("_lo")) * hi), digits).cast("double")
    return picked.select(*keys, F.coalesce(res, F.round(plain, digits)).alias(out))
