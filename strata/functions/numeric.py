"""Rounded means that do not depend on summation order.

``round(avg(x), 2)`` over doubles lands on a half-way point whenever the true
mean ends in 5 at the third decimal (common for money: two values of odd
cent sum). The double sum's last bits then depend on partitioning and
arrival order, and so does the rounded result. Summing in
``decimal(38, 10)`` is exact for values with up to ten decimals, so the
half-way case always rounds up (HALF_UP), on every run and every cluster.

Values the decimal cannot hold (1e28 and more, NaN, infinities), or a sum
beyond it, switch the group to the plain double mean: nothing is dropped and
nothing raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "decimal(38,10)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact(x: Column | str) -> Column:
    """``x`` as an exact decimal, null where the decimal cannot hold it."""
    return _c(x).try_cast(EXACT_TYPE)


def rounded_mean(x: Column | str, digits: int = 2, exact_sum: bool = True) -> Column:
    """``round(mean(x), digits)`` as a double; exact summation by default."""
    plain = F.round(F.avg(_c(x).cast("double")), digits)
    if not exact_sum:
        return plain
    whole = F.count(exact(x)) == F.count(_c(x))
    mean = F.round(F.try_avg(exact(x)), digits).cast("double")
    return F.when(whole, F.coalesce(mean, plain)).otherwise(plain)


def mean_parts(x: Column | str, name: str) -> list[Column]:
    """First level of a two-level rounded mean: exact and double sums, counts."""
    return [F.try_sum(exact(x)).alias(f"{name}_exact"),
            F.sum(_c(x).cast("double")).alias(f"{name}_double"),
            F.count(exact(x)).alias(f"{name}_held"),
            F.count(_c(x)).alias(f"{name}_n")]


def mean_of_parts(name: str, digits: int | None = 2) -> Column:
    """Second level: :func:`rounded_mean` over the rows of :func:`mean_parts`;
    null (not an error) when there is no value. Without ``digits`` the plain
    double mean."""
    n = F.sum(f"{name}_n")
    double = F.try_divide(F.sum(f"{name}_double"), n.cast("double"))
    if digits is None:
        return double
    lost = F.count_if(F.col(f"{name}_exact").isNull() & (F.col(f"{name}_n") > 0))
    mean = F.round(F.try_divide(F.try_sum(f"{name}_exact"), n.cast("decimal(20,0)")),
                   digits).cast("double")
    plain = F.round(double, digits)
    whole = (F.sum(f"{name}_held") == n) & (lost == 0)
    return F.when(whole, F.coalesce(mean, plain)).otherwise(plain)
