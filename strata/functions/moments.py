"""Second moments that do not depend on summation order.

``stddev`` and ``variance`` over doubles merge running means, so their last
bits change with partitioning. Values of few decimals (money, ages, scores) lie
on a decimal grid: there, the number of rows and the integer sums of x and x * x
say all, are exact, and add up in any order. :func:`moment_sums` is that first
level; its columns can be stored and added up later. :func:`moments_of` makes
mean, variance and stddev of them.

The sums are shifted by the floor of the mean, in integers, before anything
becomes a double, so a large mean costs no digits. A group with a value off the
grid (more decimals than ``scale``, NaN, infinities, more than 18 digits), or
whose sums pass 38 digits, gets Spark's own moments of the doubles, which are
carried along: nothing is dropped and nothing raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimals of the grid: exact for cents and for shares of basis points.
SCALE = 4
#: Suffixes of the stored columns: values, values on the grid, sum of x and of x * x
#: on the grid; for groups off the grid in doubles the sum, the squared deviations
#: within parts, and the square of the sum over the number, which holds those between.
PARTS = ("n", "held", "s1", "s2", "d1", "d2", "d3")


def on_grid(x: Column | str, scale: int = SCALE) -> Column:
    """``x`` times ``10 ** scale`` as a whole decimal; null off the grid."""
    x = F.col(x) if isinstance(x, str) else x
    q = x.try_cast(f"decimal(20,{scale + 2})")
    units = (q * F.lit(10 ** scale)).try_cast("decimal(18,0)")
    back = units.cast("double") / F.lit(float(10 ** scale))
    return F.when(back == x.cast("double"), units)


def moment_sums(x: Column | str, name: str, scale: int = SCALE) -> list[Column]:
    """First level, one aggregate column per entry of :data:`PARTS`."""
    x = F.col(x) if isinstance(x, str) else x
    q, v = on_grid(x, scale), x.cast("double")
    made = (F.count(v), F.count(q), F.try_sum(q.cast("decimal(38,0)")), F.try_sum(q * q), F.sum(v),
            F.var_pop(v) * F.count(v), F.try_divide(F.sum(v) * F.sum(v), F.count(v).cast("double")))
    return [c.alias(f"{name}_{p}") for c, p in zip(made, PARTS)]


def add_sums(name: str) -> list[Column]:
    """Next level: the same columns over rows of :func:`moment_sums`. A part
    whose exact sum was lost is taken as off the grid."""
    lost = (F.col(f"{name}_held") > 0) & (F.col(f"{name}_s1").isNull() | F.col(f"{name}_s2").isNull())
    held = F.when(lost, F.lit(0).cast("long")).otherwise(F.col(f"{name}_held"))
    made = (F.sum(f"{name}_n"), F.sum(held), F.try_sum(f"{name}_s1"), F.try_sum(f"{name}_s2"),
            *[F.sum(f"{name}_{d}") for d in ("d1", "d2", "d3")])
    return [c.alias(f"{name}_{p}") for c, p in zip(made, PARTS)]


def moments_of(name: str, scale: int = SCALE) -> dict[str, Column]:
    """``mean``, ``variance`` and ``stddev`` (of a sample) from the columns of
    :func:`moment_sums`: null for no value; variance null for a single one."""
    n, held, s1, s2, d1, d2, d3 = (F.col(f"{name}_{p}") for p in PARTS)
    rows, unit = n.cast("decimal(20,0)"), float(10 ** scale)
    base = F.floor(F.try_divide(s1, rows)).cast("decimal(19,0)")
    # sums of (x - base) and its square; by Cauchy-Schwarz no term is larger than s2
    rest = F.try_subtract(s1, F.try_multiply(base, rows))
    square = F.try_add(F.try_subtract(s2, F.try_multiply(base, s1).cast("decimal(38,0)")),
                       F.try_multiply(base, F.try_multiply(base, rows)).cast("decimal(38,0)"))
    square = F.try_subtract(square, F.try_multiply(base, s1).cast("decimal(38,0)"))
    r, s, k = rest.cast("double"), square.cast("double"), n.cast("double")
    exact_variance = F.try_divide(s - F.try_divide(r * r, k), k - 1) / F.lit(unit * unit)
    exact_mean = (base.cast("double") + F.try_divide(r, k)) / F.lit(unit)
    whole = (held == n) & square.isNotNull()
    mean = F.when(whole, exact_mean).otherwise(F.try_divide(d1, k))
    between = F.greatest(F.nanvl(d3 - F.try_divide(d1 * d1, k), F.lit(0.0)), F.lit(0.0))
    plain = F.try_divide(d2 + between, k - 1)
    variance = F.when(n > 1, F.when(whole, exact_variance).otherwise(plain))
    return {"mean": mean, "variance": variance, "stddev": F.sqrt(variance)}
