"""Checks of a table after it was written.

A list of constraints becomes one aggregate over the table; rows that break
one come out as a frame of their own. ``digest`` sums the rows up without
regard to their order: the frame that is written gets it through an
observation, at no pass of its own, and the table that was written through one
scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rows:
    """At least ``least`` and at most ``most`` rows."""

    least: int = 0
    most: int | None = None

    def name(self) -> str:
        return "rows"


@dataclass(frozen=True)
class Unique:
    """No two rows share the values of ``keys`` (nulls are values)."""

    keys: tuple[str, ...]

    def name(self) -> str:
        return f"unique({', '.join(self.keys)})"


@dataclass(frozen=True)
class Holds:
    """At most the share ``most`` of the rows break a condition. A condition
    that is null counts as broken."""

    label: str
    condition: Column
    most: float = 0.0

    def name(self) -> str:
        return self.label


def not_null(column: str, most: float = 0.0) -> Holds:
    return Holds(f"not_null({column})", F.col(column).isNotNull(), most)


def in_domain(column: str, values: Sequence, most: float = 0.0) -> Holds:
    """The column is null or one of ``values``."""
    return Holds(f"domain({column})", F.col(column).isNull() | F.col(column).isin(list(values)), most)


def check_rows(df: DataFrame, checks: Sequence) -> DataFrame:
    """One row per check: ``check_name``, ``n_rows`` of the table, ``n_bad`` (rows
    that break it; for a key, rows beyond the first of their key), ``passed``.

    All checks share one aggregate. A key is counted by a first level on the
    key, whose map-side sums keep a key of many rows cheap; further keys each
    take one more such pass.
    """
    if not checks:
        raise ValueError("no checks")
    holds = [(k, c) for k, c in enumerate(checks) if isinstance(c, Holds)]
    keys = [c.keys for c in checks if isinstance(c, Unique)]
    bad = [F.count_if(~F.coalesce(c.condition, F.lit(False))).alias(f"_b{k}") for k, c in holds]
    first = df.groupBy(*keys[0]) if keys else df.groupBy()
    level = first.agg(F.count(F.lit(1)).alias("_n"), *bad)
    total = level.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"), F.count(F.lit(1)).alias("_k0"),
                      *[F.coalesce(F.sum(f"_b{k}"), F.lit(0)).alias(f"_b{k}") for k, _ in holds])
    for j, other in enumerate(keys[1:], start=1):
        n = df.groupBy(*other).agg(F.lit(1)).agg(F.count(F.lit(1)).alias("_k"))
        total = total.withColumn(f"_k{j}", n.select("_k").scalar())
    out, seen = [], 0
    for k, c in enumerate(checks):
        if isinstance(c, Rows):
            n_bad = F.lit(0).cast("long")
            ok = F.col("_n") >= c.least
            ok = ok if c.most is None else ok & (F.col("_n") <= c.most)
        elif isinstance(c, Unique):
            n_bad = F.col("_n") - F.col(f"_k{seen}")
            ok, seen = n_bad == 0, seen + 1
        else:
            n_bad = F.col(f"_b{k}")
            ok = n_bad <= F.col("_n") * F.lit(c.most)
        out.append(F.struct(F.lit(c.name()).alias("check_name"), F.col("_n").alias("n_rows"),
                            n_bad.alias("n_bad"), ok.alias("passed")))
    return total.select(F.inline(F.array(*out)))


def violations(df: DataFrame, checks: Sequence) -> DataFrame:
    """The rows that break a condition, with the names of those as
    ``broken_checks``. (Doubled keys are counted by :func:`check_rows` and
    listed by :func:`doubled`.)"""
    names = [F.when(~F.coalesce(c.condition, F.lit(False)), F.lit(c.name())) for c in checks if isinstance(c, Holds)]
    broken = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn("broken_checks", broken).where(F.size("broken_checks") > 0)


def doubled(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values of more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def digest(df: DataFrame) -> list[Column]:
    """Aggregates that are equal for equal rows in any order: their number, and
    the sum and the exclusive or of their hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return [F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("total"), F.bit_xor(h).alias("mixed")]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and its digest once an action has read it."""
    seen = Observation()
    return df.observe(seen, *digest(df)), seen


def checked(table: DataFrame, checks: Sequence, name: str = "table") -> int:
    """Run the checks; returns the number of the table's rows, or raises
    ``ValueError`` that names what failed."""
    rows = check_rows(table, checks).collect()                                  # a row per check
    failed = [f"{r.check_name}: {r.n_bad} of {r.n_rows} rows" for r in rows if not r.passed]
    if failed:
        raise ValueError(f"{name}: " + "; ".join(failed))
    return int(rows[0].n_rows)


def verify(table: DataFrame, written: Observation, checks: Sequence = (), name: str = "table") -> int:
    """Compare the table with what was written and run the checks; returns the
    number of its rows, or raises ``ValueError`` that names what failed."""
    got, want = table.agg(*digest(table)).first().asDict(), written.get
    if got != want:
        raise ValueError(f"{name}: read back {got}, written {want}")
    if checks:
        checked(table, checks, name)
    return int(got["n"])
