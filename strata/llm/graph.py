"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

#: Parts that the rows of one key are dealt into: a task gets at most that share
#: of the rows around a hot key, and as many sums of its parts.
PARTS = 64


def with_least(rows: DataFrame, key: str, value: str, out: str, parts: int = PARTS) -> DataFrame:
    """``rows`` with the least ``value`` of their ``key`` as ``out``. The rows of
    a key are dealt into parts by a hash of the value; only the parts' least
    values meet by key, so that a key of very many rows is no task's alone. Rows
    of a null key are left out."""
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(value), F.lit(parts)))
    some = dealt.groupBy(key, "_part").agg(F.min(value).alias("_some"))
    named = some.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("_some").alias(out), F.collect_list("_part").alias("_parts")).select(
        key, out, F.explode("_parts").alias("_part"))
    return dealt.join(named, [key, "_part"]).select(*rows.columns, out)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of u is tied to the least vertex
    around u. Small star: so is u, with its smaller neighbours."""
    if large:
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = with_least(sides, "u", "v", "m").withColumn("m", F.least("u", "m"))
    if large:
        tied = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = near.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
    # A large star has a row for each edge, as before it; a small one has two, of which many are equal.
    return tied.where("u != v") if large else tied.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of edges (u, v): the component is
    its least vertex. The vertices may be of any type with an order. Each
    round is written to the shared folder; their number grows with the
    logarithm of the longest path."""
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .where("u != v").distinct(), "edges")
    seen = None
    while True:
        now = materialize(_star(materialize(_star(now, True), "stars"), False), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        seen = mark
