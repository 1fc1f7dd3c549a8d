"""Grouped analytics: breakdowns, labelled group stats, diversity, ranking,
premium, gap, benchmarks and cross summaries.

Shapes chosen for scale:
* two-level aggregation wherever a per-(group, item) count is needed, so the
  wide input is shuffled once, already combined map-side;
* several groupings of one input in a single scan (GROUPING SETS);
* one-row summaries combined through scalar subqueries, never a join;
* lists bounded by the number of distinct items, not by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import mean_of_parts, mean_parts, rounded_mean
from strata.operators.quantiles import exact_percentile, null_safe_on
from strata.operators.rank import global_dense_rank


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _mean(c: Column, digits: int | None) -> Column:
    """Mean, rounded with exact summation when ``digits`` is given."""
    return F.avg(c) if digits is None else rounded_mean(c, digits)


def _left_join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on ``keys`` with null-safe equality; keeps left's key columns."""
    l, r = left.alias("_l"), right.alias("_r")
    extra = [c for c in right.columns if c not in keys]
    return l.join(r, null_safe_on(l, r, keys), "left").select(
        *[F.col(f"_l.`{c}`") for c in left.columns], *[F.col(f"_r.`{c}`") for c in extra])


def distinct_counts(df: DataFrame, keys: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Exact distinct counts per group, one two-level aggregate per column.

    Use next to heavy aggregates (quantile sketches): mixed into one
    ``agg``, a distinct count makes Spark group by (keys, column) first, and
    every sketch is then built per distinct (keys, column) pair instead of
    per group.
    """
    keys = list(keys)
    out = None
    for name, c in cols.items():
        part = (df.select(*keys, c).where(F.col(c).isNotNull()).distinct()
                  .groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
        out = part if out is None else _left_join_on_keys(out, part, keys) if keys else \
            out.withColumns({name: part.select(name).scalar()})
    return out


# --------------------------------------------------------------------------- C5
def category_breakdown(df: DataFrame, key: str, sub: str, *, count_of: str | None = None,
                       list_name: str | None = None,
                       total_name: str = "total_in_categories") -> DataFrame:
    """Per ``key``: sorted list of its ``sub`` categories and the rows in them.

    (key, sub) counts first, then roll up to key: the list holds one entry per
    distinct category, never one per row. Null categories count toward the
    total but are not listed (``collect_list`` skips nulls).
    """
    list_name = list_name or f"{sub}s"
    cnt = F.count(F.col(count_of)) if count_of else F.count(F.lit(1))
    inner = df.groupBy(key, sub).agg(cnt.alias("_category_count"))
    return inner.groupBy(key).agg(
        F.sort_array(F.collect_list(sub)).alias(list_name),
        F.sum("_category_count").alias(total_name))


# --------------------------------------------------------------------------- C7
def group_stats(df: DataFrame, keys: Sequence[str], value: str, second: str, *,
                value_name: str = "salary", second_name: str = "experience",
                count_name: str = "record_count", digits: int | None = 2,
                label: str = "stat_type") -> DataFrame:
    """Per-key stats for several keys from ONE scan: rows are added up by the
    combination of all keys first, so ``GROUPING SETS`` copies combinations
    and not rows.

    Output: ``label`` (the key the row belongs to), every key column (null
    unless it is the row's key), rounded mean of ``value`` and ``second``,
    count, rounded min and max of ``value``. Rows are labelled by
    ``grouping()``, so a real null key value is still its own group.
    """
    keys = list(keys)
    v, s = F.col(value), F.col(second)
    fine = df.groupBy(*keys).agg(*mean_parts(v, "_v"), *mean_parts(s, "_s"), F.count(F.lit(1)).alias("_rows"),
                                 F.min(v).alias("_least"), F.max(v).alias("_most"))
    aggs = [
        mean_of_parts("_v", digits).alias(f"avg_{value_name}"),
        mean_of_parts("_s", digits).alias(f"avg_{second_name}"),
        F.sum("_rows").alias(count_name),
        _r(F.min("_least"), digits).alias(f"min_{value_name}"),
        _r(F.max("_most"), digits).alias(f"max_{value_name}"),
    ] + [F.grouping(k).alias(f"_g_{k}") for k in keys]
    out = fine.groupingSets([[k] for k in keys], *keys).agg(*aggs)
    lab = None
    for k in keys:
        cond = F.col(f"_g_{k}") == 0
        lab = F.when(cond, F.lit(k)) if lab is None else lab.when(cond, F.lit(k))
    return out.withColumn(label, lab).drop(*[f"_g_{k}" for k in keys])


def split_group_stats(stats: DataFrame, key: str, keys: Sequence[str],
                      label: str = "stat_type") -> DataFrame:
    """The rows of one key from :func:`group_stats`, shaped like a plain groupBy."""
    others = [k for k in keys if k != key]
    return stats.where(F.col(label) == key).drop(*others)


# --------------------------------------------------------------------------- C8
def diversity(df: DataFrame, key: str, *, count_of: str, distinct: dict[str, str],
              score: str, set_col: str, count_name: str = "n",
              score_name: str = "score", set_name: str | None = None,
              digits: int = 2) -> DataFrame:
    """Per group: size, distinct counts, score mean/min/max and the item set.

    ``diversity_score`` = round(mean of the distinct counts, digits);
    ``complexity_index`` = round(first distinct count * size / 100, digits).
    """
    names = list(distinct)
    set_name = set_name or f"{set_col}s"
    aggs = [F.count(F.col(count_of)).alias(count_name)]
    aggs += [F.countDistinct(F.col(c)).alias(n) for n, c in distinct.items()]
    aggs += [F.avg(score).alias(f"avg_{score_name}"), F.min(score).alias(f"min_{score_name}"),
             F.max(score).alias(f"max_{score_name}"),
             F.sort_array(F.collect_set(set_col)).alias(set_name)]
    out = df.groupBy(key).agg(*aggs)
    total = None
    for n in names:
        total = F.col(n) if total is None else total + F.col(n)
    return (out.withColumn("diversity_score", F.round(total / F.lit(len(names)), digits))
               .withColumn("complexity_index",
                           F.round(F.col(names[0]) * F.col(count_name) / F.lit(100), digits)))


# --------------------------------------------------------------------------- C9
def measured_groups(df: DataFrame, key: str, value: str, second: str, distinct_col: str, *,
                    min_n: int = 3, value_name: str = "salary", second_name: str = "experience",
                    distinct_name: str = "education_variety", count_name: str = "sample_size",
                    digits: int = 2) -> DataFrame:
    """Groups with at least ``min_n`` rows: their size, rounded means, extremes and
    spread, and the distinct values of ``distinct_col``."""
    v = F.col(value)
    agg = df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name),
        rounded_mean(v, digits).alias(f"avg_{value_name}"),
        rounded_mean(second, digits).alias(f"avg_{second_name}"),
        F.round(F.min(v), digits).alias(f"min_{value_name}"),
        F.round(F.max(v), digits).alias(f"max_{value_name}"),
        F.countDistinct(distinct_col).alias(distinct_name),
        F.round(F.stddev(v), digits).alias(f"{value_name}_stddev"),
    ).where(F.col(count_name) >= min_n)
    return agg.withColumn(f"{value_name}_range", F.col(f"max_{value_name}") - F.col(f"min_{value_name}"))


def ranked_groups(df: DataFrame, key: str, value: str, second: str, distinct_col: str, *,
                  value_name: str = "salary", rank_name: str = "pay_rank", **names) -> DataFrame:
    """:func:`measured_groups`, dense-ranked by rounded mean, desc. The rank is
    global but computed without a single-partition window
    (:func:`strata.operators.rank.global_dense_rank`)."""
    groups = measured_groups(df, key, value, second, distinct_col, value_name=value_name, **names)
    return global_dense_rank(groups, f"avg_{value_name}", out=rank_name)


# -------------------------------------------------------------------------- C10
def premium(df: DataFrame, key: str, value: str, second: str, item: str, *,
            base: float = 65000, step: float = 10000, value_name: str = "salary",
            second_name: str = "experience", count_name: str = "sample_size",
            distinct_name: str = "unique_positions", list_name: str = "common_positions",
            digits: int = 2, top_n: int | None = None) -> DataFrame:
    """Per group: size, rounded means, rounded max, distinct items, the item
    multiset and ``premium_score = round((avg - base) / step, digits)``.

    Two-level aggregation: (group, item) partials first, then the group. The
    item list is the multiset as ``array<struct<item, n>>`` ordered by count
    desc then item -- one entry per distinct item, so it is bounded by the
    item vocabulary, not by the number of rows in the group.
    """
    v, s = F.col(value), F.col(second)
    lvl1 = df.groupBy(key, item).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(v).alias("_mx"),
        *mean_parts(v, "_v"), *mean_parts(s, "_s"))
    # Negative counts first: the built-in struct order is then the list's order.
    entry = F.when(F.col(item).isNotNull(),
                   F.struct((-F.col("_rows")).alias("less"), F.col(item).alias("item")))

    def listed(entries: str) -> Column:
        return F.transform(F.sort_array(entries), lambda e: F.struct(
            e["item"].alias(item), (-e["less"]).alias("n")))

    aggs = [F.sum("_rows").alias(count_name),
            mean_of_parts("_v", digits).alias(f"avg_{value_name}"),
            mean_of_parts("_s", digits).alias(f"avg_{second_name}"),
            F.round(F.max("_mx"), digits).alias(f"max_{value_name}"),
            F.count(F.col(item)).alias(distinct_name)]
    if top_n is None:
        out = (lvl1.groupBy(key).agg(*aggs, F.collect_list(entry).alias("_entries"))
                   .withColumn(list_name, listed("_entries")).drop("_entries"))
    else:
        out = lvl1.groupBy(key).agg(*aggs)
    if top_n is not None:
        # Only the n most common items per group: ranked on the (group, item)
        # rows with a map-side limited row_number, never the whole list.
        w = Window.partitionBy(key).orderBy(F.col("_rows").desc(), F.col(item).asc())
        top = (lvl1.where(F.col(item).isNotNull())
                   .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= top_n))
        lists = (top.groupBy(key).agg(F.collect_list(entry).alias("_entries"))
                    .withColumn(list_name, listed("_entries")).drop("_entries"))
        out = _left_join_on_keys(out, lists, [key])
    return (out
                .withColumn("premium_score",
                            F.round((F.col(f"avg_{value_name}") - F.lit(base)) / F.lit(step),
                                    digits)))


# -------------------------------------------------------------------------- C11
def gap_overview(df: DataFrame, a: str, value: str, second: str, *, distinct: dict[str, str],
                 value_name: str = "salary", second_name: str = "experience",
                 count_name: str = "sample_size", digits: int = 2) -> DataFrame:
    """Per ``a``: size, rounded means, distinct counts and the exact median,
    which comes from :func:`exact_percentile` and so never holds a whole
    group in one task. Every distinct count is an aggregate of its own: together
    with the means, a row per value would carry the state of all of them."""
    over = df.groupBy(a).agg(
        F.count(F.lit(1)).alias(count_name),
        rounded_mean(value, digits).alias(f"avg_{value_name}"),
        rounded_mean(second, digits).alias(f"avg_{second_name}"))
    for n, c in distinct.items():
        over = _left_join_on_keys(over, distinct_counts(df, [a], {n: c}), [a]).withColumn(
            n, F.coalesce(n, F.lit(0).cast("long")))
    med = exact_percentile(df, [a], value, 0.5, out=f"median_{value_name}", digits=digits)
    return _left_join_on_keys(over, med, [a])


def gap_pairs(df: DataFrame, a: str, b: str, value: str, second: str, *,
              value_name: str = "salary", second_name: str = "experience",
              count_name: str = "sample_size", digits: int = 2) -> DataFrame:
    """Per ``a`` x ``b``: size and rounded means."""
    return df.groupBy(a, b).agg(
        F.count(F.lit(1)).alias(count_name),
        rounded_mean(value, digits).alias(f"avg_{value_name}"),
        rounded_mean(second, digits).alias(f"avg_{second_name}"))


def gap(df: DataFrame, a: str, b: str, value: str, second: str, *,
        distinct: dict[str, str], **names) -> tuple[DataFrame, DataFrame]:
    """(:func:`gap_overview` by ``a``, :func:`gap_pairs` by ``a`` x ``b``)."""
    return (gap_overview(df, a, value, second, distinct=distinct, **names),
            gap_pairs(df, a, b, value, second, **names))


# -------------------------------------------------------------------------- C12
def benchmarks(df: DataFrame, value: str, second: str, *, distinct: dict[str, str],
               benchmark_id: str = "industry_overall", per: float = 1000.0,
               prefix: str = "industry", value_name: str = "salary",
               second_name: str = "experience", count_name: str = "total_records",
               digits: int = 2) -> DataFrame:
    """One-row totals; ``data_quality_score = round(n / per * 100)`` is not
    capped at 100 (it is a volume indicator, as in the source)."""
    v = F.col(value)
    med = exact_percentile(df, [], value, 0.5, out="_med", digits=digits).select("_med").scalar()
    return (df.agg(
        F.count(F.lit(1)).alias(count_name),
        rounded_mean(v, digits).alias(f"{prefix}_avg_{value_name}"),
        rounded_mean(second, digits).alias(f"{prefix}_avg_{second_name}"),
        F.round(F.stddev(v), digits).alias(f"{prefix}_{value_name}_stddev"),
        *[F.countDistinct(c).alias(n) for n, c in distinct.items()])
        .withColumn(f"{prefix}_median_{value_name}", med)
        .withColumn("data_quality_score",
                    F.round(F.col(count_name) / F.lit(per) * 100, digits))
        .withColumn("benchmark_id", F.lit(benchmark_id)))


# -------------------------------------------------------------------------- C13
#: Decimals of a double mean that don't depend on the order of its sum.
MEAN_DIGITS = 9


def summary(df: DataFrame, *, count_of: str, count_name: str, distinct_of: str,
            distinct_name: str, mean_of: str, mean_name: str, kind_name: str,
            kind: str) -> DataFrame:
    """One-row summary: non-null count, distinct count, mean and a type label."""
    return (df.agg(F.count(F.col(count_of)).alias(count_name),
                   F.countDistinct(F.col(distinct_of)).alias(distinct_name),
                   F.avg(F.col(mean_of)).alias(mean_name))
              .withColumn(kind_name, F.lit(kind)))


def cross_summary(left: DataFrame, right: DataFrame, *, left_count: str, right_count: str,
                  completeness: str, as_of=None, digits: int = 2) -> DataFrame:
    """Put two one-row summaries side by side.

    The right summary enters as scalar subqueries (Spark merges them into one
    subquery execution), so there is no join at all.
    ``potential_combinations`` is computed with overflow check (null instead
    of an error); ``metric_id`` is ``cross_<epoch seconds>``. The quality index
    is rounded from the mean's first ``MEAN_DIGITS`` decimals, so that a tie isn't
    decided by the order in which the mean was summed up.
    """
    from strata.functions.audit import calculation_timestamp
    out = left
    for c in right.columns:
        out = out.withColumn(c, right.select(c).scalar())
    ts = calculation_timestamp(as_of)
    return (out.withColumn("calculation_timestamp", ts)
               .withColumn("potential_combinations",
                           F.try_multiply(F.col(left_count), F.col(right_count)))
               .withColumn("data_quality_index", F.round(F.round(completeness, MEAN_DIGITS) * 100, digits))
               .withColumn("metric_id",
                           F.concat(F.lit("cross_"), F.col("calculation_timestamp").cast("long"))))
