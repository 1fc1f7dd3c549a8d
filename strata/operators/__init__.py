"""DataFrame -> DataFrame operators."""

from strata.operators.bitmaps import counts_of_bitmaps, distinct_bitmaps
from strata.operators.common import item_counts, most_common
from strata.operators.dedup import dedup, keep_latest
from strata.operators.partials import compact_parts, profile_of_parts, profile_parts, store_parts
from strata.operators.profile import profile, profile_columns
from strata.operators.quantiles import exact_percentile
from strata.operators.rank import global_dense_rank, top_dense_rank
from strata.operators.stats import (benchmarks, category_breakdown, cross_summary, distinct_counts, diversity,
                                    gap, gap_overview, gap_pairs, group_stats, measured_groups, premium, ranked_groups,
                                    split_group_stats, summary)

__all__ = ["dedup", "keep_latest", "profile", "profile_columns", "exact_percentile",
           "global_dense_rank", "top_dense_rank", "benchmarks", "category_breakdown",
           "cross_summary", "distinct_counts", "diversity", "gap",
           "gap_overview", "gap_pairs", "group_stats", "measured_groups", "premium", "ranked_groups",
           "split_group_stats", "summary", "distinct_bitmaps", "counts_of_bitmaps", "item_counts",
           "most_common", "profile_parts", "compact_parts", "profile_of_parts", "store_parts"]
