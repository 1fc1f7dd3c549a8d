"""Half-open range bucketing: first ``x < edge`` wins; null falls through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edges and labels that must equal the source rules exactly.
# (edges, labels); labels has one more entry than edges, the last is "otherwise".
AGE_CATEGORY = ((18, 35, 50, 65), ("junior", "young_adult", "middle_age", "senior", "elder"))
EXPERIENCE_LEVEL = ((2, 5, 10), ("Entry", "Mid", "Senior", "Expert"))
AGE_GROUP = ((25, 35, 45, 55), ("18-24", "25-34", "35-44", "45-54", "55+"))
SALARY_BUCKET = ((50000, 75000, 100000, 150000),
                 ("Under 50k", "50k-75k", "75k-100k", "100k-150k", "Over 150k"))


def bucketize(x: Column | str, edges: Sequence[float] | tuple, labels: Sequence[str] | None = None,
              otherwise: str | None = None) -> Column:
    """Label ``x`` by the first edge it is strictly below.

    ``bucketize(col, AGE_CATEGORY)`` accepts a fixed (edges, labels) pair.
    A null ``x`` matches no branch and gets the last label (``otherwise``),
    which is what the chained CASE of the source rules does.
    """
    if labels is None:
        edges, labels = edges  # type: ignore[misc]
    labels = list(labels)
    if otherwise is None:
        if len(labels) != len(edges) + 1:
            raise ValueError("need len(edges)+1 labels, or an explicit otherwise")
        otherwise = labels[-1]
    c = F.col(x) if isinstance(x, str) else x
    expr = None
    for e, lab in zip(edges, labels):
        expr = (F.when(c < F.lit(e), F.lit(lab)) if expr is None
                else expr.when(c < F.lit(e), F.lit(lab)))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)
