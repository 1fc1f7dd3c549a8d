"""Record completeness: share of listed columns that are not null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def completeness(cols: Sequence[Column | str]) -> Column:
    """``(sum of isNotNull flags) / len(cols)`` as a double in [0, 1]."""
    if not cols:
        raise ValueError("completeness needs at least one column")
    flags = [(F.col(c) if isinstance(c, str) else c).isNotNull().cast("int") for c in cols]
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    return total / F.lit(float(len(cols)))
