"""Content hashing for change detection and audit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(*cols: Column | str, sep: str | None = None,
                 null_marker: str | None = None, bits: int = 256) -> Column:
    """SHA-2 hex digest over the string forms of ``cols``.

    Default (compatible): plain ``concat`` -- no separator, and a null part
    makes the whole hash null. ``sep`` avoids ("12","3") == ("1","23")
    collisions; ``null_marker`` hashes nulls as that marker instead.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = [p.cast("string") for p in parts]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    if sep is not None:
        joined = parts[0]
        for p in parts[1:]:
            joined = F.concat(joined, F.lit(sep), p)
    else:
        joined = F.concat(*parts)
    return F.sha2(joined, bits)
