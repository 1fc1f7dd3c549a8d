"""Tolerant casts for all-string bronze columns.

Spark 4 runs with ANSI mode on, where ``cast('x' as int)`` raises. Bronze data
is dirty by definition, so every cast here yields null on bad input, the way
the pre-ANSI cast did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The pre-ANSI string->int cast truncated decimals ("30.9" -> 30), trimmed
# blanks (" 30 " -> 30) and rejected exponents ("1e2" -> null). Going through
# decimal(38,10) reproduces the first two; the exponent guard the third.
_EXPONENT = r"[eE]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def legacy_int(x: Column | str) -> Column:
    """String -> int with null on failure, truncating toward zero."""
    s = _c(x).cast("string")
    as_int = s.try_cast("decimal(38,10)").try_cast("int")
    return F.when(s.rlike(_EXPONENT), F.lit(None).cast("int")).otherwise(as_int)


def legacy_double(x: Column | str) -> Column:
    """String -> double with null on failure (blanks trimmed, exponents kept)."""
    return _c(x).cast("string").try_cast("double")


def strip_to_number(x: Column | str) -> Column:
    """Keep only digits and dots, then cast to double ("$1,234.50" -> 1234.5).

    As in the source data rules: the sign and exponent letters are dropped too,
    so "-5" -> 5.0 and "1e5" -> 15.0; "1.2.3" does not parse and is null.
    """
    return F.regexp_replace(_c(x).cast("string"), r"[^0-9.]", "").try_cast("double")


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Explicit, case-insensitive column rename ``{"Age": "age", ...}``.

    Replaces relying on ``spark.sql.caseSensitive=false`` to make
    ``withColumn("age", col("Age"))`` overwrite ``Age``.
    """
    lower = {k.lower(): v for k, v in mapping.items()}
    return df.toDF(*[lower.get(c.lower(), c) for c in df.columns])
