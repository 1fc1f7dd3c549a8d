"""Rule-based value standardisation: ordered ``upper(x) contains token`` rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The education rules, in the order they are tried.
EDUCATION_RULES = (
    (("BACHELOR",), "Bachelor's"),
    (("MASTER",), "Master's"),
    (("PHD", "DOCTORATE"), "PhD"),
    (("HIGH SCHOOL",), "High School"),
    (("ASSOCIATE",), "Associate"),
)
EDUCATION_NULL = "UNKNOWN"
JOB_TITLE_NULL = "Unknown Position"
GENDER_CODES = (("M", "Male"), ("F", "Female"))


def standardize(x: Column | str, rules: Sequence[tuple[Sequence[str] | str, str]],
                null_value: str | None = None, otherwise: Column | None = None) -> Column:
    """First rule whose token occurs in ``upper(x)`` wins.

    ``null_value`` is returned for a null input (when given); unmatched values
    get ``otherwise`` (default ``trim(x)``). Tokens are matched as written, so
    give them in upper case.
    """
    c = F.col(x) if isinstance(x, str) else x
    up = F.upper(c)
    expr = F.when(c.isNull(), F.lit(null_value)) if null_value is not None else None
    for tokens, label in rules:
        if isinstance(tokens, str):
            tokens = (tokens,)
        cond = None
        for t in tokens:
            cond = up.contains(t) if cond is None else (cond | up.contains(t))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = F.trim(c) if otherwise is None else otherwise
    return fallback if expr is None else expr.otherwise(fallback)


def education_level(x: Column | str) -> Column:
    return standardize(x, EDUCATION_RULES, null_value=EDUCATION_NULL)


def job_title(x: Column | str) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.when(c.isNull(), F.lit(JOB_TITLE_NULL)).otherwise(F.trim(F.upper(c)))


def gender(x: Column | str) -> Column:
    """Exact single-letter codes (any case) map to words; the rest is trimmed.

    The code test uses the untrimmed value, so " m " is not a code and stays "m".
    """
    c = F.col(x) if isinstance(x, str) else x
    expr = None
    for code, word in GENDER_CODES:
        cond = F.upper(c) == F.lit(code)
        expr = F.when(cond, F.lit(word)) if expr is None else expr.when(cond, F.lit(word))
    return expr.otherwise(F.trim(c))
