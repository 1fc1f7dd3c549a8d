"""Column -> Column building blocks. All of them are built-in Spark expressions,
so they stay inside whole-stage codegen; none is a UDF."""

from strata.functions.buckets import (AGE_CATEGORY, AGE_GROUP, EXPERIENCE_LEVEL,
                                      SALARY_BUCKET, bucketize)
from strata.functions.casts import (legacy_double, legacy_int, rename_columns,
                                    strip_to_number)
from strata.functions.hashing import content_hash
from strata.functions.audit import audit_columns, calculation_timestamp
from strata.functions.moments import add_sums, moment_sums, moments_of
from strata.functions.quality import completeness
from strata.functions.standardize import (EDUCATION_RULES, education_level, gender,
                                          job_title, standardize)

__all__ = [
    "AGE_CATEGORY", "AGE_GROUP", "EXPERIENCE_LEVEL", "SALARY_BUCKET", "bucketize",
    "legacy_double", "legacy_int", "rename_columns", "strip_to_number",
    "content_hash", "audit_columns", "calculation_timestamp", "completeness",
    "EDUCATION_RULES", "education_level", "gender", "job_title", "standardize", "moment_sums", "add_sums", "moments_of",
]
