"""strata: layered (bronze -> silver -> gold) lakehouse operators on plain Spark.

Every public function takes and returns ``DataFrame`` or ``Column`` objects, so
Catalyst sees one declarative plan per job: filters and projections reach the
Parquet scan, aggregations run partial + final, and nothing is pulled through
the driver.
"""

__version__ = "0.1.0"
