"""Tables on plain Parquet and in the session catalog: upserts, merge-on-read
views, layout rewrite, checks after the write."""

from strata.tables.catalog import (ensure_namespace, list_namespaces, list_tables,
                                   write_catalog_table)
from strata.tables.checks import (Holds, Rows, Unique, check_rows, checked, digest, doubled, in_domain,
                                  not_null, observed, verify, violations)
from strata.tables.curve import cluster_by_curve, with_curve_key
from strata.tables.files import COMMIT_ID, cluster, numbered, read_table, write_table
from strata.tables.keyed import create_keyed_table, touched_partitions, upsert_partitions
from strata.tables.upsert import global_upsert, merge_on_read, upsert

__all__ = ["upsert", "global_upsert", "merge_on_read", "cluster", "read_table", "write_table",
           "create_keyed_table", "upsert_partitions", "touched_partitions",
           "ensure_namespace", "list_namespaces", "list_tables", "write_catalog_table",
           "Rows", "Unique", "Holds", "not_null", "in_domain", "check_rows", "checked", "violations", "doubled",
           "digest", "observed", "verify", "cluster_by_curve", "with_curve_key", "COMMIT_ID", "numbered"]
