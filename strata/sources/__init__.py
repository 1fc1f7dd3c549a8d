"""Sources: tolerant bronze CSV, also with line breaks in its fields."""

from strata.sources.csv import quarantine, read_bronze, read_bronze_csv, string_schema
from strata.sources.records import csv_records

__all__ = ["read_bronze", "read_bronze_csv", "quarantine", "string_schema", "csv_records"]
