"""Scans, adapters, generators and ingestion."""

from stellate.sources.csv_ingest import ingest_csv, read_csv
from stellate.sources.csv_splits import csv_records, ingest_csv_records, read_csv_records
from stellate.sources.marketplace import (
    CATEGORY_TRANSLATION,
    RAW_TABLES,
    Marketplace,
    category_translation,
    read_raw,
)
from stellate.sources.spine import data_spine, date_range_of, date_spine, day_sequence, spine_from_bounds
from stellate.sources.tables import DRIVER_TABLES, read_parquet, read_table

__all__ = [
    "CATEGORY_TRANSLATION",
    "DRIVER_TABLES",
    "RAW_TABLES",
    "Marketplace",
    "category_translation",
    "csv_records",
    "data_spine",
    "date_range_of",
    "date_spine",
    "day_sequence",
    "ingest_csv",
    "ingest_csv_records",
    "read_csv",
    "read_csv_records",
    "read_parquet",
    "read_raw",
    "read_table",
    "spine_from_bounds",
]
