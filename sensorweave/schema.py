"""Table schemas, column names and job settings."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import types as T

BATCH = "file_name"
ORDER = "row_index"

# The required columns of a raw file and the key of one reading.
REQUIRED = ["sensor_id", "timestamp", "reading_type", "value", "battery_level"]
READING_KEY = ["sensor_id", "timestamp", "reading_type"]

RAW = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("reading_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("battery_level", T.DoubleType()),
    ]
)

CONFIG = T.StructType(
    [
        T.StructField("reading_type", T.StringType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("multiplier", T.DoubleType()),
        T.StructField("offset", T.DoubleType()),
    ]
)

# One row per inspected file.
FOOTER = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("row_groups", T.IntegerType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("types", T.MapType(T.StringType(), T.StringType())),
        T.StructField("schema_error", T.StringType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("processed_at", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
        T.StructField("batch", T.LongType()),  # microseconds, to order entries of one second
        # The change index: what the file looked like in the listing when it was last looked into, and when that was.
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("seen", T.LongType()),
    ]
)

ACCEPTED = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("types", T.MapType(T.StringType(), T.StringType())),
        T.StructField("batch", T.LongType()),
    ]
)

REPORT_COLUMNS = [
    "total_records",
    "invalid_value_type",
    "invalid_timestamp",
    "outlier_%",
    "missing_%",
    "sensors_with_gaps",
    "total_missing_hours",
    "file_name",
    "error",
]


def _env(name: str, default: str):
    return field(default_factory=lambda: os.getenv(name, default))


@dataclass(frozen=True)
class Settings:
    """Where the jobs read and write. Environment variables give the defaults."""

    raw: str = _env("RAW_DATA_PATH", "data/raw")
    processed: str = _env("PROCESSED_DATA_PATH", "data/processed")
    quarantine: str = _env("QUARANTINE_DATA_PATH", "data/quarantine")
    transformed: str = _env("TRANSFORMED_DATA_PATH", "data/transformed")
    analytics: str = _env("ANALYTICS_DATA_PATH", "data/analytics")
    config: str = "config/sensor_config.json"
    state: str = "state"
    metadata: str = "metadata"

    @property
    def ledger(self) -> str:
        return f"{self.state}/ledger"

    @property
    def accepted(self) -> str:
        return f"{self.state}/accepted"

    @property
    def manifest(self) -> str:
        return f"{self.state}/manifest"

    @property
    def ingest_log(self) -> str:
        return f"{self.metadata}/ingest_log"

    @property
    def profiles(self) -> str:
        return f"{self.metadata}/profiles"

    @property
    def report(self) -> str:
        return f"{self.metadata}/data_quality_report"
