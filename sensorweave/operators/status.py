"""Row-level completeness of a file and the status it leads to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.columns import is_missing
from sensorweave.schema import BATCH


def null_counts(df: DataFrame) -> DataFrame:
    """Rows and missing sensors, timestamps and values per file."""
    missing = {"missing_sensor": "sensor_id", "missing_ts": "timestamp", "missing_value": "value"}
    counts = [F.count_if(is_missing(c, df.schema[c].dataType)).alias(name) for name, c in missing.items()]
    return df.groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"), *counts)


def _incomplete() -> Column:
    names = ["missing_sensor", "missing_ts", "missing_value"]
    return sum(F.coalesce(F.col(n), F.lit(0)) for n in names) > 0


def _warning() -> Column:
    parts = [F.coalesce(F.col(n), F.lit(0)) for n in ["missing_sensor", "missing_ts", "missing_value"]]
    return F.format_string("missing sensor:%d, ts:%d, value:%d", *parts)


def content_status(counts: DataFrame) -> DataFrame:
    """``dq_warning`` with a message where anything is missing, else ``success``."""
    return counts.withColumn("status", F.when(_incomplete(), "dq_warning").otherwise("success")).withColumn(
        "error", F.when(_incomplete(), _warning())
    )


def row_null_status(df: DataFrame) -> DataFrame:
    return content_status(null_counts(df))


def footer_status(footers: DataFrame) -> DataFrame:
    """Status and error a file gets before its rows are looked at; NULL status if it may be read.

    The order is: unreadable, missing column, column that cannot be profiled, unreadable page.
    """
    lacking = F.concat(
        F.lit("missing:['"), F.array_join("missing", "', '"), F.lit("']")
    )
    unprofiled = F.filter(F.array(F.lit("value"), F.lit("battery_level")), lambda c: ~_is_number(F.col("types")[c]))
    not_numeric = F.concat(F.lit("not numeric: "), F.array_join(unprofiled, ", "))
    clash = F.size(F.array_distinct(F.transform("columns", F.lower))) < F.size("columns")
    cases = [
        ("schema_error", F.col("schema_error").isNotNull(), F.col("schema_error")),
        ("schema_mismatch", F.size("missing") > 0, lacking),
        ("schema_mismatch", clash, F.lit("column names that differ in case only")),
        ("profiling_error", F.size(unprofiled) > 0, not_numeric),
        ("read_error", F.col("read_error").isNotNull(), F.col("read_error")),
    ]
    status, error = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, condition, message in reversed(cases):
        status = F.when(condition, name).otherwise(status)
        error = F.when(condition, message).otherwise(error)
    return footers.withColumns({"status": status, "error": error})


def _is_number(arrow_type: Column) -> Column:
    return F.coalesce(arrow_type.rlike(r"^(u?int\d+|float|double|halffloat|bool|decimal.*|null)$"), F.lit(False))
