"""Ingest profile: summaries per file, computed for all files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.functions.columns import is_missing
from sensorweave.schema import BATCH

# Bounds of the profile's range check, the same for every reading type.
PROFILE_LOW, PROFILE_HIGH = 0.0, 100.0

RATIOS = {
    "sensor_id_missing_ratio": "sensor_id",
    "timestamp_missing_ratio": "timestamp",
    "reading_type_missing_ratio": "reading_type",
    "value_missing_ratio": "value",
    "battery_missing_ratio": "battery_level",
}


def _rounded(column: Column, digits: int | None) -> Column:
    return column if digits is None else F.round(column, digits)


def reading_summary(df: DataFrame, digits: int | None = 2) -> DataFrame:
    """Row count and average, minimum and maximum of value and battery per file and type."""
    return df.groupBy(BATCH, "reading_type").agg(
        F.count(F.lit(1)).alias("record_count"),
        _rounded(F.avg("value"), digits).alias("avg_value"),
        _rounded(F.min("value"), digits).alias("min_value"),
        _rounded(F.max("value"), digits).alias("max_value"),
        _rounded(F.avg("battery_level"), digits).alias("avg_battery"),
        _rounded(F.min("battery_level"), digits).alias("min_battery"),
        _rounded(F.max("battery_level"), digits).alias("max_battery"),
    )


def missing_ratio(df: DataFrame) -> DataFrame:
    """Share of NULLs per required column and file."""
    total = F.count(F.lit(1))
    ratios = [F.try_divide(F.count_if(F.col(c).isNull()), total).alias(name) for name, c in RATIOS.items()]
    return df.groupBy(BATCH).agg(*ratios)


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct sensors and reading types per file; exact unless asked otherwise."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(BATCH).agg(
        count("sensor_id").alias("distinct_sensors"), count("reading_type").alias("distinct_reading_types")
    )


def _violations(name: str) -> Column:
    value = F.col(name)
    bad = ((value < PROFILE_LOW) | (value > PROFILE_HIGH)).cast("double")
    # NULL, not 0, where a file has no value at all.
    return F.sum(bad)


def range_counts(df: DataFrame) -> DataFrame:
    """Values and battery levels outside 0..100 per file."""
    return df.groupBy(BATCH).agg(
        _violations("value").alias("value_out_of_range"), _violations("battery_level").alias("battery_out_of_range")
    )


DOCUMENT = [BATCH, "reading_summary", "missing_data_ratio", "distinct_counts", "outlier_counts"]


def profile(df: DataFrame, files: DataFrame | None = None, digits: int | None = 2) -> DataFrame:
    """One nested document per file. ``files`` (a ``file_name`` column) adds those of files without any row."""
    return profile_with_counts(df, files, digits).select(DOCUMENT)


def profile_with_counts(df: DataFrame, files: DataFrame | None = None, digits: int | None = 2) -> DataFrame:
    """The profile plus the counts that decide a file's status: ``rows`` and ``missing_…``.

    The rows are read and shuffled once: they are aggregated per file, type and sensor,
    and everything else is rolled up from that.
    """
    total = F.count(F.lit(1))
    base = df.groupBy(BATCH, "sensor_id", "reading_type").agg(
        total.alias("n"),
        F.count_if(F.col("timestamp").isNull()).alias("no_ts"),
        F.count_if(F.col("value").isNull()).alias("no_value"),
        F.count_if(is_missing("value", df.schema["value"].dataType)).alias("no_number"),
        F.count_if(F.col("battery_level").isNull()).alias("no_battery"),
        F.sum("value").alias("value_sum"),
        F.min("value").alias("value_min"),
        F.max("value").alias("value_max"),
        F.sum("battery_level").alias("battery_sum"),
        F.min("battery_level").alias("battery_min"),
        F.max("battery_level").alias("battery_max"),
        _violations("value").alias("value_bad"),
        _violations("battery_level").alias("battery_bad"),
    )
    # A sensor counts once per file: in the row of its first type.
    sensor = Window.partitionBy(BATCH, "sensor_id").orderBy("reading_type")
    base = base.withColumn("new_sensor", (F.row_number().over(sensor) == 1) & F.col("sensor_id").isNotNull())
    types = base.groupBy(BATCH, "reading_type").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("sensor_id").isNull(), F.col("n")).otherwise(0)).alias("no_sensor"),
        F.count_if("new_sensor").alias("sensors"),
        *[F.sum(c).alias(c) for c in ["no_ts", "no_value", "no_number", "no_battery", "value_sum", "battery_sum"]],
        *[F.sum(c).alias(c) for c in ["value_bad", "battery_bad"]],
        *[F.min(c).alias(c) for c in ["value_min", "battery_min"]],
        *[F.max(c).alias(c) for c in ["value_max", "battery_max"]],
    )
    entry = F.struct(
        F.col("reading_type"),
        F.col("n").alias("record_count"),
        _rounded(F.try_divide("value_sum", F.col("n") - F.col("no_value")), digits).alias("avg_value"),
        _rounded(F.col("value_min"), digits).alias("min_value"),
        _rounded(F.col("value_max"), digits).alias("max_value"),
        _rounded(F.try_divide("battery_sum", F.col("n") - F.col("no_battery")), digits).alias("avg_battery"),
        _rounded(F.col("battery_min"), digits).alias("min_battery"),
        _rounded(F.col("battery_max"), digits).alias("max_battery"),
    )
    n = F.sum("n")
    untyped = F.sum(F.when(F.col("reading_type").isNull(), F.col("n")).otherwise(0))
    documents = types.groupBy(BATCH).agg(
        F.array_sort(F.collect_list(entry)).alias("reading_summary"),
        F.struct(
            F.try_divide(F.sum("no_sensor"), n).alias("sensor_id_missing_ratio"),
            F.try_divide(F.sum("no_ts"), n).alias("timestamp_missing_ratio"),
            F.try_divide(untyped, n).alias("reading_type_missing_ratio"),
            F.try_divide(F.sum("no_value"), n).alias("value_missing_ratio"),
            F.try_divide(F.sum("no_battery"), n).alias("battery_missing_ratio"),
        ).alias("missing_data_ratio"),
        F.struct(
            F.sum("sensors").alias("distinct_sensors"), F.count("reading_type").alias("distinct_reading_types")
        ).alias("distinct_counts"),
        F.struct(
            F.sum("value_bad").alias("value_out_of_range"), F.sum("battery_bad").alias("battery_out_of_range")
        ).alias("outlier_counts"),
        n.alias("rows"),
        F.sum("no_sensor").alias("missing_sensor"),
        F.sum("no_ts").alias("missing_ts"),
        F.sum("no_number").alias("missing_value"),
    )
    if files is None:
        return documents
    # A file without rows has no group of its own. Its ratios are NULL and its counts 0.
    joined = files.select(BATCH).join(documents, BATCH, "left")
    none = F.lit(0).cast("bigint")
    counts = ["rows", "missing_sensor", "missing_ts", "missing_value"]

    def fields(struct: str, otherwise: Column | None = None) -> Column:
        names = [f.name for f in documents.schema[struct].dataType]
        parts = [F.col(f"{struct}.{n}") for n in names]
        return F.struct(*[(p if otherwise is None else F.coalesce(p, otherwise)).alias(n) for p, n in zip(parts, names)])

    empty = F.array().cast(documents.schema["reading_summary"].dataType)
    return joined.select(
        BATCH,
        F.coalesce("reading_summary", empty).alias("reading_summary"),
        fields("missing_data_ratio").alias("missing_data_ratio"),
        fields("distinct_counts", none).alias("distinct_counts"),
        fields("outlier_counts").alias("outlier_counts"),
        *[F.coalesce(c, none).alias(c) for c in counts],
    )
