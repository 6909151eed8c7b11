"""Data-quality metrics per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.functions.columns import clock, epoch_micros, outside
from sensorweave.schema import BATCH, REPORT_COLUMNS

HOUR = 3_600_000_000  # microseconds


def record_checks(df: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    """Total rows, rows of a file whose value column is not double, rows without a valid timestamp.

    The value type belongs to the file, not to the row; ``footers`` (``file_name``,
    ``types``) holds it. Without footers the type in ``df`` counts for all files.
    """
    checks = df.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(clock(df).isNull()).alias("invalid_timestamp")
    )
    if footers is None:
        is_double = F.lit(isinstance(df.schema["value"].dataType, T.DoubleType))
    else:
        checks = checks.join(footers.select(BATCH, F.col("types")["value"].alias("_type")), BATCH, "left")
        is_double = F.col("_type") == "double"
    bad = F.when(is_double, F.lit(0).cast("bigint")).otherwise(F.col("total_records"))
    return checks.select(BATCH, "total_records", bad.alias("invalid_value_type"), "invalid_timestamp")


def _percent(part: str) -> Column:
    return F.coalesce(F.round(F.try_divide(F.col(part) * 100.0, F.col("total")), 2), F.lit(0.0))


def type_checks(df: DataFrame, config: DataFrame) -> DataFrame:
    """Per file and reading type: rows, share out of range and share missing, in percent.

    Types without configuration have no bounds. The NULL type has a missing share only.
    """
    bounds = config.select("reading_type", F.col("min").alias("_low"), F.col("max").alias("_high"))
    value = F.col("value").cast("double")
    joined = df.join(bounds, "reading_type", "left")
    counts = joined.groupBy(BATCH, "reading_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(clock(df).isNull()).alias("invalid_timestamp"),
        F.count_if(outside(value, F.col("_low"), F.col("_high"))).alias("out_of_range"),
        F.count_if(value.isNull()).alias("missing"),
    )
    return counts.withColumns(
        {
            "outlier_pct": F.when(F.col("reading_type").isNotNull(), _percent("out_of_range")),
            "missing_pct": _percent("missing"),
        }
    )


def range_percent(df: DataFrame, config: DataFrame) -> DataFrame:
    known = type_checks(df, config).where(F.col("reading_type").isNotNull())
    return known.select(BATCH, "reading_type", "total", "out_of_range", "outlier_pct")


def missing_percent(df: DataFrame, config: DataFrame) -> DataFrame:
    return type_checks(df, config).select(BATCH, "reading_type", "total", "missing", "missing_pct")


def sensor_bounds(df: DataFrame) -> DataFrame:
    """First and last valid timestamp per sensor, where they differ."""
    times = df.select(BATCH, "sensor_id", clock(df).alias("_ts"))
    bounds = times.groupBy(BATCH, "sensor_id").agg(F.min("_ts").alias("min_ts"), F.max("_ts").alias("max_ts"))
    return bounds.where(F.col("min_ts") < F.col("max_ts"))


def expected_hours(bounds: DataFrame) -> DataFrame:
    """Every hour from a sensor's first timestamp up to its last, counted from the first.

    Stretches of 24 hours are listed first and then taken apart, so that no row holds a long array.
    """
    days = bounds.withColumn("_hours", F.expr("timestampdiff(HOUR, min_ts, max_ts)"))
    days = days.withColumn("_day", F.explode(F.expr("sequence(0L, _hours DIV 24)")))
    hours = days.withColumn("_hour", F.explode(F.expr("sequence(_day * 24, least(_hours, _day * 24 + 23))")))
    return hours.select(BATCH, "sensor_id", F.expr("timestampadd(HOUR, CAST(_hour AS INT), min_ts)").alias("expected_ts"))


def missing_hours(df: DataFrame) -> DataFrame:
    """The expected hours at which the sensor has no reading: the list itself, one row per hour."""
    actual = df.select(BATCH, "sensor_id", clock(df).alias("expected_ts")).where("expected_ts IS NOT NULL")
    return expected_hours(sensor_bounds(df)).join(actual, [BATCH, "sensor_id", "expected_ts"], "left_anti")


def hourly_gaps(df: DataFrame) -> DataFrame:
    """Missing hours per sensor, without building the hour series.

    A reading meets an expected hour exactly if it is as far past the full hour as the
    sensor's first reading. So the distinct instants are counted per such phase, and
    the count of the first reading's phase is subtracted from the length of the series.
    Readings without a sensor meet no expected hour.
    """
    micros = epoch_micros(clock(df))
    instants = df.select(BATCH, "sensor_id", micros.alias("_t")).where("_t IS NOT NULL").distinct()
    phases = instants.groupBy(BATCH, "sensor_id", F.pmod("_t", F.lit(HOUR)).alias("_phase")).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count(F.lit(1)).alias("_hits")
    )
    sensors = phases.groupBy(BATCH, "sensor_id").agg(
        F.min("_first").alias("_a"), F.max("_last").alias("_b"), F.min_by("_hits", "_first").alias("_hits")
    )
    hits = F.when(F.col("sensor_id").isNull(), F.lit(0)).otherwise(F.col("_hits"))
    steps = F.expr(f"(_b - _a) DIV {HOUR} + 1")
    return sensors.where("_a < _b").select(BATCH, "sensor_id", (steps - hits).alias("missing_hours"))


def gap_totals(df: DataFrame) -> DataFrame:
    """Sensors with gaps and missing hours per file; files without gaps count 0."""
    files = df.groupBy(BATCH).agg(F.count(F.lit(1)).alias("_n")).select(BATCH)
    return _fill_gaps(files, hourly_gaps(df))


def _fill_gaps(files: DataFrame, gaps: DataFrame) -> DataFrame:
    totals = (
        gaps.where(F.col("missing_hours") > 0)
        .groupBy(BATCH)
        .agg(F.count(F.lit(1)).alias("sensors_with_gaps"), F.sum("missing_hours").alias("total_missing_hours"))
    )
    return files.join(totals, BATCH, "left").na.fill(0, ["sensors_with_gaps", "total_missing_hours"])


def quality_report(df: DataFrame, config: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    """One row per file. ``footers`` adds files without rows (all zero) and unreadable ones (``error``)."""
    types = type_checks(df, config).withColumn("_name", F.coalesce("reading_type", F.lit("null")))
    types = types.groupBy(BATCH, "_name").agg(
        F.sum("total").alias("total"),
        F.sum("invalid_timestamp").alias("invalid_timestamp"),
        F.sum("missing").alias("missing"),
        F.max("reading_type").alias("reading_type"),
        F.max("outlier_pct").alias("outlier_pct"),
    )
    types = types.withColumn("missing_pct", _percent("missing"))
    outlier_entry = F.when(F.col("reading_type").isNotNull(), F.struct("reading_type", "outlier_pct"))
    # Rows without a type count under the name "null", together with a type of that name.
    missing_entry = F.struct(F.col("_name"), F.col("missing_pct"))

    def as_json(entry):
        return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))

    report = types.groupBy(BATCH).agg(
        F.sum("total").alias("total_records"),
        F.sum("invalid_timestamp").alias("invalid_timestamp"),
        as_json(outlier_entry).alias("outlier_%"),
        as_json(missing_entry).alias("missing_%"),
    )
    report = _fill_gaps(report, hourly_gaps(df))
    zero = F.lit(0).cast("bigint")
    if footers is None:
        double = isinstance(df.schema["value"].dataType, T.DoubleType)
        report = report.withColumn("invalid_value_type", zero if double else F.col("total_records"))
        report = report.withColumn("error", F.lit(None).cast("string"))
        return report.select(REPORT_COLUMNS)

    joined = footers.select(BATCH, F.col("types")["value"].alias("_type"), "error").join(report, BATCH, "left")
    readable = F.col("error").isNull()
    for name in ["total_records", "invalid_timestamp", "sensors_with_gaps", "total_missing_hours"]:
        joined = joined.withColumn(name, F.when(readable, F.coalesce(F.col(name), zero)))
    for name in ["outlier_%", "missing_%"]:
        joined = joined.withColumn(name, F.when(readable, F.coalesce(F.col(f"`{name}`"), F.lit("{}"))))
    wrong = F.when(F.col("_type") == "double", zero).otherwise(F.col("total_records"))
    return joined.withColumn("invalid_value_type", F.when(readable, wrong)).select(REPORT_COLUMNS)


def gate(report: DataFrame, rules: str) -> DataFrame:
    """Opt-in: the files whose report meets an SQL condition, e.g. ``total_missing_hours < 10``."""
    return report.where(F.col("error").isNull()).where(rules)
