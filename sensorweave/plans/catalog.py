"""Named queries over the event table, one per operator. All of them read the whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.columns import EXTRA_FORMATS, ISO, clock
from sensorweave.operators import calibrate as cal
from sensorweave.operators import clean, distinct, features, profile, status, timestamps, validate
from sensorweave.operators.layout import Limits, measure
from sensorweave.plans import jobs
from sensorweave.plans.job_catalog import JOB_QUERIES
from sensorweave.session import staging_root
from sensorweave.sinks import tables
from sensorweave.sources.config import default_config
from sensorweave.sources.events import read_events
from sensorweave.sources.files import list_files, new_files
from sensorweave.sources.footers import read_footers

Query = Callable[[SparkSession, str], DataFrame]

# Means of round values often end in a 5; the digits are chosen so that it is not the one rounded away.
DIGITS = 8
DIGITS_CALIBRATED = 10
ROW = ["row_index", "file_name", "sensor_id", "timestamp", "reading_type"]


def _rounded(df: DataFrame, *names: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def anomalies_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated readings and how many of them are out of range, per reading type."""
    config = default_config(spark)
    flagged = features.flag_anomalies(cal.calibrate(read_events(spark, folder), config), config)
    return flagged.groupBy("reading_type").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if("anomalous_reading").alias("anomalies"),
        F.round(F.avg("value"), DIGITS).alias("avg_value"),
    )


def reading_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = profile.reading_summary(read_events(spark, folder), digits=None)
    return _rounded(summary, "avg_value", "avg_battery")


def missing_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.missing_ratio(read_events(spark, folder)), *profile.RATIOS)


def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_counts(read_events(spark, folder))


def distinct_over_files(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct sensors of each week and of everything, from what is stored per file."""
    rows = read_events(spark, folder)
    bitmaps = distinct.file_bitmaps(rows, "sensor_id", distinct.extend_dictionary(rows, "sensor_id"))
    files = rows.select("file_name").distinct()
    week = F.date_trunc("week", F.to_date(F.substring("file_name", 1, 10)))
    sets = files.select("file_name", F.explode(F.array(F.lit("all"), F.date_format(week, "yyyy-MM-dd"))).alias("set"))
    return distinct.distinct_over(bitmaps, sets)


def range_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.range_counts(read_events(spark, folder))


def profile_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The nested profile, laid out flat: one row per file and reading type."""
    documents = profile.profile(read_events(spark, folder), digits=None)
    entries = documents.withColumn("entry", F.explode("reading_summary"))
    flat = entries.select(
        "file_name", "entry.*", "missing_data_ratio.*", "distinct_counts.*", "outlier_counts.*"
    )
    return _rounded(flat, "avg_value", "avg_battery", *profile.RATIOS)


def row_null_status(spark: SparkSession, folder: str) -> DataFrame:
    return status.row_null_status(read_events(spark, folder))


def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return clean.dedupe_first(read_events(spark, folder))


def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(clean.impute_mean(read_events(spark, folder)), "value", "battery_level")


def clip_small_samples(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clip_small_samples(read_events(spark, folder, per="minute"), default_config(spark))


def correct_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(clean.correct_outliers(read_events(spark, folder)), "value")


def clean_all(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean(read_events(spark, folder), default_config(spark))
    return _rounded(cleaned, "value", "battery_level")


def calibrate(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(cal.calibrate(read_events(spark, folder), default_config(spark)), "value")


def normalize_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return timestamps.normalize_timestamps(read_events(spark, folder))


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    """One file per month, so that series cross days; rows with NULL keys and NULL times stay in."""
    rows = read_events(spark, folder, per="month")
    return rows.withColumn("timestamp", F.date_format(clock(rows, formats=EXTRA_FORMATS), ISO))


def daily_avg(spark: SparkSession, folder: str) -> DataFrame:
    result = features.daily_average(_monthly(spark, folder))
    return _day_text(_rounded(result, "daily_avg")).select(*ROW, "date", "daily_avg")


def rolling_7(spark: SparkSession, folder: str) -> DataFrame:
    result = features.rolling_average(_monthly(spark, folder))
    return _rounded(result, "rolling_7d_avg").select(*ROW, "rolling_7d_avg")


def rolling_7_days(spark: SparkSession, folder: str) -> DataFrame:
    result = features.rolling_average_days(_monthly(spark, folder))
    return _rounded(result, "rolling_7d_avg").select(*ROW, "rolling_7d_avg")


def anomaly_flag(spark: SparkSession, folder: str) -> DataFrame:
    flagged = features.flag_anomalies(read_events(spark, folder), default_config(spark))
    return flagged.select(*ROW, "value", "anomalous_reading")


def type_and_timestamp_checks(spark: SparkSession, folder: str) -> DataFrame:
    return validate.record_checks(read_events(spark, folder))


def range_pct(spark: SparkSession, folder: str) -> DataFrame:
    return validate.range_percent(read_events(spark, folder), default_config(spark))


def missing_pct(spark: SparkSession, folder: str) -> DataFrame:
    return validate.missing_percent(read_events(spark, folder), default_config(spark))


def sensor_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return validate.sensor_bounds(read_events(spark, folder))


def missing_hours(spark: SparkSession, folder: str) -> DataFrame:
    return validate.missing_hours(read_events(spark, folder, whole_hours=True))


def hourly_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return validate.hourly_gaps(read_events(spark, folder, whole_hours=True))


def gap_totals(spark: SparkSession, folder: str) -> DataFrame:
    return validate.gap_totals(read_events(spark, folder, per="month", whole_hours=True))


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    report = validate.quality_report(read_events(spark, folder, whole_hours=True), default_config(spark))
    return report.select(
        "file_name", "total_records", "invalid_value_type", "invalid_timestamp", "sensors_with_gaps", "total_missing_hours"
    )


def transform_all(spark: SparkSession, folder: str) -> DataFrame:
    result = jobs.transform(read_events(spark, folder), default_config(spark))
    averages = ["value", "battery_level", "daily_avg", "rolling_7d_avg"]
    return _day_text(_rounded(result, *averages, digits=DIGITS_CALIBRATED))


# Limits that send the whole table through the plans for large files and sensors.
SMALL_LIMITS = Limits(group_rows=50, broadcast_rows=10, salts=4)


def correct_outliers_large(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_events(spark, folder)
    return _rounded(clean.correct_outliers(rows, measure(rows, SMALL_LIMITS)), "value")


def clean_large(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean(read_events(spark, folder), default_config(spark), limits=SMALL_LIMITS)
    return _rounded(cleaned, "value", "battery_level")


def transform_large(spark: SparkSession, folder: str) -> DataFrame:
    result = jobs.transform(read_events(spark, folder), default_config(spark), limits=SMALL_LIMITS)
    averages = ["value", "battery_level", "daily_avg", "rolling_7d_avg"]
    return _day_text(_rounded(result, *averages, digits=DIGITS_CALIBRATED))


def transform_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """One large file, of all even days, among daily ones: each kind goes through its own plan."""
    rows = read_events(spark, folder)
    even = F.substring("file_name", 9, 2).cast("int") % 2 == 0
    rows = rows.withColumn("file_name", F.when(even, "even.parquet").otherwise(F.col("file_name")))
    limits = Limits(group_rows=max(1, rows.count() // 8), broadcast_rows=10, salts=4)
    result = jobs.transform(rows, default_config(spark), limits=limits)
    averages = ["value", "battery_level", "daily_avg", "rolling_7d_avg"]
    return _day_text(_rounded(result, *averages, digits=DIGITS_CALIBRATED))


def rolling_7_split(spark: SparkSession, folder: str) -> DataFrame:
    """Sensors cut into chunks of time."""
    rows = _monthly(spark, folder)
    result = features.rolling_average(rows, measure(rows, Limits(group_rows=10, broadcast_rows=10, salts=4)))
    return _rounded(result, "rolling_7d_avg").select(*ROW, "rolling_7d_avg")


def quality_report_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The two maps of the report, one row per file and reading type."""
    report = validate.quality_report(read_events(spark, folder), default_config(spark))
    shares = {"outlier_pct": "outlier_%", "missing_pct": "missing_%"}
    parts = [
        report.select("file_name", F.lit(name).alias("share"), F.explode(F.from_json(f"`{column}`", "map<string,double>")))
        for name, column in shares.items()
    ]
    rows = parts[0].unionByName(parts[1])
    return rows.select("file_name", "share", F.col("key").alias("reading_type"), F.round("value", DIGITS).alias("percent"))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/sensorweave/{name}-{uuid.uuid4().hex}"


def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the analytics dataset and read it back."""
    path = _scratch(spark, "analytics")
    jobs.load(read_events(spark, folder, sensor="gateway").drop("file_name"), path)
    back = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    return back.select(
        "sensor_id", F.col("date").cast("string").alias("date"), "timestamp", "reading_type", "value", "battery_level"
    )


def new_file_footers(spark: SparkSession, folder: str) -> DataFrame:
    """Write daily files, take those of odd days as new, and inspect their footers."""
    path = _scratch(spark, "raw")
    readings = read_events(spark, folder)
    tables.write_by_file(readings, path)
    day = F.regexp_extract("path", r"file_name=([^/]+)/", 1)
    files = list_files(spark, path, recursive=True).withColumn("filename", day)
    names = files.select("filename").distinct()
    done = names.where(F.substring("filename", 9, 2).cast("int") % 2 == 0)
    footers = read_footers(new_files(files, done))
    return footers.groupBy("file_name").agg(
        F.sum("rows").alias("rows"),
        F.max(F.size("missing")).cast("bigint").alias("missing_columns"),
        F.max(F.size("extra")).cast("bigint").alias("extra_columns"),
        F.count("schema_error").alias("unreadable"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        anomalies_by_type,
        reading_summary,
        missing_ratio,
        distinct_counts,
        distinct_over_files,
        range_counts,
        profile_documents,
        row_null_status,
        dedupe_first,
        impute_mean,
        clip_small_samples,
        correct_outliers,
        clean_all,
        calibrate,
        normalize_timestamps,
        daily_avg,
        rolling_7,
        rolling_7_days,
        anomaly_flag,
        type_and_timestamp_checks,
        range_pct,
        missing_pct,
        sensor_bounds,
        missing_hours,
        hourly_gaps,
        gap_totals,
        quality_report,
        transform_all,
        correct_outliers_large,
        clean_large,
        transform_large,
        transform_mixed,
        rolling_7_split,
        quality_report_shares,
        partitioned_roundtrip,
        new_file_footers,
        *JOB_QUERIES,
    ]
}
