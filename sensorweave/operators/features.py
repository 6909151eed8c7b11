"""Daily and rolling averages, and the anomaly flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.functions.columns import clock, epoch_micros, number
from sensorweave.operators.layout import DEFAULT_LIMITS, SENSOR, Layout, Limits, attach, measure, spread_files
from sensorweave.operators.timestamps import CLOCK, DAY, NO_DAY, time_order
from sensorweave.schema import ORDER
from sensorweave.session import stage

# Fixed value: rows in the rolling average, the current one included.
ROLLING_ROWS = 7

HOUR = 3_600_000_000  # microseconds

# Rows that a task which holds several small chunks of time gets, where these need more tasks than usual.
TASK_ROWS = 100_000

def add_date(df: DataFrame) -> DataFrame:
    """The UTC day of ``timestamp``."""
    return df.withColumn("date", F.to_date(clock(df)))


def _keyed() -> Column:
    return F.col("sensor_id").isNotNull() & F.col("reading_type").isNotNull()


def _rolling(part: list[str], order: list[Column] | None = None) -> Column:
    # Sorting by day first changes nothing, but the daily window can then use the same sort.
    ordered = Window.partitionBy(part).orderBy(*(order or time_order()))
    return F.avg("_v").over(ordered.rowsBetween(1 - ROLLING_ROWS, Window.currentRow))


def _daily(part: list[str]) -> Column:
    return F.avg("_v").over(Window.partitionBy(*part, DAY))


def _prepare(df: DataFrame) -> DataFrame:
    rows = df if CLOCK in df.columns else df.withColumn(CLOCK, clock(df))
    rows = rows.withColumns({"date": F.to_date(CLOCK), "_v": number("value")})
    if DAY not in rows.columns:
        rows = rows.withColumn(DAY, F.coalesce("date", F.lit(NO_DAY).cast("date")))
    return rows


def _with_windows(df: DataFrame, layout: Layout, wanted: tuple[str, ...]) -> DataFrame:
    """Add the wanted ones of ``daily_avg`` and ``rolling_7d_avg``."""
    rows = _prepare(df)
    output = [c for c in df.columns if c not in ("date", CLOCK, DAY, *wanted)] + ["date", *wanted]
    parts = []
    if layout.unkeyed:
        nothing = {c: F.lit(None).cast("double") for c in wanted}
        parts.append(rows.where(~_keyed()).withColumns(nothing).select(output))
        rows = rows.where(_keyed())
    if layout.hot is not None:
        marked = layout.hot.withColumn("_hot", F.lit(True))
        rows = attach(rows, marked, SENSOR, layout.hot_groups <= layout.limits.broadcast_rows, layout.limits)
        parts.append(_split_windows(rows.where("_hot").drop("_hot"), layout, wanted).select(output))
        rows = rows.where("_hot IS NULL").drop("_hot")
    group = SENSOR
    if not layout.by_file:
        rows = spread_files(rows, layout)
        group = ["_part", *SENSOR]
    # The rolling window comes first: its shuffle and sort also serve the daily one.
    if "rolling_7d_avg" in wanted:
        rows = rows.withColumn("rolling_7d_avg", F.when(_keyed(), _rolling(group)))
    if "daily_avg" in wanted:
        rows = rows.withColumn("daily_avg", F.when(_keyed() & F.col("date").isNotNull(), _daily(group)))
    result = rows.select(output)
    for part in parts:
        result = result.unionByName(part)
    return result


def _split_windows(rows: DataFrame, layout: Layout, wanted: tuple[str, ...]) -> DataFrame:
    """The same averages for sensors too large for one task.

    The rows are range-partitioned on sensor and time and sorted, so one sensor spreads over many
    partitions, and staged so that positions and chunk numbers stay fixed: rows that time does not
    order, as their index is the same, may lie on both sides of a cut. A partition is cut into chunks of
    ``group_rows``; small ones share a task, as a task for each would cost more than its rows.
    Each chunk then gets the last rows before it as context, which makes its rolling averages exact.
    """
    ranged = rows.repartitionByRange(_hot_tasks(rows, layout), *SENSOR, *time_order())
    ranged = ranged.sortWithinPartitions(*SENSOR, *time_order())
    numbered = ranged.withColumn("_pos", F.monotonically_increasing_id())
    placed = stage(numbered.withColumn("_chunk", F.floor(F.col("_pos") / layout.limits.group_rows)), "hot-chunks")
    result = placed
    if "rolling_7d_avg" in wanted:
        result = _rolling_with_context(placed)
    if "daily_avg" in wanted:
        daily = stage(placed.where("date IS NOT NULL").groupBy(*SENSOR, "date").agg(F.avg("_v").alias("daily_avg")), "hot-days")
        small = daily.count() <= layout.limits.broadcast_rows
        result = attach(result, daily, [*SENSOR, "date"], small, layout.limits)
    return result


def _hot_tasks(rows: DataFrame, layout: Layout) -> int:
    """A task per chunk, unless chunks are so small that fewer tasks hold them without being large."""
    chunks = max(2, -(-layout.rows // layout.limits.group_rows))
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(chunks, max(usual, -(-layout.rows // TASK_ROWS)))


def _rolling_with_context(placed: DataFrame) -> DataFrame:
    before = ROLLING_ROWS - 1
    chunk = [*SENSOR, "_chunk"]
    latest = Window.partitionBy(chunk).orderBy(F.desc("_pos"))
    tails = placed.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= before).drop("_rank")
    # Few rows per chunk are left. A row is context for every later chunk that begins
    # within the next six of them, even if chunks in between are shorter than that.
    along = Window.partitionBy(SENSOR).orderBy("_pos")
    ahead = F.array_distinct(F.array(*[F.lead("_chunk", i).over(along) for i in range(1, before + 1)]))
    targets = F.filter(ahead, lambda c: c > F.col("_chunk"))
    context = tails.withColumn("_to", targets).withColumn("_chunk", F.explode("_to")).drop("_to")
    both = placed.withColumn("_context", F.lit(False)).unionByName(context.withColumn("_context", F.lit(True)))
    return both.withColumn("rolling_7d_avg", _rolling(chunk, [F.col("_pos")])).where(~F.col("_context")).drop("_context")


def daily_average(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Add ``date`` and ``daily_avg``, the mean per sensor, type and day."""
    return _with_windows(df, layout or measure(df), ("daily_avg",))


def rolling_average(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Add ``date`` and ``rolling_7d_avg``, the mean of the last seven rows per sensor and type."""
    return _with_windows(df, layout or measure(df), ("rolling_7d_avg",))


def rolling_average_days(df: DataFrame, days: int = 7) -> DataFrame:
    """Add ``date`` and ``rolling_7d_avg`` as the mean of the readings in ``(t - days, t]``.

    Series are cut into hours: the current hour up to the row, the full hours before it,
    and the end of the hour in which the frame begins. No sum spans more than an hour
    of one series, and every value is added, never subtracted, so nothing is lost.
    Rows without a complete key or a valid time get no average.
    """
    rows = _prepare(df)
    usable = _keyed() & F.col(CLOCK).isNotNull()
    output = [c for c in df.columns if c not in ("date", CLOCK, DAY, "rolling_7d_avg")] + ["date", "rolling_7d_avg"]
    idle = rows.where(~usable).withColumn("rolling_7d_avg", F.lit(None).cast("double"))
    timed = rows.where(usable).withColumn("_us", epoch_micros(F.col(CLOCK)))
    return _hourly_rolling(timed, days * 24).select(output).unionByName(idle.select(output))


def _hourly_rolling(rows: DataFrame, hours: int) -> DataFrame:
    cell = [*SENSOR, "_cell"]
    rows = rows.withColumn("_cell", F.floor(F.col("_us") / HOUR))
    slim = rows.select(*cell, ORDER, "_us", "_v")

    current = Window.partitionBy(cell).orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    head = rows.withColumns({"_s1": F.sum("_v").over(current), "_n1": F.count("_v").over(current)})

    sums = slim.groupBy(cell).agg(F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
    full = Window.partitionBy(SENSOR).orderBy("_cell").rangeBetween(1 - hours, -1)
    middle = sums.select(*cell, F.sum("_s").over(full).alias("_s2"), F.sum("_n").over(full).alias("_n2"))

    # A marker stands where a row's frame begins and collects what comes after it in that hour.
    markers = slim.select(
        *SENSOR,
        (F.col("_cell") - hours).alias("_cell"),
        F.col(ORDER),
        (F.col("_us") - hours * HOUR).alias("_us"),
        F.lit(None).cast("double").alias("_v"),
        F.lit(True).alias("_marker"),
    )
    after = Window.partitionBy(cell).orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, -1)
    tail = (
        slim.withColumn("_marker", F.lit(False))
        .unionByName(markers)
        .withColumns({"_s3": F.sum("_v").over(after), "_n3": F.count("_v").over(after)})
        .where("_marker AND _n3 > 0")
        .select(*SENSOR, (F.col("_cell") + hours).alias("_cell"), ORDER, "_s3", "_n3")
    )
    joined = head.join(middle, cell, "left").join(tail, [*cell, ORDER], "left")
    zero = F.lit(0)
    total = sum(F.coalesce(F.col(c), F.lit(0.0)) for c in ["_s1", "_s2", "_s3"])
    count = sum(F.coalesce(F.col(c), zero) for c in ["_n1", "_n2", "_n3"])
    return joined.withColumn("rolling_7d_avg", F.when(count > 0, total / count))


def flag_anomalies(df: DataFrame, config: DataFrame) -> DataFrame:
    """``anomalous_reading``: outside the configured range, or no value at all."""
    columns = [c for c in df.columns if c != "anomalous_reading"]
    bounds = config.select(
        "reading_type",
        F.coalesce("min", F.lit(float("-inf"))).alias("_low"),
        F.coalesce("max", F.lit(float("inf"))).alias("_high"),
    )
    value = number("value")
    low = F.coalesce(F.col("_low"), F.lit(float("-inf")))
    high = F.coalesce(F.col("_high"), F.lit(float("inf")))
    inside = F.coalesce(value.between(low, high), F.lit(False))
    joined = df.join(bounds, "reading_type", "left")
    return joined.withColumn("anomalous_reading", ~inside).select(*columns, "anomalous_reading")


def derive_features(
    df: DataFrame,
    config: DataFrame,
    layout: Layout | None = None,
    rolling: str = "rows",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``date``, ``daily_avg``, ``rolling_7d_avg`` and ``anomalous_reading``.

    ``rolling="rows"`` averages the last seven rows, ``"days"`` the last seven days.
    """
    layout = layout or measure(df, limits)
    if rolling == "days":
        kept = [c for c in df.columns if c not in (CLOCK, DAY)]
        features = rolling_average_days(daily_average(df.select(kept), layout))
        rest = [c for c in features.columns if c not in ("date", "daily_avg", "rolling_7d_avg")]
        features = features.select(*rest, "date", "daily_avg", "rolling_7d_avg")
    else:
        features = _with_windows(df, layout, ("daily_avg", "rolling_7d_avg"))
    return flag_anomalies(features, config)
