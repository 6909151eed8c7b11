"""Adapter: a generic event table as raw sensor readings.

Event types stand for reading types, users for sensors, and one calendar day for one
daily file. Dirt is injected by fixed rules, so that every operator has work to do:
incomplete keys, missing values, unparsable and month-first timestamps, and second
copies of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.schema import RAW
from sensorweave.sources.store import located, open_file

# Reading type by event type.
TYPES = {"view": "temperature", "click": "humidity", "signup": "soil_moisture", "error": "light_intensity"}
OTHER = "ph_level"

FILE_NAMES = {
    "day": "yyyy-MM-dd'.parquet'",
    "month": "yyyy-MM'.parquet'",
    "minute": "yyyy-MM-dd'T'HHmm'.parquet'",
}


def _every(n: int, rest: int = 0) -> Column:
    return F.col("event_id") % n == rest


def readings_from_events(
    events: DataFrame, per: str = "day", whole_hours: bool = False, sensor: str = "user"
) -> DataFrame:
    """``row_index``, the raw columns and ``file_name``.

    ``per="minute"`` makes many tiny files. ``whole_hours`` moves two of three readings
    to the full hour, so that the hourly coverage has hits as well as gaps.
    ``sensor="gateway"`` takes one of ten gateways for the sensor instead of the user.
    """
    if whole_hours:
        hour = F.expr("date_trunc('hour', ts)").cast("timestamp_ntz")
        events = events.withColumn("ts", F.when(_every(3), F.col("ts")).otherwise(hour))
    copies = F.when(_every(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("copy", F.explode(copies))
    kind = F.lit(OTHER)
    for event_type, reading_type in TYPES.items():
        kind = F.when(F.col("event_type") == event_type, reading_type).otherwise(kind)
    level = F.get_json_object("props", "$.k").cast("double")
    if sensor == "gateway":
        source = F.concat(F.lit("gateway_"), F.floor(level / 10).cast("string"))
    else:
        source = F.concat(F.lit("sensor_"), F.col("user_id").cast("string"))
    stamp = (
        F.when(_every(211), "INVALID_TS")
        .when(_every(10, 1), F.date_format("ts", "MM/dd/yyyy hh:mm a"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return rows.select(
        (F.col("event_id") * 2 + F.col("copy")).alias("row_index"),
        F.when(~_every(307), source).alias("sensor_id"),
        stamp.alias("timestamp"),
        kind.alias("reading_type"),
        F.when(~_every(97), F.col("value") + F.lit(1000.0) * F.col("copy")).alias("value"),
        level.alias("battery_level"),
        F.date_format("ts", FILE_NAMES[per]).alias("file_name"),
    )


def read_events(spark: SparkSession, folder: str, **options) -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{folder}/events.parquet"), **options)


def with_damage(name: str) -> str | None:
    """What is wrong with a daily file, by the last digit of its day."""
    return {"1": "float", "3": "column", "5": "text", "7": "bytes", "9": "empty"}.get(name[9:10])


def write_files(readings: DataFrame, folder: str, damage: Callable[[str], str | None] = lambda name: None) -> None:
    """One Parquet file for each ``file_name``, in ``folder``, an absolute path that all tasks see.

    Rows stream into their file in the order of ``row_index``. ``damage`` may make a file one with narrow
    values (``float``), without a column (``column``), with values as text (``text``), without rows
    (``empty``) or cut off (``bytes``).
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        name, writer, sink, kind = None, None, None, None

        def close():
            if writer is not None:
                writer.close()
                sink.close()
                if kind == "bytes":
                    with open_file(f"{folder}/{name}") as stream:
                        head = stream.read(stream.size() - 5)
                    filesystem, inner = located(f"{folder}/{name}")
                    with filesystem.open_output_stream(inner) as stream:
                        stream.write(head)

        def damaged(table):
            if kind == "column":
                return table.drop_columns(["battery_level"])
            if kind in ("text", "float"):
                wanted = pa.string() if kind == "text" else pa.float32()
                return table.set_column(3, "value", table.column("value").cast(wanted))
            return table.slice(0, 0) if kind == "empty" else table

        for batch in batches:
            start = 0
            for own, rows in groupby(batch["file_name"].to_pylist()):
                size = len(list(rows))
                table = pa.Table.from_batches([batch.slice(start, size)]).select(RAW.names)
                start += size
                if own != name:
                    close()
                    name, kind, writer = own, damage(own), None
                table = damaged(table)
                if writer is None:
                    filesystem, inner = located(f"{folder}/{name}")
                    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    sink = filesystem.open_output_stream(inner)
                    writer = pq.ParquetWriter(sink, table.schema)
                writer.write_table(table)
        close()
        yield pa.RecordBatch.from_pydict({"done": pa.array([name], pa.string())})

    rows = readings.select("file_name", "row_index", *RAW.names).repartition("file_name")
    rows = rows.sortWithinPartitions("file_name", "row_index")
    rows.mapInArrow(run, "done string").write.format("noop").mode("overwrite").save()
