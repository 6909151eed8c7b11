"""Timestamp normalisation to ISO 8601 in UTC, with a shifted local copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sensorweave.functions.columns import EXTRA_FORMATS, clock, is_plain_iso, iso_text
from sensorweave.schema import ORDER

CLOCK, DAY = "_clock", "_day"
NO_DAY = "9999-12-31"

# Fixed value: offset of the local column, UTC+5:30.
LOCAL_SHIFT = "INTERVAL '05:30' HOUR TO MINUTE"


def time_order() -> list[Column]:
    """Sorting by day first changes nothing, but lets windows per day and over time share a sort."""
    return [F.col(DAY).asc(), F.col(CLOCK).asc_nulls_last(), F.col(ORDER).asc()]


def add_clock(df: DataFrame, formats: Sequence[str] = EXTRA_FORMATS) -> DataFrame:
    """Add the parsed time, cut to seconds like the normalised text, and its day.

    Steps that find these columns use them instead of parsing the text again. Rows
    without a valid time get a day that sorts last.
    """
    given = F.col("timestamp").cast("string")
    parsed = df.withColumn(CLOCK, clock(df, formats=formats))
    cut = F.when(is_plain_iso(given), F.col(CLOCK)).otherwise(F.date_trunc("second", CLOCK).cast("timestamp_ntz"))
    day = F.coalesce(F.to_date(CLOCK), F.lit(NO_DAY).cast("date"))
    return parsed.withColumns({CLOCK: cut, DAY: day})


def normalize_timestamps(
    df: DataFrame,
    formats: Sequence[str] = EXTRA_FORMATS,
    shift: str = LOCAL_SHIFT,
    dropped: Observation | None = None,
) -> DataFrame:
    """Parse ``timestamp``, drop rows where that fails, and write it and ``timestamp_ist`` as ISO text.

    Pass an ``Observation`` to learn how many rows were dropped (metric ``invalid``)
    once the result has been computed; it costs no extra job.
    """
    columns = df.columns
    parsed = df.withColumn("_ts", F.col(CLOCK) if CLOCK in columns else clock(df, formats=formats))
    if dropped is not None:
        parsed = parsed.observe(dropped, F.count_if(F.col("_ts").isNull()).alias("invalid"))
    valid = parsed.where(F.col("_ts").isNotNull())
    ts, given = F.col("_ts"), F.col("timestamp").cast("string")
    # Text that already has the wanted form is passed on rather than formatted again.
    text = F.when(is_plain_iso(given), given).otherwise(iso_text(ts))
    texts = {"timestamp_ist": iso_text(ts + F.expr(shift)), "timestamp": text}
    kept = columns if "timestamp_ist" in columns else [*columns, "timestamp_ist"]
    return valid.withColumns(texts).select(kept)
