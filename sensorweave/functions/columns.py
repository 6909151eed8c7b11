"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "yyyy-MM-dd'T'HH:mm:ss"

# Accepted layouts besides ISO 8601, tried in this order.
EXTRA_FORMATS = (
    "M/d/yyyy h:mm[:ss] a",
    "M/d/yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "yyyyMMdd['T'HHmm[ss]]",
)


def number(name: str) -> Column:
    """A numeric column with NaN read as NULL."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def is_missing(name: str, dtype: T.DataType) -> Column:
    """True for NULL, and for NaN in floating-point columns."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def is_plain_iso(text: Column) -> Column:
    """True for the layout ``2025-06-05T10:00:00``."""
    return text.like("____-__-__T__:__:__")


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 text to a zone-less UTC timestamp; NULL if it is not one.

    The plain layout is the common case and is cast at once. For the rest, the date
    guard keeps out what a bare cast would take as "today" (``12:30``) or as the clock
    (``now``), and text with an offset is moved to UTC.
    """
    dated = text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]|\s*$)")
    zoned = F.substring(F.trim(text), 11, 64).rlike(r"\d.*[A-Za-z+-]")
    moved = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), text.try_cast("timestamp").cast("timestamp_ntz")
    )
    local = text.try_cast("timestamp_ntz")
    return F.when(is_plain_iso(text), local).when(dated & zoned, moved).when(dated, local)


def parse_timestamp(text: Column, formats: Sequence[str] = EXTRA_FORMATS) -> Column:
    """ISO first, then each extra format; NULL if none fits."""
    others = [F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(iso_timestamp(text), *others)


def is_clock(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def clock(df: DataFrame, name: str = "timestamp", formats: Sequence[str] = ()) -> Column:
    """Column ``name`` as a zone-less timestamp, whatever type it has in ``df``."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(name).cast("timestamp_ntz"))
    if is_clock(dtype):
        return F.col(name).cast("timestamp_ntz")
    text = F.col(name).cast("string")
    return parse_timestamp(text, formats) if formats else iso_timestamp(text)


def epoch_micros(ts: Column) -> Column:
    """A zone-less timestamp, taken as UTC, in microseconds since 1970."""
    if SparkSession.active().conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        ts = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts)
    return F.unix_micros(ts.cast("timestamp"))


def iso_text(ts: Column) -> Column:
    """Second precision; a sub-second part is cut off."""
    return F.date_format(ts, ISO)


def precise_text(ts: Column) -> Column:
    """ISO text with the sub-second part, where there is one."""
    fraction = F.regexp_replace(F.date_format(ts, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(iso_text(ts), fraction)


def utc_now() -> Column:
    return F.date_format(
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )


def outside(value: Column, low: Column, high: Column) -> Column:
    """True if ``value`` breaks a bound. A missing bound is no bound; a missing value breaks none."""
    return F.coalesce(value < low, F.lit(False)) | F.coalesce(value > high, F.lit(False))
