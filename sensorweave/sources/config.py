"""Sensor configuration: range and calibration per reading type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.schema import CONFIG

_JSON = "map<string, struct<min: double, max: double, calibration: struct<multiplier: double, offset: double>>>"

# The default ranges and calibration terms of the five reading types.
DEFAULTS = {
    "temperature": {"min": 0, "max": 50, "calibration": {"multiplier": 1.02, "offset": 0.5}},
    "humidity": {"min": 0, "max": 100, "calibration": {"multiplier": 0.98, "offset": 0.3}},
    "soil_moisture": {"min": 0, "max": 80, "calibration": {"multiplier": 1.01, "offset": 0.1}},
    "light_intensity": {"min": 0, "max": 1200, "calibration": {"multiplier": 1.0, "offset": 0.0}},
    "ph_level": {"min": 0, "max": 14, "calibration": {"multiplier": 1.0, "offset": 0.0}},
}


def _flatten(text: DataFrame) -> DataFrame:
    entries = text.select(F.explode(F.from_json("value", _JSON)).alias("reading_type", "c"))
    return entries.select(
        "reading_type",
        "c.min",
        "c.max",
        F.coalesce("c.calibration.multiplier", F.lit(1.0)).alias("multiplier"),
        F.coalesce("c.calibration.offset", F.lit(0.0)).alias("offset"),
    )


def read_config(spark: SparkSession, path: str, required: bool = True) -> DataFrame:
    """Read the JSON file into one row per type. With ``required=False`` a missing file is an empty table.

    No join hint is given anywhere: the file's size is known to Catalyst, which
    broadcasts the table as long as it is below the threshold.
    """
    from pyspark.errors import AnalysisException

    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException:
        if required:
            raise
        return spark.createDataFrame([], CONFIG)
    return _flatten(text)


def default_config(spark: SparkSession) -> DataFrame:
    """The five default types as a literal table."""
    rows = [
        f"('{name}', {float(c['min'])}D, {float(c['max'])}D, "
        f"{float(c['calibration']['multiplier'])}D, {float(c['calibration']['offset'])}D)"
        for name, c in DEFAULTS.items()
    ]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(reading_type, min, max, multiplier, offset)")
