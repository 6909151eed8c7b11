"""Linear calibration by reading type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.columns import number


def calibrate(df: DataFrame, config: DataFrame) -> DataFrame:
    """``value * multiplier + offset``; types without configuration pass unchanged."""
    columns = df.columns
    terms = config.select("reading_type", F.col("multiplier").alias("_multiplier"), F.col("offset").alias("_offset"))
    scaled = number("value") * F.coalesce(F.col("_multiplier"), F.lit(1.0)) + F.coalesce(F.col("_offset"), F.lit(0.0))
    return df.join(terms, "reading_type", "left").withColumn("value", scaled).select(columns)
