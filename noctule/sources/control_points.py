"""Control points: a JSON array of observed Bortle classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noctule.model import CONTROL_POINT

REQUIRED = ("lat", "lon", "expected_bortle")


def read_control_points(spark: SparkSession, path: str) -> DataFrame:
    """Points with lat, lon and expected_bortle; a document that is no array, or a point lacking one of them, fails."""
    text = spark.read.text(path, wholetext=True)
    is_array = F.col("value").rlike(r"^\s*\[")
    parsed = F.from_json("value", f"array<{CONTROL_POINT.simpleString()}>", {"mode": "FAILFAST"})
    points = text.select(
        F.explode(F.when(is_array, parsed).otherwise(F.raise_error(F.lit("control points must be a JSON array")))).alias("p")
    ).select("p.*")
    for name in REQUIRED:
        checked = F.when(F.col(name).isNull(), F.raise_error(F.lit(f"control point lacks {name}"))).otherwise(F.col(name))
        points = points.withColumn(name, checked.cast(CONTROL_POINT[name].dataType))
    return points
