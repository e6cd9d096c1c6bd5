"""Populated places from a tab-separated gazetteer dump (19 columns, no header)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from noctule import constants as K
from noctule.model import Region

# fixed values: column positions and the least number of columns of a usable line
NAME, LAT, LON, POPULATION, MIN_COLUMNS = 1, 4, 5, 14, 15
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def parse_places(lines: DataFrame) -> DataFrame:
    """Places from ``value`` lines numbered by ``place_ord``.

    Blank lines, lines with under 15 columns and lines without numeric coordinates are skipped; a population
    that is no whole number is unknown.
    """
    text = F.regexp_replace("value", r"(?U)^\s+|\s+\z", "")
    cols = F.split(text, "\t", -1)

    def number(i: int) -> Column:
        return F.when(F.get(cols, F.lit(i)).rlike(NUMBER), F.trim(F.get(cols, F.lit(i))).try_cast("double"))

    parsed = lines.filter(F.size(cols) >= MIN_COLUMNS).select(
        "place_ord",
        F.coalesce(F.get(cols, F.lit(NAME)), F.lit("")).alias("name"),
        number(LAT).alias("lat"),
        number(LON).alias("lon"),
        F.trim(F.get(cols, F.lit(POPULATION))).try_cast("bigint").alias("population"),
    )
    return parsed.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with ``place_ord``, their position in the file (files in name order).

    Lines are numbered inside each file split and shifted by the line counts of the splits before it, so no
    global sort is needed; only one row per split goes through a window.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = raw.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select("_file", "_start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    numbered = raw.join(shifts, ["_file", "_start"])
    return numbered.select("value", (F.col("shift") + F.col("_id") - F.col("first")).alias("place_ord"))


def bbox_filter(places: DataFrame, region: Region, margin_km: float = K.BBOX_MARGIN_KM) -> DataFrame:
    """Places in the region's box widened by a margin; the bounds are plain numbers and reach a Parquet scan."""
    lon_min, lat_min, lon_max, lat_max = region.bbox
    d_lat = margin_km / K.BBOX_KM_PER_DEG
    d_lon = d_lat / math.cos(math.radians((lat_min + lat_max) / 2.0))
    return places.filter(
        F.col("lat").between(lat_min - d_lat, lat_max + d_lat) & F.col("lon").between(lon_min - d_lon, lon_max + d_lon)
    )


def load_places(spark: SparkSession, region: Region, path: str) -> DataFrame:
    return bbox_filter(parse_places(read_lines(spark, path)), region)
