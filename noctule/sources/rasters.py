"""Radiance rasters as Parquet, laid out as ``region=<name>/year=<year>/``: one row per pixel, or row segments.

Segments are what the ratio works on. Stored, they lie in ``segment_px=<width>/band=<rows div BAND_ROWS>/`` below the year,
sorted by row and place, so that a window reads the folders and row groups it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from noctule.model import PIXELS
from noctule.operators.alr import SEGMENT_PX, row_segments

BAND_ROWS = 256
SEGMENTS = "row int, seg int, cols array<int>, vals array<double>, region string, year int, segment_px int, band int"


def read_pixels(
    spark: SparkSession,
    root: str,
    region: str,
    year: int,
    rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None,
) -> DataFrame:
    """Pixels of one region and year, optionally only a half-open window of rows and columns.

    Region and year prune partitions, the window is pushed down to Parquet row groups.
    """
    schema = f"{_ddl(PIXELS)}, region string, year int"
    df = spark.read.schema(schema).parquet(root).filter((F.col("region") == region) & (F.col("year") == year))
    for name, span in (("row", rows), ("col", cols)):
        if span is not None:
            df = df.filter((F.col(name) >= span[0]) & (F.col(name) < span[1]))
    return df.select("row", "col", "radiance")


def write_pixels(pixels: DataFrame, root: str, region: str, year: int, files: int = 64) -> None:
    """Replace one region and year; rows are range-partitioned so that windows and mesh cells stay local."""
    out = pixels.select("row", "col", F.col("radiance").cast("double").alias("radiance"))
    out = out.repartitionByRange(files, "row").sortWithinPartitions("row", "col")
    out.write.mode("overwrite").parquet(f"{root.rstrip('/')}/region={region}/year={year}")


def write_segments(pixels: DataFrame, root: str, region: str, year: int, segment_px: int = SEGMENT_PX, files: int = 64) -> None:
    """Replace one region and year by row segments of ``segment_px``; pixels without data are left out."""
    data = pixels.select(F.col("row").cast("int"), F.col("col").cast("int"), F.col("radiance").cast("double").alias("radiance"))
    packed = row_segments(data, segment_px).withColumn("band", F.floor(F.col("row") / BAND_ROWS).cast("int"))
    packed = packed.repartitionByRange(files, "row").sortWithinPartitions("band", "row", "seg")
    packed.write.mode("overwrite").partitionBy("band").parquet(f"{root.rstrip('/')}/region={region}/year={year}/segment_px={segment_px}")


def read_segments(
    spark: SparkSession,
    root: str,
    region: str,
    year: int,
    segment_px: int = SEGMENT_PX,
    rows: tuple[int, int] | None = None,
    cols: tuple[int, int] | None = None,
) -> DataFrame:
    """Row segments of one region and year, optionally only those with a part in a half-open window of rows and columns.

    Give the same ``segment_px`` to the ratio. Bands prune folders, rows and places in the row are pushed down to row groups.
    """
    df = spark.read.schema(SEGMENTS).parquet(root)
    df = df.filter((F.col("region") == region) & (F.col("year") == year) & (F.col("segment_px") == segment_px))
    if rows is not None:
        df = df.filter(F.col("band").between(rows[0] // BAND_ROWS, (rows[1] - 1) // BAND_ROWS) & (F.col("row") >= rows[0]) & (F.col("row") < rows[1]))
    if cols is not None:
        df = df.filter(F.col("seg").between(cols[0] // segment_px, (cols[1] - 1) // segment_px))
    return df.select("row", "seg", "cols", "vals")


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
