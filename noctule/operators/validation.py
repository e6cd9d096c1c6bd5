"""Compare predicted Bortle classes with control points."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noctule import constants as K
from noctule.model import Grid
from noctule.operators.raster import sample_at


def judge(predicted: DataFrame, tolerance: int = K.BORTLE_TOLERANCE) -> DataFrame:
    """Result rows from control points that carry predicted ``got_bortle`` and ``got_darkness``."""
    match = F.abs(F.col("got_bortle") - F.col("expected_bortle")) <= tolerance
    return predicted.select("lat", "lon", "expected_bortle", "got_bortle", "got_darkness", match.alias("match"))


def validate_bortle(points: DataFrame, scored: DataFrame, grid: Grid) -> DataFrame:
    """Control points against the raster; a point off the raster gets class 9, the class of no data."""
    sampled = sample_at(points, scored, grid)
    return judge(sampled.withColumnsRenamed({"bortle": "got_bortle", "darkness": "got_darkness"}))


def validation_summary(results: DataFrame) -> DataFrame:
    """One row: points, share of matches, exact hits and mean class difference."""
    delta = F.col("got_bortle") - F.col("expected_bortle")
    return results.agg(
        F.count(F.lit(1)).alias("points"),
        F.avg(F.col("match").cast("int")).alias("match_share"),
        F.count_if(delta == 0).alias("exact"),
        F.avg(delta).alias("mean_delta"),
    )
