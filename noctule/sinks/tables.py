"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noctule.operators.raster import debug_raster


def write_debug_raster(scored: DataFrame, path: str, region: str, year: int) -> None:
    debug_raster(scored).write.mode("overwrite").parquet(f"{path.rstrip('/')}/region={region}/year={year}")


def append_results(results: DataFrame, path: str, run_id: str) -> None:
    """Add validation results under their run, in a table apart from the control points.

    The same run again replaces its rows, so a job that is repeated does not double them.
    """
    out = results.withColumn("run_id", F.lit(run_id))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def publish_table(envelopes: DataFrame, path: str, region: str) -> None:
    """Replace one region's tiles in the release table and leave the other regions alone."""
    out = envelopes.withColumn("region", F.lit(region))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region").parquet(path)
