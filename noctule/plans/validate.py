"""Validation of a published ratio raster against control points.

    spark-submit -m noctule.plans.validate --raster /data/ratio --grids /data/ratio_grid --region france --year 2025 \\
        --points points.csv --results /data/validation --run-id 2025-07

Samples darkness and class under every control point, prints the summary and appends the rows to the results.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Row, SparkSession

from noctule.operators.raster import score_pixels
from noctule.operators.validation import validate_bortle, validation_summary
from noctule.plans.annual import read_grid
from noctule.runtime import materialize, ship_package
from noctule.sinks.tables import append_results
from noctule.sources.control_points import read_control_points


def run(spark: SparkSession, args: argparse.Namespace) -> Row:
    """The summary row; ``raster`` is a table of row, col and alr."""
    ship_package(spark)
    points = read_control_points(spark, args.points)
    scored = score_pixels(spark.read.parquet(args.raster).select("row", "col", "alr"))
    rows = materialize(validate_bortle(points, scored, read_grid(spark, args)), "validated")
    append_results(rows, args.results, args.run_id)
    return validation_summary(rows).first()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="noctule.plans.validate")
    for name in ("raster", "grids", "region", "points", "results", "run-id"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--year", type=int, required=True)
    return p


if __name__ == "__main__":
    print(run(SparkSession.builder.appName("noctule-validate").getOrCreate(), parser().parse_args()).asDict())
