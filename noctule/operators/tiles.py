"""Sites into one-degree tiles and tile envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from noctule.functions.geo import spot_id, tile_id, tile_label
from noctule.model import SPOT

SPOT_FIELDS = [f.name for f in SPOT.fields]


def enrich(spots: DataFrame) -> DataFrame:
    """Published form of sites: id from the coordinates, ``near`` kept, altitude unknown, helper columns gone.

    Columns that only order the sites (``added_by``, ``cand_ord``) stay for the tile arrays.
    """
    near = F.col("near") if "near" in spots.columns else F.lit(None).cast("string")
    bortle = F.col("bortle") if "bortle" in spots.columns else F.lit(None)
    return spots.select(
        "lat",
        "lon",
        "darkness",
        bortle.cast("int").alias("bortle"),
        near.alias("near"),
        spot_id(F.col("lat"), F.col("lon")).alias("id"),
        F.lit(None).cast("double").alias("altitude"),
        *[c for c in ("added_by", "cand_ord") if c in spots.columns],
    )


def with_tile(spots: DataFrame, strict: bool = True) -> DataFrame:
    return spots.withColumn("tile", tile_id(F.col("lat"), F.col("lon"), strict))


def split_untiled(spots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tiled sites and the rejects that lie in no tile, for callers that do not want the job to fail."""
    named = with_tile(spots, strict=False)
    return named.filter(F.col("tile").isNotNull()), named.filter(F.col("tile").isNull()).drop("tile")


def tile_counts(spots: DataFrame) -> DataFrame:
    return with_tile(spots).groupBy("tile").agg(F.count(F.lit(1)).alias("spots"))


def enumerate_tiles(boxes: DataFrame) -> DataFrame:
    """One row per box and tile whose south-west corner lies in floor(min) .. floor(max), upper ends excluded.

    ``boxes`` has lon_min, lat_min, lon_max, lat_max; other columns are carried along.
    """

    def corners(low: str, high: str) -> Column:
        first, end = F.floor(low).cast("int"), F.floor(high).cast("int")
        # sequence(1, 0) counts downwards, so an empty span needs its own case
        return F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))

    bounds = ("lon_min", "lat_min", "lon_max", "lat_max")
    grid = boxes.withColumn("_lat", F.explode(corners("lat_min", "lat_max"))).withColumn(
        "_lon", F.explode(corners("lon_min", "lon_max"))
    )
    return grid.select(
        *[c for c in boxes.columns if c not in bounds], tile_label(F.col("_lat"), F.col("_lon")).alias("tile")
    )


def tile_arrays(enriched: DataFrame) -> DataFrame:
    """(tile, spots): the sites of each tile in the order thinning and coverage produced them.

    A tile is one published document, and the mesh bounds how many sites one degree can hold.
    """
    order = F.struct(F.col("added_by"), (-F.col("darkness")).alias("rank"), F.col("cand_ord"))
    item = F.struct(order.alias("order"), F.struct(*SPOT_FIELDS).alias("spot"))
    grouped = with_tile(enriched).groupBy("tile").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return grouped.select("tile", F.transform("items", lambda i: i["spot"]).alias("spots"))


def envelopes(arrays: DataFrame, version: str, source: str, generated: str) -> DataFrame:
    return arrays.select(
        F.lit(version).alias("version"),
        F.lit(source).alias("source"),
        F.lit(generated).alias("generated"),
        "tile",
        "spots",
    )


def with_empty_tiles(arrays: DataFrame, tiles: DataFrame) -> DataFrame:
    """Add an empty array for every listed tile that holds no site; tiles outside the list stay."""
    return arrays.unionByName(empty_tiles(arrays, tiles).withColumn("spots", F.array().cast(arrays.schema["spots"].dataType)))


def empty_tiles(occupied: DataFrame, tiles: DataFrame) -> DataFrame:
    return tiles.select("tile").distinct().join(occupied.select("tile").distinct(), "tile", "left_anti")
