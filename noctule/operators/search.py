"""Reading a published release: sites around an observer and the tiles that hold them.

Sites stored by :func:`write_spots` lie in partitions of one degree of latitude by ten of longitude; a search reads only
those that its observers reach.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noctule import constants as K
from noctule.functions.geo import tile_id, tile_label
from noctule.operators.proximity import top_within

SEARCH_KM, SEARCH_MAX_KM, SHOWN = 75.0, 150.0, 20


def spots_around(observers: DataFrame, spots: DataFrame, key: str, radius_km: float = SEARCH_KM, shown: int = SHOWN) -> DataFrame:
    """The ``shown`` best sites (by ``score``, then ``id``) in the radius of each observer, best first by ``rnk``."""
    if not 0 < radius_km <= SEARCH_MAX_KM:
        raise ValueError(f"radius must be at most {SEARCH_MAX_KM} km")
    return top_within(observers, spots, radius_km, shown, key, (("score", "desc"), ("id", "asc")))


# degrees of longitude of a partition, and partitions around the globe
CELL_LON = 10
CELLS = 360 // CELL_LON


def _cell(south: Column, band: Column) -> Column:
    return ((south + 90) * CELLS + F.pmod(band, F.lit(CELLS))).cast("int")


def write_spots(spots: DataFrame, path: str) -> None:
    """Store sites with coordinates for ``stored_spots_around``; a crowded partition is dealt to several tasks by place."""
    located = spots.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    south = F.least(F.floor("lat"), F.lit(89))
    celled = located.withColumn("cell", _cell(south, F.floor((F.col("lon") + 180) / CELL_LON)))
    by_place = celled.repartitionByRange("cell", "lat", "lon").sortWithinPartitions("cell", "lat", "lon")
    by_place.write.mode("overwrite").partitionBy("cell").parquet(path)


def reached_cells(observers: DataFrame, radius_km: float) -> DataFrame:
    """Distinct ``cell`` of partitions that may hold a site at most ``radius_km`` from an observer."""
    d_lat = math.degrees(radius_km / K.EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-9
    located = observers.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    # the widest half-width in longitude of a circle that does not hold a pole
    wide = F.degrees(F.asin(F.least(F.lit(math.sin(math.radians(d_lat))) / F.cos(F.radians("lat")), F.lit(1.0)))) + 1e-9
    half = F.when(F.abs("lat") + d_lat >= 90, F.lit(180.0)).otherwise(wide)

    def steps(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low).cast("int"), F.floor(high).cast("int")))

    east = F.col("lon") + 180
    spread = located.withColumn("_south", steps(F.greatest(F.col("lat") - d_lat, F.lit(-90.0)), F.least(F.col("lat") + d_lat, F.lit(89.0))))
    spread = spread.withColumn("_band", steps((east - half) / CELL_LON, (east + half) / CELL_LON))
    return spread.select(_cell(F.col("_south"), F.col("_band")).alias("cell")).distinct()


def stored_spots_around(
    spark: SparkSession, observers: DataFrame, path: str, key: str, radius_km: float = SEARCH_KM, shown: int = SHOWN
) -> DataFrame:
    """``spots_around`` over sites of ``write_spots``, listing and opening only the partitions in reach.

    Their folders are named to the reader, at most 6,480 however many observers ask: a filter on the partition column
    would list every folder first. A store without a site has no columns and fails.
    """
    root = path.rstrip("/")
    cells = [r.cell for r in reached_cells(observers, radius_km).collect()]
    folders = [f for f in (f"{root}/cell={c}" for c in sorted(cells)) if _exists(spark, f)]
    if folders:
        stored = spark.read.option("basePath", root).parquet(*folders).drop("cell")
    else:
        stored = spark.read.parquet(root).drop("cell").limit(0)
    return spots_around(observers, stored, key, radius_km, shown)


def _exists(spark: SparkSession, folder: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def tiles_around(observers: DataFrame) -> DataFrame:
    """Each observer's tile and its eight neighbours; east-west wraps, nothing lies beyond a pole."""
    steps = F.array(*[F.lit(s) for s in (-1, 0, 1)])
    own = observers.withColumn("_own", tile_id(F.col("lat"), F.col("lon")))
    spread = own.withColumn("_dy", F.explode(steps)).withColumn("_dx", F.explode(steps))
    south = (F.floor("lat") + F.col("_dy")).cast("int")
    west = (F.pmod(F.floor("lon") + F.col("_dx") + 180, F.lit(360)) - 180).cast("int")
    named = spread.filter(south.between(-90, 89)).withColumn("tile", tile_label(south, west))
    return named.withColumn("own", F.col("tile") == F.col("_own")).drop("_own", "_dy", "_dx")
