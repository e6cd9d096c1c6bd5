"""Logical tables derived from the given ones by key arithmetic that every engine computes alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noctule.model import Grid, Region

RASTER_COLS = 150
BOX = Region("france", "France", (-5.0, 41.0, 10.0, 51.0), 3035, 8, "FR")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def grid(spark: SparkSession, sf_dir: str) -> Grid:
    """Grid of 150 columns over the box; as many rows as the orders fill."""
    last = read(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    rows = (last + 1) // RASTER_COLS
    return Grid(c=-5.0, f=51.0, a=0.1, e=-10.0 / rows, rows=rows, cols=RASTER_COLS)


def metric_grid(spark: SparkSession, sf_dir: str) -> Grid:
    g = grid(spark, sf_dir)
    return Grid(c=0.0, f=0.0, a=450.0, e=-450.0, rows=g.rows, cols=g.cols, geographic=False, epsg=3035)


def circle_grid(spark: SparkSession, sf_dir: str) -> Grid:
    """The same columns once around the globe, from 60 degrees north to 60 south."""
    g = grid(spark, sf_dir)
    return Grid(c=-180.0, f=60.0, a=2.4, e=-120.0 / g.rows, rows=g.rows, cols=g.cols)


def _row_col() -> list[Column]:
    return [
        F.expr(f"cast(o_orderkey div {RASTER_COLS} as int)").alias("row"),
        F.expr(f"cast(o_orderkey % {RASTER_COLS} as int)").alias("col"),
    ]


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row, col, alr); every 17th pixel has no data."""
    alr = F.when(F.col("o_orderkey") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice") / 40000.0)
    return read(spark, sf_dir, "orders").select(*_row_col(), alr.alias("alr"))


def tied_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``pixels`` with finished orders far below the darkest ratio, so that many pixels tie at darkness 1."""
    alr = F.when(F.col("o_orderkey") % 17 == 0, F.lit(float("nan"))).when(
        F.col("o_orderstatus") == "F", F.lit(0.01)
    ).otherwise(F.col("o_totalprice") / 40000.0)
    return read(spark, sf_dir, "orders").select(*_row_col(), alr.alias("alr"))


def nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pixels`` with cloud cover (unknown for every 5th), moon altitude and lit part, and sun altitude."""
    k = F.col("o_orderkey")
    alr = F.when(k % 17 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice") / 40000.0)
    return read(spark, sf_dir, "orders").select(
        *_row_col(),
        alr.alias("alr"),
        F.when(k % 5 != 0, (k * 37 % 101) / 100.0).alias("cloud"),
        ((k * 53 % 121) - 60).cast("double").alias("moon_deg"),
        (k * 29 % 101 / 100.0).alias("moon_lit"),
        ((k * 31 % 300) / 10.0 - 25.0).alias("sun_deg"),
    )


def radiance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(*_row_col(), (F.col("o_totalprice") / 20000.0).alias("radiance"))


def _lat_lon(key: str) -> tuple[Column, Column]:
    k = F.col(key)
    return F.lit(40.5) + ((k * 7919) % 11000) / 1000.0, F.lit(-6.0) + ((k * 6151) % 17000) / 1000.0


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = _lat_lon("c_custkey")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place_ord"),
        F.col("c_name").alias("name"),
        lat.alias("lat"),
        lon.alias("lon"),
        F.when(F.col("c_acctbal") >= 0, F.floor("c_acctbal")).alias("population"),
    )


def folded_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``places`` at five locations only, so that each location holds a fifth of them."""
    lat, lon = F.lit(42.0) + (F.col("c_custkey") % 5) * 1.5, F.lit(-3.0) + (F.col("c_custkey") % 5) * 2.5
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place_ord"), F.col("c_name").alias("name"), lat.alias("lat"), lon.alias("lon")
    )


def place_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounding box of the places of every nation."""
    lat, lon = _lat_lon("c_custkey")
    return read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.min(lon).alias("lon_min"), F.min(lat).alias("lat_min"), F.max(lon).alias("lon_max"), F.max(lat).alias("lat_max")
    )


def control_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = _lat_lon("s_suppkey")
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("point"),
        lat.alias("lat"),
        lon.alias("lon"),
        (F.lit(1) + F.col("s_suppkey") % 9).cast("int").alias("expected_bortle"),
    )


def _snapshot_spots(spark: SparkSession, sf_dir: str, newer: bool) -> DataFrame:
    k = F.col("c_custkey")
    base = ((k * 37) % 1000) / 1000.0
    darkness = F.when(k % 7 == 0, base + 0.001).otherwise(base) if newer else base
    left_out = 1 if newer else 0
    return read(spark, sf_dir, "customer").filter(k % 10 != left_out).select(
        k.cast("string").alias("id"), darkness.alias("darkness"), k.alias("k"), (k % 40).alias("tile_no")
    )


def old_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_spots(spark, sf_dir, False).select("id", "darkness")


def new_spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_spots(spark, sf_dir, True).select("id", "darkness")


def snapshot(spark: SparkSession, sf_dir: str, newer: bool) -> DataFrame:
    """(version, tile, spots) of 40 tiles; old versions run from 2025.1 to 2025.12."""
    spots = _snapshot_spots(spark, sf_dir, newer)
    items = F.array_sort(F.collect_list(F.struct("k", "id", "darkness")))
    return (
        spots.groupBy("tile_no")
        .agg(items.alias("items"))
        .select(
            F.concat(F.lit("2025."), (F.col("tile_no") % 12 + 1).cast("string")).alias("version"),
            F.concat(F.lit("T"), F.col("tile_no").cast("string")).alias("tile"),
            F.transform("items", lambda i: F.struct(i["id"].alias("id"), i["darkness"].alias("darkness"))).alias("spots"),
        )
    )


def _milli_text(x: Column) -> Column:
    """Number with three decimals."""
    m = F.round(F.abs(x) * 1000).cast("bigint")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(m / 1000).cast("string"), F.lit("."), F.lpad((m % 1000).cast("string"), 3, "0"))


def gazetteer_lines(spark: SparkSession, sf_dir: str, name: Column | None = None) -> DataFrame:
    """Text lines of 19 columns; every 13th is cut short and every 11th has no numeric latitude."""
    k = F.col("c_custkey")
    lat, lon = _lat_lon("c_custkey")
    population = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.floor("c_acctbal").cast("string"))
    head = [
        k.cast("string"), F.col("c_name") if name is None else name, F.col("c_name"), F.lit(""),
        F.when(k % 11 == 0, F.lit("x")).otherwise(_milli_text(lat)), _milli_text(lon),
        F.lit("P"), F.lit("PPL"), F.lit("FR"), F.lit(""),
    ]
    tail = [F.lit("a1"), F.lit(""), F.lit(""), F.lit(""), population, F.lit("0"), F.lit("0"), F.lit("UTC"), F.lit("2025-01-01")]
    short, full = F.concat_ws("\t", *head), F.concat_ws("\t", *head, *tail)
    return read(spark, sf_dir, "customer").select(
        F.when(k % 13 == 0, short).otherwise(full).alias("value"), k.alias("place_ord")
    )


def nameless_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines, every 17th without a name."""
    return gazetteer_lines(spark, sf_dir, F.when(F.col("c_custkey") % 17 == 0, F.lit("")).otherwise(F.col("c_name")))
