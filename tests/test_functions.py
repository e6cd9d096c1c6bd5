import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from noctule.functions import alr_to_bortle, alr_to_darkness, bump_version, spot_id, tile_bounds, tile_fault, tile_id, version_parts

NAN = float("nan")


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": pd.Series(values, dtype=object)}), f"i int, x {kind}")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_bortle_bounds(spark):
    values = [0.05, 0.10, 0.11, 0.20, 0.33, 0.5, 1.0, 2.0, 4.0, 5.0, 10.0, 10.01, 100.0, NAN, None, -1.0]
    assert column(spark, values, alr_to_bortle) == [1, 1, 2, 2, 3, 4, 4, 5, 6, 7, 7, 8, 8, 9, 9, 1]


def test_darkness_scale(spark):
    d = column(spark, [0.001, 1.0, 100.0, 0.0, 0.1, 10.0], alr_to_darkness)
    assert d[0] > 0.9 and abs(d[1] - 0.5) < 0.01 and d[2] < 0.05 and d[3] == 1.0 and 0.99 < d[4] < 1 and d[5] == 0.0
    special = column(spark, [NAN, -0.001, -0.5, None], alr_to_darkness)
    assert math.isnan(special[0]) and special[1] == 1.0 and math.isnan(special[2]) and special[3] is None


def test_darkness_equals_the_formula_on_many_values(spark):
    alr = np.concatenate([[1e-9], np.geomspace(1e-4, 50, 4000)])
    got = column(spark, alr.tolist(), alr_to_darkness)
    want = np.clip(1 - (np.log10(alr + 1e-3) + 1) / 2, 0, 1)
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-12)
    steps = np.array(got) * 2**53
    assert (steps == np.floor(steps)).all()


def test_spot_id_rounds_like_exact_binary(spark):
    values = [42.7283, 1.6492, -0.0, -1e-6, 41.01875, 41.03125, 48.5, -179.99995, 180.0, 0.00005]
    values += (np.arange(-43200, 43200, 7) * 0.25 / 60 + 1 / 480).tolist()
    values += np.random.default_rng(0).uniform(-180, 180, 20_000).tolist()
    got = column(spark, values, lambda x: spot_id(x, F.lit(2.0)))
    assert got == [f"{v + 0.0:.4f}_2.0000" for v in values]


TILES = [
    (42.7283, 1.6492, "N042E001"), (-3.5, -42.25, "S004W043"), (0.0, 0.0, "N000E000"), (-0.0001, -0.0001, "S001W001"),
    (89.9999, 42.0, "N089E042"), (-89.9999, 42.0, "S090E042"), (0.0, -180.0, "N000W180"), (5.0, 179.99, "N005E179"),
]
NO_TILE = [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (90.1, 0.0), (0.0, -180.1), (NAN, 0.0), (0.0, None)]


def test_tile_id(spark):
    df = spark.createDataFrame(TILES, "lat double, lon double, want string")
    assert all(r.tile == r.want for r in df.select("want", tile_id(F.col("lat"), F.col("lon")).alias("tile")).collect())


@pytest.mark.parametrize("lat,lon", NO_TILE)
def test_no_tile(spark, lat, lon):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    row = df.select(tile_id(F.col("lat"), F.col("lon"), strict=False).alias("t"), tile_fault(F.col("lat"), F.col("lon")).alias("f")).first()
    assert row.t is None and row.f
    with pytest.raises(PySparkException):
        df.select(tile_id(F.col("lat"), F.col("lon"))).collect()


def test_all_tiles_are_unique_well_formed_and_invert(spark):
    cells = spark.range(64_800).select((F.floor(F.col("id") / 360) - 90).alias("a"), (F.col("id") % 360 - 180).alias("o"))
    named = cells.withColumn("t", tile_id(F.col("a") + 0.5, F.col("o") + 0.5)).withColumn("b", tile_bounds(F.col("t")))
    ok = (F.col("b.lat_min") == F.col("a")) & (F.col("b.lon_min") == F.col("o")) & (F.col("b.lat_max") == F.col("a") + 1) & (F.col("b.lon_max") == F.col("o") + 1)
    row = named.agg(F.countDistinct("t").alias("n"), F.count_if(F.col("t").rlike(r"^[NS]\d{3}[EW]\d{3}\z")).alias("f"), F.count_if(ok).alias("ok")).first()
    assert (row.n, row.f, row.ok) == (64_800, 64_800, 64_800)


def test_bad_tile_names(spark):
    names = ["N42E001", "X042E001", "N042E001 ", "N042E001\n", "", None]
    assert column(spark, names, lambda x: tile_bounds(x, strict=False), "string") == [None] * 6
    with pytest.raises(PySparkException):
        column(spark, ["N42E001"], tile_bounds, "string")
    assert column(spark, ["N999E999"], tile_bounds, "string")[0].lat_max == 1000.0


def test_versions(spark):
    assert column(spark, ["2025.3"], lambda v: bump_version(v, F.lit(True)), "string") == ["2025.4"]
    assert column(spark, ["2025.9"], lambda v: bump_version(v, F.lit(False)), "string") == ["2025.9"]
    parts = column(spark, ["2025.10", "25.1", "2025", "2025.1x", None], version_parts, "string")
    assert tuple(parts[0]) == (2025, 10) and parts[1:] == [None] * 4


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-180, 180), min_size=50, max_size=200))
def test_spot_id_on_any_numbers(spark, values):
    assert column(spark, values, lambda x: spot_id(x, x)) == [f"{v + 0.0:.4f}_{v + 0.0:.4f}" for v in values]
