import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from noctule.operators.search import reached_cells, spots_around, stored_spots_around, write_spots
from tests.brute import km_to_all

SPOT = "id string, lat double, lon double, score double"


def globe(n, seed):
    """Sites all over, many of them at the poles, the antimeridian and whole degrees."""
    rng = np.random.default_rng(seed)
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    lat[: n // 8], lat[n // 8 : n // 4] = rng.uniform(88, 90, n // 8), rng.uniform(-90, -88, n // 4 - n // 8)
    lon[n // 4 : n // 2] = np.where(rng.uniform(size=n // 2 - n // 4) < 0.5, -180 + rng.exponential(0.3, n // 2 - n // 4), 180 - rng.exponential(0.3, n // 2 - n // 4))
    lat[n // 4 : n // 2] = rng.uniform(-3, 3, n // 2 - n // 4)
    lat[-3:], lon[-3:] = (0.0, 90.0, -90.0), (180.0, 0.0, -180.0)
    return pd.DataFrame({"id": [f"s{i}" for i in range(n)], "lat": lat, "lon": lon, "score": rng.integers(0, 20, n) / 20})


@pytest.mark.parametrize("radius", [20.0, 150.0])
def test_stored_search_equals_brute_force(spark, tmp_path, radius):
    sites = globe(1200, 1)
    observers = globe(120, 2).rename(columns={"id": "point"})[["point", "lat", "lon"]]
    write_spots(spark.createDataFrame(sites, SPOT), str(tmp_path / "spots"))
    found = stored_spots_around(spark, spark.createDataFrame(observers), str(tmp_path / "spots"), "point", radius, 5)
    got = {(r.q_point, r.rnk, r.p_id) for r in found.select("q_point", "rnk", "p_id").collect()}
    want = set()
    for o in observers.itertuples():
        near = sites[km_to_all(o.lat, o.lon, sites.lat.to_numpy(), sites.lon.to_numpy()) <= radius]
        first = near.sort_values(["score", "id"], ascending=[False, True]).head(5)
        want |= {(o.point, k + 1, i) for k, i in enumerate(first.id)}
    assert got == want and want


def test_only_partitions_in_reach_are_opened(spark, tmp_path):
    path = str(tmp_path / "spots")
    sites = spark.range(6000).select(
        F.concat(F.lit("s"), "id").alias("id"), (F.col("id") % 20 + 35.5).alias("lat"),
        (F.col("id") * 7 % 600 / 10 - 20).alias("lon"), F.lit(0.5).alias("score"),
    )
    write_spots(sites, path)
    one = spark.createDataFrame([(1, 45.5, 5.0)], "point int, lat double, lon double")
    # 75 km are less than a degree of latitude and at this latitude less than a degree of longitude
    assert reached_cells(one, 75.0).count() == 3 * 1
    found = stored_spots_around(spark, one, path, "point")
    opened = lambda files: {int(f.split("cell=")[1].split("/")[0]) for f in files}
    assert opened(found.inputFiles()) == {(90 + s) * 36 + 18 for s in (44, 45, 46)}
    assert len(opened(spark.read.parquet(path).inputFiles())) == 20 * 6
    whole = spots_around(one, sites, "point").select("p_id").collect()
    assert {r.p_id for r in found.select("p_id").collect()} == {r.p_id for r in whole} and whole


def test_observers_and_sites_without_coordinates(spark, tmp_path):
    path = str(tmp_path / "spots")
    write_spots(spark.createDataFrame([("a", None, 1.0, 0.1), ("b", 45.0, None, 0.2), ("c", float("nan"), 1.0, 0.2), ("d", 45.0, 1.0, 0.3)], SPOT), path)
    observers = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 45.0, 1.0)], "point int, lat double, lon double")
    assert [(r.q_point, r.p_id) for r in stored_spots_around(spark, observers, path, "point").collect()] == [(3, "d")]
    nobody = observers.filter("point = 1")
    assert stored_spots_around(spark, nobody, path, "point").count() == 0
