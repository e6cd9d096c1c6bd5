import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from noctule.functions import haversine_km
from noctule.operators.coverage import (
    attach_nearest_place,
    coverage_deficit,
    coverage_order,
    coverage_pool,
    ensure_coverage,
)
from noctule.operators.proximity import count_within, crowd_join, nearest_any, nearest_within, range_pairs, top_within
from tests.brute import cover, km_to_all, thin


def cloud(n, seed, hot=0, around=(47.0, 3.0), spread=(4.0, 6.0)):
    """Scattered points of which the first ``hot`` sit in one tight spot."""
    rng = np.random.default_rng(seed)
    lat = np.clip(around[0] + rng.uniform(-1, 1, n) * spread[0], -90, 90)
    lon = around[1] + rng.uniform(-1, 1, n) * spread[1]
    lat[:hot] = around[0] + rng.normal(0, 0.02, hot)
    lon[:hot] = around[1] + rng.normal(0, 0.02, hot)
    return pd.DataFrame({"id": np.arange(n), "lat": lat, "lon": (lon + 180) % 360 - 180, "darkness": rng.random(n).round(2)})


PLACES = [dict(around=(89.0, 10.0), spread=(1.0, 180.0)), dict(around=(-20.0, 179.9))]


@pytest.mark.parametrize("where", PLACES)
def test_range_pairs_equals_all_pairs(spark, where):
    q, p = cloud(120, 1, **where), cloud(150, 2, **where)
    got = range_pairs(spark.createDataFrame(q), spark.createDataFrame(p), 60.0).select("q_id", "p_id").collect()
    want = {(i, j) for i in q.id for j in np.flatnonzero(km_to_all(q.lat[i], q.lon[i], p.lat.to_numpy(), p.lon.to_numpy()) <= 60)}
    assert len(got) == len(want) and {(r.q_id, r.p_id) for r in got} == want


@pytest.mark.parametrize("where", PLACES)
@pytest.mark.parametrize("hot_rows", [10**6, 45])
def test_count_within_equals_all_pairs(spark, where, hot_rows):
    q, p = cloud(150, 3, hot=60, **where), cloud(400, 4, hot=200, **where)
    p.loc[100:140, ["lat", "lon"]] = p.loc[100, ["lat", "lon"]].to_list()
    got = count_within(spark.createDataFrame(q), spark.createDataFrame(p), 80.0, "id", hot_rows).collect()
    want = [int((km_to_all(a, b, p.lat.to_numpy(), p.lon.to_numpy()) <= 80).sum()) for a, b in zip(q.lat, q.lon)]
    assert [r.within for r in sorted(got, key=lambda r: r.id)] == want


@pytest.mark.parametrize("where", PLACES)
@pytest.mark.parametrize("hot_rows", [10**6, 45])
def test_top_within_equals_all_pairs(spark, where, hot_rows):
    q, p = cloud(80, 5, hot=30, **where), cloud(400, 6, hot=200, **where)
    p.loc[100:140, ["lat", "lon"]] = p.loc[100, ["lat", "lon"]].to_list()
    order = (("darkness", "desc"), ("id", "asc"))
    out = top_within(spark.createDataFrame(q), spark.createDataFrame(p), 90.0, 3, "id", order, hot_rows)
    got = {(r.q_id, r.rnk): r.p_id for r in out.select("q_id", "rnk", "p_id").collect()}
    want = {}
    for i in q.id:
        near = p[km_to_all(q.lat[i], q.lon[i], p.lat.to_numpy(), p.lon.to_numpy()) <= 90]
        near = near.sort_values(["darkness", "id"], ascending=[False, True])
        want.update({(i, k + 1): v for k, v in enumerate(near.id.head(3))})
    assert got == want


@pytest.mark.parametrize("where", PLACES)
@pytest.mark.parametrize("hot_rows", [10**6, 45])
def test_nearest_equals_all_pairs(spark, where, hot_rows):
    q, p = cloud(150, 7, hot=60, **where), cloud(400, 8, hot=200, **where)
    p.loc[100:140, ["lat", "lon"]] = p.loc[100, ["lat", "lon"]].to_list()
    far = [km_to_all(a, b, p.lat.to_numpy(), p.lon.to_numpy()) for a, b in zip(q.lat, q.lon)]
    sq, sp = spark.createDataFrame(q), spark.createDataFrame(p.rename(columns={"id": "ord"}))
    got = {r.id: r.p_ord for r in nearest_within(sq, sp, 40.0, "id", "ord", hot_rows).collect()}
    assert got == {i: int(np.argmin(d)) for i, d in enumerate(far) if d.min() <= 40}
    everywhere = {r.id: r.p_ord for r in nearest_any(sq, sp, "id", "ord", 20.0, hot_rows).collect()}
    assert everywhere == {i: int(np.argmin(d)) for i, d in enumerate(far)}


def test_crowd_join_equals_the_plain_join(spark):
    q = spark.range(3000).select(F.col("id").alias("q_id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("cell"))
    p = spark.range(60).select(F.col("id").alias("p_id"), F.when(F.col("id") < 5, 7).otherwise(F.col("id") * 3).alias("cell"))
    plain = q.join(p, "cell").select("cell", "q_id", "p_id")
    salted = crowd_join(q, p, ("cell",), crowd=100).select("cell", "q_id", "p_id")
    assert salted.count() == plain.count() > 10_000 and salted.exceptAll(plain).count() == 0


def test_haversine_known_distances(spark):
    rows = [(48.8566, 2.3522, 45.764, 4.8357), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (45.764, 4.8357, 48.8566, 2.3522)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    km = [r.km for r in df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("km")).collect()]
    assert 390 < km[0] < 396 and km[1] == 0 and 20000 < km[2] < 20030 and km[0] == km[3]


SITES = "cand_ord bigint, lat double, lon double, darkness double, bortle int"
TOWNS = "place_ord bigint, name string, lat double, lon double, population bigint"


def sites_and_towns(n_sites, n_towns, seed, tie):
    rng = np.random.default_rng(seed)
    mesh = pd.DataFrame(
        {
            "cand_ord": np.arange(n_sites),
            "lat": rng.uniform(44, 48, n_sites),
            "lon": rng.uniform(0, 6, n_sites),
            "darkness": rng.random(n_sites).round(tie),
            "bortle": rng.integers(1, 4, n_sites).astype("int32"),
        }
    )
    towns = pd.DataFrame(
        {
            "place_ord": np.arange(n_towns),
            "name": [f"t{i}" for i in range(n_towns)],
            "lat": rng.uniform(43.5, 48.5, n_towns),
            "lon": rng.uniform(-0.5, 6.5, n_towns),
            "population": np.arange(n_towns),
        }
    )
    towns.loc[n_towns // 2 :: 7, ["lat", "lon"]] = [45.5, 3.0]
    return mesh, towns


@pytest.mark.parametrize("seed,n_sites,n_towns,tie,radius", [(1, 300, 150, 1, 40), (3, 40, 80, 0, 50), (4, 900, 200, 2, 25)])
def test_coverage_equals_the_sequential_scan(spark, seed, n_sites, n_towns, tie, radius):
    mesh, towns = sites_and_towns(n_sites, n_towns, seed, tie)
    kept = mesh[mesh.cand_ord.isin(thin(mesh, 70))]
    out = ensure_coverage(spark.createDataFrame(kept, SITES), spark.createDataFrame(mesh, SITES), spark.createDataFrame(towns, TOWNS), 4, radius)
    got = [(r.cand_ord, r.added_by) for r in out.orderBy(*coverage_order()).collect()]
    want = [(c, -1) for c in thin(mesh, 70)] + cover(kept, mesh, towns, 4, radius)
    assert got == want


def test_coverage_in_many_blocks(spark):
    """Blocks wait for each other, and crowded ones go on stretch by stretch of the order; wraps at the antimeridian."""
    rng = np.random.default_rng(15)
    lat, lon = 20 + rng.uniform(-5, 5, 700), (180 + rng.uniform(-6, 6, 700) + 180) % 360 - 180
    mesh = pd.DataFrame({"cand_ord": np.arange(700), "lat": lat, "lon": lon, "darkness": rng.random(700).round(1), "bortle": np.int32(3)})
    kept = mesh[mesh.cand_ord.isin(thin(mesh, 250))]
    n = 150
    towns = pd.DataFrame({"place_ord": rng.permutation(n) * 3, "name": "x", "lat": 20 + rng.uniform(-5, 5, n), "lon": (180 + rng.uniform(-6, 6, n) + 180) % 360 - 180})
    # a third of the towns close together
    towns.loc[:50, "lat"], towns.loc[:50, "lon"] = 20 + rng.normal(0, 0.05, 51), 179.9 + rng.normal(0, 0.05, 51)
    rounds = []
    sites = spark.createDataFrame(mesh[["cand_ord", "lat", "lon", "darkness", "bortle"]])
    out = ensure_coverage(sites.filter(F.col("cand_ord").isin(kept.cand_ord.tolist())), sites, spark.createDataFrame(towns), 4, 90.0, 15, rounds)
    got = [(r.cand_ord, r.added_by) for r in out.orderBy(*coverage_order()).collect() if r.added_by >= 0]
    assert got == cover(kept, mesh, towns, 4, 90.0) and len(rounds) > 1


def test_coverage_serves_dense_places_in_stretches(spark):
    """The first places serve most of the others, which take no part in any round."""
    rng = np.random.default_rng(21)
    mesh = pd.DataFrame({"cand_ord": np.arange(200), "lat": 45 + rng.uniform(-5, 5, 200), "lon": rng.uniform(-6, 6, 200), "darkness": rng.random(200).round(2), "bortle": np.int32(3)})
    towns = pd.DataFrame({"place_ord": rng.permutation(400) * 2, "name": "x", "lat": 45 + rng.uniform(-5, 5, 400), "lon": rng.uniform(-6, 6, 400)})
    rounds = []
    sites = spark.createDataFrame(mesh)
    out = ensure_coverage(sites.limit(0), sites, spark.createDataFrame(towns), 2, 150.0, 100, rounds)
    got = [(r.cand_ord, r.added_by) for r in out.orderBy(*coverage_order()).collect()]
    assert got == cover(mesh[:0], mesh, towns, 2, 150.0)
    assert max(rounds) <= 110 and sum(rounds) < 250


def test_coverage_small_cases(spark):
    town = spark.createDataFrame([(0, "A", 48.0, 2.0, 1)], TOWNS)
    pts = [(i, 48.0 + i / 10, 2.0, 0.5 + i / 100, 3) for i in range(5)]
    mesh = spark.createDataFrame(pts, SITES)
    assert ensure_coverage(mesh, mesh, town).count() == 5
    assert ensure_coverage(mesh.filter("cand_ord < 2"), mesh, town).count() == 4
    none = mesh.filter("cand_ord < 0")
    assert ensure_coverage(none, none, town).count() == 0
    assert ensure_coverage(mesh, mesh, town.filter("place_ord < 0")).count() == 5


def test_equal_valued_copy_is_a_site_of_its_own(spark):
    town = spark.createDataFrame([(0, "A", 48.0, 2.0, 1)], TOWNS)
    mesh = spark.createDataFrame([(0, 48.1, 2.0, 0.9, 3), (1, 48.1, 2.0, 0.9, 3)], SITES)
    assert ensure_coverage(mesh.filter("cand_ord = 0"), mesh, town, 2, 100).count() == 2


def test_deficit_and_pool(spark):
    towns = spark.createDataFrame([(0, "A", 48.0, 2.0, 1), (1, "B", 10.0, 2.0, 1)], TOWNS)
    mesh = spark.createDataFrame([(i, 48.1, 2.0 + i / 10, 0.1 * i, 3) for i in range(6)], SITES)
    kept = mesh.filter("cand_ord in (0, 1)")
    short = {r.place_ord: (r.within, r.need) for r in coverage_deficit(kept, towns, 4, 100).collect()}
    assert short == {0: (2, 2), 1: (0, 4)}
    pool = [(r.place_ord, r.cand_ord, r.rnk) for r in coverage_pool(kept, mesh, towns, 4, 100).collect()]
    assert sorted(pool) == [(0, 4, 2), (0, 5, 1)]


def test_nearest_place_labels(spark):
    towns = spark.createDataFrame(
        [(0, "Paris", 48.8566, 2.3522, 1), (1, "Lyon", 45.764, 4.8357, 1), (2, "Twin", 45.764, 4.8357, 1), (3, "Nowhere", None, 2.0, 1), (4, None, 10.0, 10.0, 1)],
        TOWNS,
    )
    spots = spark.createDataFrame(
        [(0, 48.86, 2.35, None), (1, 45.77, 4.84, None), (2, 43.0, -3.0, None), (3, 48.86, 2.35, "Kept"), (4, 48.86, 2.35, ""), (5, 10.0, 10.0, None)],
        "cand_ord bigint, lat double, lon double, near string",
    )
    near = {r.cand_ord: r.near for r in attach_nearest_place(spots, towns).collect()}
    assert near == {0: "Paris", 1: "Lyon", 2: "", 3: "Kept", 4: "", 5: ""}
    far = {r.cand_ord: r.near for r in attach_nearest_place(spots, towns, None).collect()}
    assert far[2] == "Paris" or far[2] == "Lyon"
    twice = attach_nearest_place(attach_nearest_place(spots, towns), towns)
    assert {r.cand_ord: r.near for r in twice.collect()} == near


@pytest.mark.parametrize("n", [4_000, 16_000])
def test_nearest_of_dense_points_meets_few_of_them(spark, monkeypatch, n):
    from noctule.operators import proximity

    met = []

    def counted(*args, **kwargs):
        pairs = range_pairs(*args, **kwargs)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(proximity, "range_pairs", counted)
    q, p = cloud(40, 11, spread=(0.5, 0.5)), cloud(n, 12, spread=(0.5, 0.5))
    # copies at one place, of which the first counts, and two queries without a point in reach
    p.loc[100:140, ["lat", "lon"]] = q.loc[0, ["lat", "lon"]].to_list()
    q.loc[38:39, "lat"] += 20.0
    got = {r.id: r.p_id for r in nearest_within(spark.createDataFrame(q), spark.createDataFrame(p), 25.0, "id", "id").collect()}
    km = [km_to_all(a, b, p.lat.to_numpy(), p.lon.to_numpy()) for a, b in zip(q.lat, q.lon)]
    assert got == {i: int(np.argmin(d)) for i, d in enumerate(km) if d.min() <= 25} and len(got) == 38 and got[0] == 100
    # all points within 25 km are several hundred a query
    assert sum(met) < 40 * 100
