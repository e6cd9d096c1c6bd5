import math

import pytest
from pyspark.sql import functions as F

from noctule.functions.night import darkness_or_bortle, limiting_factor, moon_factor, night_score, twilight_factor, weather_age
from noctule.operators.search import spots_around, tiles_around


def test_factors(spark):
    df = spark.createDataFrame([(-20.0,), (-18.0,), (-15.0,), (-12.0,), (-9.0,), (-6.0,), (5.0,)], "h double")
    got = [r[0] for r in df.select(twilight_factor(F.col("h"))).collect()]
    assert [round(v, 9) for v in got] == [1.0, 1.0, 0.7, 0.4, 0.2, 0.0, 0.0]
    rows = spark.createDataFrame([(None, 3), (0.9, 9), (None, 9), (None, 1)], "d double, b int")
    assert [r[0] for r in rows.select(darkness_or_bortle(F.col("d"), F.col("b"))).collect()] == [0.75, 0.9, 0.0, 1.0]


def test_score_and_weakest_factor(spark):
    rows = [(0.91, 0.08, -5.0, 0.9, -30.0), (0.91, 0.95, -5.0, 0.9, -30.0), (0.91, 0.0, 40.0, 0.8, -30.0), (0.91, 0.1, -5.0, 0.0, -3.0), (0.91, None, -5.0, 0.0, -30.0)]
    df = spark.createDataFrame(rows, "dark double, cloud double, moon_deg double, lit double, sun double")
    moon, sun = moon_factor(F.col("moon_deg"), F.col("lit")), twilight_factor(F.col("sun"))
    out = df.select(night_score(F.col("dark"), F.col("cloud"), moon, sun).alias("s"), limiting_factor(F.col("cloud"), moon, sun).alias("l")).collect()
    assert [r.s.score for r in out] == [8, 0, 2, 0, 9]
    assert [r.s.weather_missing for r in out] == [False] * 4 + [True]
    assert [r.l for r in out] == ["ideal", "clouds", "moon", "twilight", "ideal"]
    assert math.isclose(out[0].s.raw, 0.91 * 0.92**2)


def test_weather_age(spark):
    df = spark.sql("SELECT timestamp'2025-01-01 12:00:00' - make_interval(0, 0, 0, 0, h) AS t, timestamp'2025-01-01 12:00:00' AS n FROM VALUES (0), (3), (4), (12), (13) v(h)")
    assert [r[0] for r in df.select(weather_age(F.col("t"), F.col("n"))).collect()] == ["fresh", "fresh", "aged", "aged", "stale"]


def test_tiles_around(spark):
    at = spark.createDataFrame([(0, 42.7, 1.6), (1, 0.5, -179.5), (2, 89.5, 0.5)], "k int, lat double, lon double")
    got = {}
    for r in tiles_around(at).collect():
        got.setdefault(r.k, {})[r.tile] = r.own
    assert len(got[0]) == 9 and got[0]["N042E001"] and not got[0]["N041E000"] and sum(got[0].values()) == 1
    assert {"N000E179", "S001W179", "N001W180"} <= set(got[1]) and len(got[1]) == 9
    assert len(got[2]) == 6


def test_best_spots_first(spark):
    spots = spark.createDataFrame([("a", 48.1, 2.0, 0.5), ("b", 48.2, 2.0, 0.9), ("c", 48.3, 2.0, 0.9), ("far", 52.0, 2.0, 1.0)], "id string, lat double, lon double, score double")
    who = spark.createDataFrame([(7, 48.0, 2.0)], "who int, lat double, lon double")
    assert [(r.p_id, r.rnk) for r in spots_around(who, spots, "who", shown=2).orderBy("rnk").collect()] == [("b", 1), ("c", 2)]
    with pytest.raises(ValueError):
        spots_around(who, spots, "who", 200)
