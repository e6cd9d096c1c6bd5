import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from noctule.model import Grid
from noctule.operators.raster import bortle_histogram, debug_raster, mesh_minima, sample_at, score_pixels
from noctule.operators.validation import judge, validate_bortle, validation_summary

GRID = Grid(c=-5.0, f=51.0, a=0.05, e=-0.05, rows=50, cols=43)


def scored(spark, values):
    r, c = np.indices(values.shape)
    pdf = pd.DataFrame({"row": r.ravel().astype("int32"), "col": c.ravel().astype("int32"), "alr": values.ravel()})
    df = spark.createDataFrame(pdf, "row int, col int, alr double")
    return score_pixels(df.repartition(6))


def mesh_by_hand(darkness, px_y, px_x, best):
    out = {}
    n_cols = -(-darkness.shape[1] // px_x)
    for i, r in enumerate(range(0, darkness.shape[0], px_y)):
        for j, c in enumerate(range(0, darkness.shape[1], px_x)):
            cell = darkness[r : r + px_y, c : c + px_x]
            if not np.isnan(cell).all():
                k = int(best(cell))
                out[i * n_cols + j] = (r + k // cell.shape[1], c + k % cell.shape[1])
    return out


@pytest.mark.parametrize("pick,best", [("min", np.nanargmin), ("max", np.nanargmax)])
@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("mesh_km", [5, 21, 300])
def test_mesh_equals_a_scan_of_the_cells(spark, pick, best, packed, mesh_km):
    alr = np.random.default_rng(2).choice([0.01, 0.5, 1.0, 3.0, 20.0, 11.0, np.nan], (50, 43))
    alr[:8, :9] = np.nan
    df = scored(spark, alr)
    d = np.full(alr.shape, np.nan)
    for r in df.collect():
        d[r.row, r.col] = r.darkness
    px = max(1, round(mesh_km / 111.32 / 0.05))
    got = {r.cand_ord: r for r in mesh_minima(df, GRID, mesh_km, pick, unit_darkness=packed).collect()}
    want = mesh_by_hand(d, px, px, best)
    assert {k: (r.row, r.col) for k, r in got.items()} == want
    for r in got.values():
        assert r.darkness == d[r.row, r.col] and r.lat == 51.0 + -0.05 * (r.row + 0.5) and r.lon == -5.0 + 0.05 * (r.col + 0.5)
        assert r.bortle == {0.01: 1, 0.5: 4, 1.0: 4, 3.0: 6, 20.0: 8, 11.0: 8}[alr[r.row, r.col]]


def test_all_nan_gives_no_candidate_and_wrong_input_fails(spark):
    assert mesh_minima(scored(spark, np.full((50, 43), np.nan)), GRID).count() == 0
    with pytest.raises(ValueError):
        mesh_minima(scored(spark, np.ones((2, 2))), Grid(0, 0, 450, -450, 2, 2, geographic=False))
    odd = scored(spark, np.ones((2, 2))).withColumn("darkness", F.lit(0.3) * F.lit(1e-9))
    with pytest.raises(PySparkException):
        mesh_minima(odd, GRID, 5, unit_darkness=True).collect()


def test_mesh_aggregates_by_hash_before_the_only_shuffle(spark):
    plan = mesh_minima(scored(spark, np.ones((4, 4))), GRID, 21, unit_darkness=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1 and "partial_min" in plan


def test_sampling_and_validation(spark):
    alr = np.full((50, 43), 0.5)
    alr[0, 0], alr[49, 42] = np.nan, 20.0
    df = scored(spark, alr)
    points = spark.createDataFrame(
        [(50.99, -4.99, 9), (48.51, -2.86, 7), (49.0, -4.0, 5), (49.0, -4.0, 6), (60.0, 0.0, 9), (None, 0.0, 8), (float("nan"), 0.0, 1)],
        "lat double, lon double, expected_bortle int",
    )
    sampled = sample_at(points, df, GRID).collect()
    assert len(sampled) == 7
    rows = validate_bortle(points, df, GRID).collect()
    got = sorted((r.expected_bortle, r.got_bortle, r.match) for r in rows)
    assert got == [(1, 9, False), (5, 4, True), (6, 4, False), (7, 8, True), (8, 9, True), (9, 9, True), (9, 9, True)]
    s = validation_summary(validate_bortle(points, df, GRID)).first()
    assert s.points == 7 and s.exact == 2 and abs(s.match_share - 5 / 7) < 1e-12
    predicted = points.withColumns({"got_bortle": F.col("expected_bortle") + 2, "got_darkness": F.lit(0.5)})
    assert not any(r.match for r in judge(predicted).collect())


def test_histogram_and_debug_export(spark):
    alr = np.array([[0.05, 0.15], [100.0, np.nan]])
    df = scored(spark, alr)
    assert {r.bortle: r.pixels for r in bortle_histogram(df).collect()} == {1: 1, 2: 1, 8: 1, 9: 1}
    assert debug_raster(df).dtypes == [("row", "int"), ("col", "int"), ("darkness", "float"), ("bortle", "float")]
