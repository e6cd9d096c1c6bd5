import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from noctule.operators.thinning import redundancy_edges, redundancy_filter
from tests.brute import thin

SCHEMA = "cand_ord bigint, lat double, lon double, darkness double, bortle int"


def lattice(rows, cols, lat0, lon0, step, darkness, classes=1, seed=0):
    rng = np.random.default_rng(seed)
    r, c = np.divmod(np.arange(rows * cols), cols)
    lon = lon0 + step * c
    return pd.DataFrame(
        {
            "cand_ord": np.arange(rows * cols),
            "lat": lat0 - step * r,
            "lon": (lon + 180.0) % 360.0 - 180.0,
            "darkness": np.full(rows * cols, 1.0) if darkness == "tied" else rng.random(rows * cols),
            "bortle": rng.integers(1, classes + 1, rows * cols).astype("int32"),
        }
    )


def kept_by_spark(spark, pdf, **kw):
    df = spark.createDataFrame(pdf, SCHEMA).repartition(5)
    out = redundancy_filter(df, 15, **kw).orderBy(F.desc("darkness"), "cand_ord").select("cand_ord").collect()
    return [r.cand_ord for r in out]


@pytest.mark.parametrize("darkness", ["tied", "random"])
@pytest.mark.parametrize("group_rows", [10**6, 250])
def test_equals_the_sequential_scan(spark, darkness, group_rows):
    pdf = lattice(36, 40, 46.0, 1.0, 0.045, darkness, classes=2)
    assert kept_by_spark(spark, pdf, group_rows=group_rows) == thin(pdf, 15)


def test_a_plateau_is_decided_along_diagonals(spark):
    """Four times the candidates need twice the rounds, each with more groups, and not four times as many."""
    rounds = {}
    for side in (30, 60):
        pdf, ran = lattice(side, side, 46.0, 1.0, 0.13, "tied"), []
        assert kept_by_spark(spark, pdf, group_rows=100, rounds=ran) == thin(pdf, 15)
        rounds[side] = len(ran)
    assert rounds[60] <= 2 * rounds[30] + 3 and rounds[60] < 36


def test_segments_of_one_full_row(spark):
    pdf = lattice(5, 220, 46.1, 1.0, 0.045, "tied")
    assert kept_by_spark(spark, pdf, group_rows=60) == thin(pdf, 15)


@pytest.mark.parametrize("lat0,lon0", [(89.9, -180.0), (60.0, 178.5), (-88.0, 0.0)])
def test_poles_and_antimeridian(spark, lat0, lon0):
    pdf = lattice(14, 60, lat0, lon0, 0.06, "random")
    assert kept_by_spark(spark, pdf, group_rows=200) == thin(pdf, 15)


def test_crowded_places_are_settled_by_aggregates(spark):
    rng = np.random.default_rng(4)
    n = 1500
    crowd = pd.DataFrame(
        {
            "cand_ord": np.arange(n),
            "lat": 45.0 + rng.normal(0, 0.03, n),
            "lon": 2.0 + rng.normal(0, 0.03, n),
            "darkness": np.round(rng.random(n), 2),
            "bortle": np.where(np.arange(n) % 3 == 0, 2, 3).astype("int32"),
        }
    )
    crowd.loc[:400, ["lat", "lon"]] = [45.0, 2.0]
    wide = lattice(20, 20, 45.5, 1.5, 0.05, "random")
    wide["cand_ord"] += n
    pdf = pd.concat([crowd, wide], ignore_index=True)
    assert kept_by_spark(spark, pdf, crowd_rows=50, group_rows=150) == thin(pdf, 15)


def test_same_class_near_keeps_the_darker_and_other_class_stays(spark):
    rows = [(0, 48.0, 2.0, 0.5, 3), (1, 48.05, 2.0, 0.9, 3), (2, 48.02, 2.0, 0.4, 4), (3, 49.4, 2.0, 0.1, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = [r.cand_ord for r in redundancy_filter(df).orderBy(F.desc("darkness"), "cand_ord").collect()]
    assert out == [1, 2, 3]


def test_missing_class_equals_missing_class(spark):
    rows = [(0, 48.0, 2.0, 0.5, None), (1, 48.05, 2.0, 0.9, None), (2, 48.02, 2.0, 0.4, 4)]
    out = redundancy_filter(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.cand_ord for r in out) == [1, 2]


def test_empty_input(spark):
    assert redundancy_filter(spark.createDataFrame([], SCHEMA)).count() == 0


def test_edges_run_from_the_earlier_to_the_later(spark):
    rows = [(0, 48.0, 2.0, 0.5, 3), (1, 48.05, 2.0, 0.5, 3), (2, 48.1, 2.0, 0.6, 3), (3, 48.1, 2.0, 0.6, 5)]
    out = redundancy_edges(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.first_ord, r.second_ord) for r in out) == [(0, 1), (2, 0), (2, 1)]
