import pytest
from pyspark.sql import functions as F

from noctule.model import ENVELOPE
from noctule.operators.release import current_version, new_version, spot_diff, tile_changes
from noctule.operators.tiles import (
    empty_tiles,
    enrich,
    enumerate_tiles,
    envelopes,
    split_untiled,
    tile_arrays,
    with_empty_tiles,
)

SNAP = "version string, tile string, spots array<struct<id:string,darkness:double>>"


def snap(spark, tiles):
    return spark.createDataFrame([(v, t, s) for t, (v, s) in tiles.items()], SNAP)


A, B = [("a", 0.5)], [("b", 0.6)]
CASES = [
    ({}, {"t": ("x", A)}, 2026, ("2026.1", True)),
    ({"t": ("2026.1", A)}, {"t": ("x", A)}, 2026, ("2026.1", False)),
    ({"t": ("2025.3", A)}, {"t": ("x", A)}, 2026, ("2025.3", False)),
    ({"t": ("2026.1", A)}, {"t": ("x", B)}, 2026, ("2026.2", True)),
    ({"t": ("2026.1", A)}, {"t": ("x", A), "u": ("x", [])}, 2026, ("2026.2", True)),
    ({"t": ("2026.1", A), "u": ("2026.1", [])}, {"t": ("x", A)}, 2026, ("2026.2", True)),
    ({"t": ("2025.3", A)}, {"t": ("x", B)}, 2026, ("2026.1", True)),
    ({"t": ("2026.1", A + B)}, {"t": ("x", B + A)}, 2026, ("2026.2", True)),
    ({"t": ("2026.9", A), "u": ("2026.10", A)}, {"t": ("x", B), "u": ("x", A)}, 2026, ("2026.11", True)),
    ({}, {}, 2026, ("2026.1", True)),
]


@pytest.mark.parametrize("old,new,year,want", CASES)
def test_new_version(spark, old, new, year, want):
    assert tuple(new_version(snap(spark, old), snap(spark, new), year).first()) == want


def test_versions_compared_as_text(spark):
    old = snap(spark, {"t": ("2026.9", A), "u": ("2026.10", A)})
    assert tuple(new_version(old, snap(spark, {"t": ("x", B)}), 2026, lexicographic=True).first()) == ("2026.10", True)
    assert current_version(old, 2026, lexicographic=True).first().version == "2026.9"


def test_null_attributes_inside_spots_do_not_count_as_changes(spark):
    row = [("2026.1", "s", "g", "N042E001", [(42.5, 1.5, 0.5, 3, "", "42.5000_1.5000", None)])]
    same = spark.createDataFrame(row, ENVELOPE)
    assert tuple(new_version(same, same, 2026).first()) == ("2026.1", False)
    assert tile_changes(same, same).first().change == "same"


def test_current_version(spark):
    old = snap(spark, {"t": ("2025.1", A), "u": ("2025.2", A), "v": ("2025.10", A), "w": ("2024.99", A), "x": ("broken", A)})
    assert current_version(old, 2026).first().version == "2025.10"
    assert current_version(snap(spark, {}), 2026).first().version == "2026.1"
    assert current_version(snap(spark, {"x": ("broken", A)}), 2026).first().version == "2026.1"


SPOTS = "id string, darkness double"
DIFFS = [
    ([("a", 0.5)], [("a", 0.5)], (False, 0, 0, 0)),
    ([], [("a", 0.5)], (True, 1, 0, 0)),
    ([("a", 0.5)], [], (True, 0, 1, 0)),
    ([("a", 0.5), ("b", 0.1)], [("b", 0.1), ("a", 0.6)], (True, 0, 0, 1)),
    ([], [], (False, 0, 0, 0)),
    ([("a", None)], [("a", None)], (False, 0, 0, 0)),
]


@pytest.mark.parametrize("old,new,want", DIFFS)
def test_spot_diff(spark, old, new, want):
    assert tuple(spot_diff(spark.createDataFrame(old, SPOTS), spark.createDataFrame(new, SPOTS)).first()) == want


def test_spot_diff_takes_the_last_of_equal_ids(spark):
    old = spark.createDataFrame([("a", 0.1, 0), ("a", 0.5, 1)], SPOTS + ", pos int")
    new = spark.createDataFrame([("a", 0.5, 0)], SPOTS + ", pos int")
    assert tuple(spot_diff(old, new, "pos").first()) == (False, 0, 0, 0)


def boxes(spark, *rows):
    return spark.createDataFrame(list(rows), "lon_min double, lat_min double, lon_max double, lat_max double")


def test_enumerate(spark):
    tiles = [r.tile for r in enumerate_tiles(boxes(spark, (-5.0, 41.0, -3.0, 43.0))).collect()]
    assert sorted(tiles) == ["N041W004", "N041W005", "N042W004", "N042W005"]
    assert enumerate_tiles(boxes(spark, (0.0, 0.0, 0.0, 0.0), (3.0, 3.0, 1.0, 1.0))).count() == 0
    assert [r.tile for r in enumerate_tiles(boxes(spark, (-0.5, -0.5, 0.9, 0.9))).collect()] == ["S001W001"]
    assert enumerate_tiles(boxes(spark, (-180.0, -90.0, 180.0, 90.0))).distinct().count() == 64_800


def sites(spark):
    rows = [
        (7, 42.1, 1.1, 0.5, 3, "A", -1), (3, 42.2, 1.2, 0.5, 3, "", -1), (9, 42.3, 1.3, 0.9, 2, "B", -1),
        (1, 42.4, 1.4, 1.0, 1, "C", 5), (2, 43.4, -1.4, 0.2, 6, "Ö", -1),
    ]
    return spark.createDataFrame(rows, "cand_ord bigint, lat double, lon double, darkness double, bortle int, near string, added_by bigint").withColumn("row", F.lit(1)).withColumn("name", F.lit("x"))


def test_tile_arrays_keep_the_selection_order(spark):
    arrays = {r.tile: [s.id for s in r.spots] for r in tile_arrays(enrich(sites(spark))).collect()}
    assert arrays == {"N042E001": ["42.3000_1.3000", "42.2000_1.2000", "42.1000_1.1000", "42.4000_1.4000"], "N043W002": ["43.4000_-1.4000"]}


def test_envelopes(spark):
    all_tiles = enumerate_tiles(boxes(spark, (0.0, 42.0, 2.0, 43.0)))
    arrays = with_empty_tiles(tile_arrays(enrich(sites(spark))), all_tiles)
    out = envelopes(arrays, "2025.1", "VIIRS/2025/france", "2026-01-01T00:00:00Z")
    assert out.schema.fieldNames() == ENVELOPE.fieldNames()
    spots = {r.tile: [s.asDict() for s in r.spots] for r in out.collect()}
    assert set(spots) == {"N042E000", "N042E001", "N043W002"} and spots["N042E000"] == []
    (only,) = spots["N043W002"]
    assert (only["near"], only["id"], only["altitude"]) == ("Ö", "43.4000_-1.4000", None)
    assert [r.tile for r in empty_tiles(tile_arrays(enrich(sites(spark))), all_tiles).collect()] == ["N042E000"]


def test_enrich_drops_helpers_and_defaults(spark):
    out = enrich(sites(spark).drop("near", "bortle", "added_by"))
    assert out.columns == ["lat", "lon", "darkness", "bortle", "near", "id", "altitude", "cand_ord"]
    row = out.first()
    assert row.near is None and row.altitude is None and row.bortle is None


def test_points_without_a_tile_can_be_set_aside(spark):
    rows = spark.createDataFrame([(42.0, 1.0), (90.0, 1.0), (1.0, 180.0)], "lat double, lon double")
    good, bad = split_untiled(rows)
    assert good.count() == 1 and bad.count() == 2


@pytest.mark.parametrize("lexicographic", [False, True])
def test_an_unreadable_version_is_not_published_over(spark, lexicographic):
    old = spark.createDataFrame([("draft", "A", ["x"])], "version string, tile string, spots array<string>")
    new = spark.createDataFrame([("A", ["y"])], "tile string, spots array<string>")
    with pytest.raises(Exception, match="no valid version"):
        new_version(old, new, 2025, lexicographic).collect()


def test_a_spot_id_that_occurs_twice_needs_an_order(spark):
    old = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "id string, v int, k int")
    new = spark.createDataFrame([("a", 2, 1)], "id string, v int, k int")
    with pytest.raises(Exception, match="occurs twice"):
        spot_diff(old.drop("k"), new.drop("k")).collect()
    assert not spot_diff(old, new, "k").first().changed
