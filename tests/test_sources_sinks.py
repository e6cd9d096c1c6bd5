import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from noctule.model import ENVELOPE, Region
from noctule.operators.release import new_version, with_digest
from noctule.sinks.tables import append_results, publish_table, write_debug_raster
from noctule.sinks import tile_json
from noctule.sinks.tile_json import publish_changes, publish_tiles, shared_path, write_missing_tiles, write_tiles
from noctule.sources.control_points import read_control_points
from noctule.sources.places import bbox_filter, load_places, parse_places, read_lines
from noctule.sources.rasters import read_pixels, write_pixels
from noctule.sources.regions import get_region, load_regions, parse_regions, regions_frame
from noctule.sources.snapshots import read_digests, read_snapshot, read_tiles

FRANCE = Region("france", "France", (-5.0, 41.0, 10.0, 51.0), 3035, 8, "FR")


def gazetteer_line(i, name, lat, lon, population, columns=19):
    cols = [str(i), name, name, "", lat, lon, "P", "PPL", "FR", "", "a", "b", "c", "d", population, "1", "1", "Europe/Paris", "2025-01-01"]
    return "\t".join(cols[:columns])


def test_gazetteer_lines(spark):
    lines = [
        gazetteer_line(0, "Paris", "48.85341", "2.3488", "2138551"),
        "",
        "   ",
        gazetteer_line(1, "Cut", "48.0", "2.0", "1", columns=10),
        gazetteer_line(2, "Bad", "x", "2.0", "1"),
        gazetteer_line(3, "Suffix", "1.0d", "2.0", "1"),
        gazetteer_line(4, "Cugnaux", "43.53635", "1.34428", ""),
        gazetteer_line(5, "", "45.0", "-1e0", "12.5"),
        "  " + gazetteer_line(6, 'O"Quote', " 46.0 ", "+2.", " 77 ") + "  ",
        gazetteer_line(7, "Fifteen", "46.5", "2.5", "9", columns=15),
    ]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(lines)], "value string, place_ord bigint")
    got = [tuple(r) for r in parse_places(df).orderBy("place_ord").collect()]
    assert got == [
        (0, "Paris", 48.85341, 2.3488, 2138551),
        (6, "Cugnaux", 43.53635, 1.34428, None),
        (7, "", 45.0, -1.0, None),
        (8, 'O"Quote', 46.0, 2.0, 77),
        (9, "Fifteen", 46.5, 2.5, 9),
    ]


def test_lines_keep_file_order_over_splits(spark, tmp_path):
    path = tmp_path / "places.txt"
    path.write_text("".join(gazetteer_line(i, f"p{i}", "45.0", "2.0", str(i)) + "\n" for i in range(3000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = read_lines(spark, str(path))
        assert lines.rdd.getNumPartitions() >= 1
        got = [(r.place_ord, r.population) for r in parse_places(lines).orderBy("place_ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, i) for i in range(3000)]


def test_load_places_filters_by_box_and_needs_the_file(spark, tmp_path):
    path = tmp_path / "places.txt"
    rows = [("Paris", "48.85", "2.35"), ("Lyon", "45.76", "4.84"), ("Moscow", "55.75", "37.62"), ("London", "51.5", "-0.12"), ("Oslo", "59.9", "10.7")]
    path.write_text("".join(gazetteer_line(i, n, a, o, "1") + "\n" for i, (n, a, o) in enumerate(rows)), encoding="utf-8")
    assert [r.name for r in load_places(spark, FRANCE, str(path)).orderBy("place_ord").collect()] == ["Paris", "Lyon", "London"]
    with pytest.raises(PySparkException):
        load_places(spark, FRANCE, str(tmp_path / "absent.txt")).count()


def test_box_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(0, 45.0, 2.0), (1, 60.0, 2.0)], "place_ord bigint, lat double, lon double").write.parquet(str(tmp_path / "p"))
    near = bbox_filter(spark.read.parquet(str(tmp_path / "p")), FRANCE)
    assert "GreaterThanOrEqual(lat" in near._jdf.queryExecution().executedPlan().toString() and near.count() == 1


def test_regions(spark, tmp_path):
    text = 'france:\n  bbox: [-5, 41, 10, 51]\n  equal_area_epsg: 3035\n  admin_level: 8\n  osm_country_code: "FR"\n  name: "France"\n'
    (tmp_path / "regions.yaml").write_text(text)
    regions = load_regions(spark, str(tmp_path / "regions.yaml"))
    assert get_region(regions, "france") == FRANCE
    assert regions_frame(spark, regions).first().bbox == [-5.0, 41.0, 10.0, 51.0]
    assert parse_regions(json.dumps({"x": {"bbox": [0, 0, 1, 1], "equal_area_epsg": 1, "admin_level": 1, "osm_country_code": "X"}}))["x"].label == "x"
    with pytest.raises(KeyError, match="atlantis.*france"):
        get_region(regions, "atlantis")
    for bad in ("[1, 2]", "a: {bbox: [1, 2, 3, 4]}", "a: {bbox: [1, 2, 3], equal_area_epsg: 1, admin_level: 1, osm_country_code: X}"):
        with pytest.raises(ValueError):
            parse_regions(bad)


def test_pixel_store_prunes_partitions_and_windows(spark, tmp_path):
    root = str(tmp_path / "radiance")
    px = spark.range(400).select((F.col("id") / 20).cast("int").alias("row"), (F.col("id") % 20).cast("int").alias("col"), F.lit(1.5).cast("float").alias("radiance"))
    write_pixels(px, root, "france", 2025, files=2)
    write_pixels(px.filter("row < 3"), root, "spain", 2025, files=1)
    window = read_pixels(spark, root, "france", 2025, rows=(5, 7), cols=(0, 10))
    assert window.count() == 20 and read_pixels(spark, root, "spain", 2025).count() == 60 and read_pixels(spark, root, "spain", 2024).count() == 0
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "GreaterThanOrEqual(row,5)" in plan


def envelope_rows(spark, tiles, version="2025.1"):
    spots = [(42.5, 1.5, 0.25, 3, "Äx", "42.5000_1.5000", None)]
    return spark.createDataFrame([(version, "VIIRS/2025/france", "2026-01-01T00:00:00Z", t, spots if i == 0 else []) for i, t in enumerate(tiles)], ENVELOPE)


def test_tile_documents_round_trip_and_replace(spark, tmp_path):
    out = tmp_path / "spots"
    write_tiles(envelope_rows(spark, ["N042E001", "N042E002", "N042E003"]).repartition(3), str(out))
    assert sorted(p.name for p in out.iterdir()) == ["N042E001.json", "N042E002.json", "N042E003.json"]
    text = (out / "N042E001.json").read_text(encoding="utf-8")
    doc = json.loads(text)
    assert list(doc) == ["version", "source", "generated", "tile", "spots"] and text == json.dumps(doc, indent=4, ensure_ascii=False) + "\n"
    assert list(doc["spots"][0].items()) == [
        ("lat", 42.5), ("lon", 1.5), ("darkness", 0.25), ("bortle", 3), ("near", "Äx"), ("id", "42.5000_1.5000"), ("altitude", None),
    ]
    back = read_snapshot(spark, str(out))
    assert back.exceptAll(envelope_rows(spark, ["N042E001", "N042E002", "N042E003"])).count() == 0 and back.count() == 3
    write_tiles(envelope_rows(spark, ["N042E001", "N050E001"], "2025.2"), str(out))
    assert sorted(p.name for p in out.iterdir()) == ["N042E001.json", "N050E001.json"]
    write_missing_tiles(envelope_rows(spark, ["N042E001", "N060E001"], "2025.3"), str(out))
    versions = {r.tile: r.version for r in read_snapshot(spark, str(out)).collect()}
    assert versions == {"N042E001": "2025.2", "N050E001": "2025.2", "N060E001": "2025.3"}


def test_failed_write_leaves_the_published_set_alone(spark, tmp_path):
    out = tmp_path / "spots"
    write_tiles(envelope_rows(spark, ["N042E001"]), str(out))
    broken = envelope_rows(spark, ["N001E001", "N002E001"]).withColumn("tile", F.when(F.col("tile") == "N002E001", F.raise_error(F.lit("lost"))).otherwise(F.col("tile")))
    with pytest.raises(PySparkException):
        write_tiles(broken, str(out))
    assert [p.name for p in out.iterdir()] == ["N042E001.json"]


def test_snapshot_reader_is_tolerant_but_not_ambiguous(spark, tmp_path):
    assert read_snapshot(spark, str(tmp_path / "absent")).count() == 0
    write_tiles(envelope_rows(spark, ["N042E001"]), str(tmp_path / "s"))
    (tmp_path / "s" / "broken.json").write_text("{not json")
    assert [r.tile for r in read_tiles(spark, str(tmp_path / "s")).collect()] == ["N042E001"]
    (tmp_path / "s" / "again.json").write_text((tmp_path / "s" / "N042E001.json").read_text())
    with pytest.raises(ValueError, match="broken.json is not a tile document"):
        read_snapshot(spark, str(tmp_path / "s"))
    (tmp_path / "s" / "broken.json").write_text('{"version": "2025.1", "spots": []}')
    with pytest.raises(ValueError, match="broken.json is not a tile document"):
        read_snapshot(spark, str(tmp_path / "s"))
    (tmp_path / "s" / "broken.json").unlink()
    with pytest.raises(ValueError, match="N042E001"):
        read_snapshot(spark, str(tmp_path / "s"))


def test_control_points(spark, tmp_path):
    points = [{"lat": 44.2, "lon": 3.6, "expected_bortle": 2, "name": "A", "note": "n"}, {"lat": 45.5, "lon": 3, "expected_bortle": 4}]
    (tmp_path / "c.json").write_text(json.dumps(points, indent=2))
    got = read_control_points(spark, str(tmp_path / "c.json")).collect()
    assert [(r.lat, r.lon, r.expected_bortle, r.name) for r in got] == [(44.2, 3.6, 2, "A"), (45.5, 3.0, 4, None)]
    for bad in (json.dumps(points[0]), json.dumps([{"lat": 1.0, "lon": 2.0}])):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(PySparkException):
            read_control_points(spark, str(tmp_path / "bad.json")).collect()


def test_result_and_release_tables(spark, tmp_path):
    results = spark.createDataFrame([(44.2, 3.6, 2, 3, 0.5, True)], "lat double, lon double, expected_bortle int, got_bortle int, got_darkness double, match boolean")
    for run in ("r1", "r2"):
        append_results(results, str(tmp_path / "results"), run)
    assert {r.run_id for r in spark.read.parquet(str(tmp_path / "results")).collect()} == {"r1", "r2"}
    table = str(tmp_path / "release")
    publish_table(envelope_rows(spark, ["N042E001", "N042E002"]), table, "france")
    publish_table(envelope_rows(spark, ["N040W004"]), table, "spain")
    publish_table(envelope_rows(spark, ["N042E009"]), table, "france")
    assert {(r.region, r.tile) for r in spark.read.parquet(table).collect()} == {("france", "N042E009"), ("spain", "N040W004")}
    scored = spark.createDataFrame([(0, 0, 0.5, 3)], "row int, col int, darkness double, bortle int")
    write_debug_raster(scored, str(tmp_path / "debug"), "france", 2025)
    assert spark.read.parquet(str(tmp_path / "debug")).first().bortle == 3.0


def test_validation_job(spark, tmp_path):
    from noctule.plans import validate

    spark.createDataFrame([(0, 0, 0.05), (0, 1, 9.0)], "row int, col int, alr double").write.parquet(str(tmp_path / "ratio"))
    grid = [("france", 2025, 0.0, 1.0, 0.5, -0.5, 1, 2, True, 4326)]
    schema = "region string, year int, c double, f double, a double, e double, rows int, cols int, geographic boolean, epsg int"
    spark.createDataFrame(grid, schema).write.parquet(str(tmp_path / "grid"))
    (tmp_path / "points.json").write_text('[{"lat": 0.75, "lon": 0.25, "expected_bortle": 1}, {"lat": 9.0, "lon": 9.0, "expected_bortle": 9}]')
    args = ["--raster", f"{tmp_path}/ratio", "--grids", f"{tmp_path}/grid", "--region", "france", "--year", "2025"]
    args += ["--points", f"{tmp_path}/points.json", "--results", f"{tmp_path}/results", "--run-id", "first"]
    summary = validate.run(spark, validate.parser().parse_args(args))
    assert summary.points == 2
    assert spark.read.parquet(f"{tmp_path}/results").filter("run_id = 'first'").count() == 2


def _tiles(spark, version, *names):
    return spark.createDataFrame([(version, "s", "g", n, []) for n in names], ENVELOPE)


def _published(spark, path):
    return sorted((r.tile, r.version) for r in read_snapshot(spark, path).select("tile", "version").collect())


@pytest.mark.parametrize("step", ["switch_release", "remove_superseded"])
def test_a_publish_that_dies_leaves_one_whole_release(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "published")
    write_tiles(_tiles(spark, "2024.1", "N001E001", "N002E001"), path)  # loose documents, as earlier sets
    assert _published(spark, path) == [("N001E001", "2024.1"), ("N002E001", "2024.1")]
    publish_tiles(_tiles(spark, "2025.1", "N001E001", "N003E001"), path)
    old = [("N001E001", "2025.1"), ("N003E001", "2025.1")]
    assert _published(spark, path) == old and not list((tmp_path / "published").glob("*.json"))

    def dies(*args):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(tile_json, step, dies)
        with pytest.raises(RuntimeError):
            publish_tiles(_tiles(spark, "2025.2", "N003E001"), path)
    assert _published(spark, path) == (old if step == "switch_release" else [("N003E001", "2025.2")])
    # the next one cleans up
    publish_tiles(_tiles(spark, "2025.3", "N004E001"), path)
    assert _published(spark, path) == [("N004E001", "2025.3")]
    assert len(list((tmp_path / "published").glob("release-*"))) == 1


def test_a_document_that_cannot_be_written_leaves_the_old_release(spark, tmp_path):
    path = str(tmp_path / "published")
    publish_tiles(_tiles(spark, "2025.1", "N001E001"), path)
    with pytest.raises(Exception):
        publish_tiles(_tiles(spark, "2025.2", "N001E001", "no/such/folder"), path)
    assert _published(spark, path) == [("N001E001", "2025.1")]


def _with_sites(spark, version, generated, **sites):
    from noctule.model import ENVELOPE

    spot = lambda i: (42.5, 1.5, 0.5, 3, "", i, None)
    return spark.createDataFrame([(version, "s", generated, tile, [spot(i) for i in ids]) for tile, ids in sites.items()], ENVELOPE)


def _stamps(spark, path):
    return {r.tile: (r.version, r.generated, [s.id for s in r.spots]) for r in read_snapshot(spark, path).collect()}


def test_unchanged_documents_are_not_written_again(spark, tmp_path):
    path = str(tmp_path / "published")
    first = _with_sites(spark, "2025.1", "g1", N001E001=["a", "b"], N002E001=["c"], N003E001=[])
    assert publish_changes(first, path) == {"written": 3, "kept": 0, "removed": 0}
    documents = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "published").glob("release-*/*.json")}
    second = _with_sites(spark, "2025.2", "g2", N001E001=["b", "a"], N002E001=["c"], N004E001=["d"])
    assert publish_changes(second, path) == {"written": 2, "kept": 1, "removed": 1}
    assert _stamps(spark, path) == {"N001E001": ("2025.2", "g2", ["b", "a"]), "N002E001": ("2025.1", "g1", ["c"]), "N004E001": ("2025.2", "g2", ["d"])}
    kept = [f for f in (tmp_path / "published").glob("release-*/N002E001.json")]
    assert len(kept) == 1 and kept[0].stat().st_mtime_ns == documents["N002E001.json"]
    # the same set once more changes nothing, and its version is that of the release, not of a tile
    before = (tmp_path / "published" / "_current").read_text()
    assert publish_changes(_with_sites(spark, "2025.9", "g9", N001E001=["b", "a"], N002E001=["c"], N004E001=["d"]), path)["kept"] == 3
    assert (tmp_path / "published" / "_current").read_text() == before
    assert {(r.tile, r.version) for r in read_digests(spark, path).collect()} == {(t, "2025.2") for t in ("N001E001", "N002E001", "N004E001")}


def test_a_release_of_removed_tiles_only_has_its_version(spark, tmp_path):
    path = str(tmp_path / "published")
    publish_changes(_with_sites(spark, "2025.1", "g1", N001E001=["a"], N002E001=["c"]), path)
    publish_changes(_with_sites(spark, "2025.2", "g2", N002E001=["c"]), path)
    assert _stamps(spark, path) == {"N002E001": ("2025.1", "g1", ["c"])}
    new = with_digest(_with_sites(spark, "x", "g3", N002E001=["d"]))
    assert tuple(new_version(read_digests(spark, path), new, 2025, by="digest").first()) == ("2025.3", True)


def test_an_incremental_publish_that_dies_leaves_the_old_release(spark, tmp_path, monkeypatch):
    import noctule.sinks.tile_json as sink

    path = str(tmp_path / "published")
    publish_changes(_with_sites(spark, "2025.1", "g1", N001E001=["a"], N002E001=["c"]), path)
    old = _stamps(spark, path)

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "switch_release", dies)
        with pytest.raises(RuntimeError, match="lost"):
            publish_changes(_with_sites(spark, "2025.2", "g2", N001E001=["z"]), path)
    assert _stamps(spark, path) == old
    publish_changes(_with_sites(spark, "2025.2", "g2", N001E001=["z"], N002E001=["c"]), path)
    assert _stamps(spark, path) == {"N001E001": ("2025.2", "g2", ["z"]), "N002E001": ("2025.1", "g1", ["c"])}
    # a document that the index names must be there
    next((tmp_path / "published").glob("release-*/N002E001.json")).unlink()
    with pytest.raises(ValueError, match="named by the index"):
        read_snapshot(spark, path)


def test_a_flat_set_becomes_an_incremental_one(spark, tmp_path):
    path = str(tmp_path / "published")
    write_tiles(_with_sites(spark, "2025.1", "g1", N001E001=["a"], N002E001=[]), path)
    new = _with_sites(spark, "2025.2", "g2", N001E001=["a"], N002E001=["c"])
    assert {r.tile: r.version for r in read_digests(spark, path).collect()} == {"N001E001": "2025.1", "N002E001": "2025.1"}
    assert publish_changes(new, path)["written"] == 2
    assert set(_stamps(spark, path)) == {"N001E001", "N002E001"} and not list((tmp_path / "published").glob("*.json"))


def test_the_same_run_replaces_its_results(spark, tmp_path):
    path = str(tmp_path / "results")
    for run, n in (("a", 2), ("b", 3), ("a", 1)):
        append_results(spark.range(n).withColumnRenamed("id", "v"), path, run)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {"a": 1, "b": 3}


class _OnACluster:
    """The session as a standalone cluster shows it, with the shared folder written without a scheme."""

    def __init__(self, spark, shared):
        self._jvm, self._jsc = spark._jvm, spark._jsc
        self.sparkContext = type("Context", (), {"master": "spark://driver:7077", "getConf": lambda _: {}})()
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: shared if key == "spark.checkpoint.dir" else default})()


def test_the_shared_folder_of_a_cluster_needs_no_scheme(spark, tmp_path):
    cluster = _OnACluster(spark, f"{tmp_path}/shared/")
    assert shared_path(cluster, f"{tmp_path}/shared/documents-1") == f"file:{tmp_path}/shared/documents-1"
    assert shared_path(cluster, f"file:{tmp_path}/elsewhere") == f"file:{tmp_path}/elsewhere"
    for own_disk in (f"{tmp_path}/elsewhere", f"{tmp_path}/shared-too/x", f"{tmp_path}/shared/../x"):
        with pytest.raises(ValueError, match="own disk"):
            shared_path(cluster, own_disk)
    with pytest.raises(ValueError, match="own disk"):
        shared_path(_OnACluster(spark, None), f"{tmp_path}/shared/documents-1")


def test_documents_go_to_any_store_that_spark_reaches(spark, tmp_path):
    (tmp_path / "store").mkdir()
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.tiles.link./out", f"file://{tmp_path}/store")
    write_tiles(_tiles(spark, "2025.1", "N001E001", "N002E001"), "viewfs://tiles/out/flat")
    write_tiles(_tiles(spark, "2025.2", "N002E001"), "viewfs://tiles/out/flat")
    write_missing_tiles(_tiles(spark, "2025.3", "N002E001", "N003E001"), "viewfs://tiles/out/flat")
    assert _published(spark, "viewfs://tiles/out/flat") == [("N002E001", "2025.2"), ("N003E001", "2025.3")]
    for publish in (publish_tiles, publish_changes):
        path = f"viewfs://tiles/out/{publish.__name__}"
        publish(_tiles(spark, "2025.1", "N001E001", "N002E001"), path)
        publish(_tiles(spark, "2025.2", "N003E001"), path)
        assert _published(spark, path) == [("N003E001", "2025.2")]
    assert {(r.tile, r.version) for r in read_digests(spark, "viewfs://tiles/out/publish_changes").collect()} == {("N003E001", "2025.2")}


@pytest.mark.parametrize("publish", [publish_tiles, publish_changes])
def test_a_set_is_replaced_in_a_store_without_file_contexts(spark, tmp_path, publish):
    path, conf = str(tmp_path / "published"), spark._jsc.hadoopConfiguration()
    publish(_tiles(spark, "2025.1", "N001E001", "N002E001"), path)
    # as earlier versions left it, with a checksum file
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_current")
    name = (tmp_path / "published" / "_current").read_bytes()
    out = pointer.getFileSystem(conf).create(pointer, True)
    out.write(bytearray(name))
    out.close()
    assert (tmp_path / "published" / "._current.crc").exists() and len(_published(spark, path)) == 2
    conf.set("fs.AbstractFileSystem.file.impl", "no.such.FileSystem")
    try:
        publish(_tiles(spark, "2025.2", "N003E001"), path)
        publish(_tiles(spark, "2025.3", "N003E001", "N004E001"), path)
    finally:
        conf.unset("fs.AbstractFileSystem.file.impl")
    assert [tile for tile, _ in _published(spark, path)] == ["N003E001", "N004E001"]
    # the pointer has no checksum file that could be of another one
    assert not [f for f in (tmp_path / "published").iterdir() if f.name.startswith("._current")]
