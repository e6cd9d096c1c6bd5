import json

import numpy as np
import pandas as pd

from noctule.model import Grid
from noctule.plans import annual
from noctule.sources.rasters import read_pixels, write_pixels, write_segments
from tests.brute import cover, km_to_all, thin
from tests.test_sources_sinks import gazetteer_line

GRID = Grid(c=-5.0, f=51.0, a=0.05, e=-0.05, rows=200, cols=300)


def prepare(spark, tmp_path):
    y, x = np.indices((GRID.rows, GRID.cols))
    values = 0.5 + 30.0 * (x / GRID.cols + y / GRID.rows) / 2
    pdf = pd.DataFrame({"row": y.ravel(), "col": x.ravel(), "radiance": values.ravel()})
    write_pixels(spark.createDataFrame(pdf, "row int, col int, radiance double"), str(tmp_path / "radiance"), "france", 2025, 4)
    grid = [("france", 2025, GRID.c, GRID.f, GRID.a, GRID.e, GRID.rows, GRID.cols, True, 4326)]
    schema = "region string, year int, c double, f double, a double, e double, rows int, cols int, geographic boolean, epsg int"
    spark.createDataFrame(grid, schema).write.parquet(str(tmp_path / "radiance_grid"))
    (tmp_path / "places.txt").write_text(gazetteer_line(0, "TestVille", "48.5", "2.0", "1000") + "\n")
    (tmp_path / "regions.yaml").write_text("france: {bbox: [-5, 41, 10, 51], equal_area_epsg: 3035, admin_level: 8, osm_country_code: FR, name: France}\n")


def arguments(tmp_path, *more):
    base = "--region france --year 2025 --max-km 60 --mesh-km 20 --debug-raster".split()
    paths = {"--regions": "regions.yaml", "--places": "places.txt", "--raster": "radiance", "--out": "out", "--published": "published"}
    return annual.parser().parse_args([*base, *[w for k, v in paths.items() for w in (k, str(tmp_path / v))], *more])


def test_release_from_raster_to_published_documents(spark, tmp_path):
    prepare(spark, tmp_path)
    first = annual.run(spark, arguments(tmp_path))
    assert (first.version, first.changed) == ("2025.1", True)
    docs = {p.stem: json.loads(p.read_text()) for p in (tmp_path / "published").glob("*.json")}
    box = {f"N{a:03d}{'E' if o >= 0 else 'W'}{abs(o):03d}" for a in range(41, 51) for o in range(-5, 10)}
    assert box <= set(docs) and {d["version"] for d in docs.values()} == {"2025.1"}
    spots = [s for d in docs.values() for s in d["spots"]]
    assert spots and len({s["id"] for s in spots}) == len(spots)
    assert all(list(s) == ["lat", "lon", "darkness", "bortle", "near", "id", "altitude"] for s in spots)
    assert first.counts["covered"] == len(spots) and first.counts["places"] == 1 and first.counts["tiles"] == len(docs)
    assert first.counts["candidates"] >= first.counts["kept"] > 0 and first.counts["occupied_tiles"] == sum(bool(d["spots"]) for d in docs.values())
    assert spark.read.parquet(str(tmp_path / "out" / "debug")).count() == GRID.rows * GRID.cols
    # the same release again, from stored segments and over the pointer: nothing has changed
    write_segments(read_pixels(spark, str(tmp_path / "radiance"), "france", 2025), str(tmp_path / "segments"), "france", 2025)
    stored = ["--raster", str(tmp_path / "segments"), "--grids", str(tmp_path / "radiance_grid"), "--segments", "256"]
    again = annual.run(spark, arguments(tmp_path, "--atomic", *stored))
    assert (again.version, again.changed) == ("2025.1", False)
    assert not list((tmp_path / "published").glob("*.json")) and len(list((tmp_path / "published").glob("release-*/*.json"))) == len(docs)
    # by digests: the first such release writes all documents, an unchanged one none
    for _ in range(2):
        same = annual.run(spark, arguments(tmp_path, "--incremental", *stored))
        assert (same.version, same.changed) == ("2025.1", False)
    assert len(list((tmp_path / "published").glob("release-*/*.json"))) == len(docs) and len(list((tmp_path / "published").glob("release-*"))) == 1


def test_site_selection_equals_the_sequential_steps(spark):
    rng = np.random.default_rng(9)
    y, x = np.indices((60, 80))
    grid = Grid(c=0.0, f=48.0, a=0.05, e=-0.05, rows=60, cols=80)
    alr = rng.choice([0.05, 0.3, 1.5, 6.0, 12.0], (60, 80))
    px = spark.createDataFrame(pd.DataFrame({"row": y.ravel(), "col": x.ravel(), "alr": alr.ravel()}), "row int, col int, alr double")
    towns = pd.DataFrame({"place_ord": range(40), "name": [f"t{i}" for i in range(40)], "lat": rng.uniform(44.5, 48.5, 40), "lon": rng.uniform(-0.5, 4.5, 40), "population": 1})
    from noctule.operators.raster import mesh_minima, score_pixels

    scored = score_pixels(px)
    params = annual.SiteParams(mesh_km=11, coverage_km=25, redundancy_km=30)
    out = annual.select_sites(scored, spark.createDataFrame(towns, "place_ord bigint, name string, lat double, lon double, population bigint"), grid, params)
    mesh = mesh_minima(scored, grid, 11).toPandas()
    kept = thin(mesh, 30)
    want = [(c, -1) for c in kept] + cover(mesh[mesh.cand_ord.isin(kept)], mesh, towns, 4, 25)
    got = out.orderBy("added_by", out["darkness"].desc(), "cand_ord").collect()
    assert [(r.cand_ord, r.added_by) for r in got] == want
    for r in got:
        d = km_to_all(r.lat, r.lon, towns.lat.to_numpy(), towns.lon.to_numpy())
        assert r.near == (f"t{int(np.argmin(d))}" if d.min() <= 25 else "")
