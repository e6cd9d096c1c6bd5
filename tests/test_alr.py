import numpy as np
import pandas as pd
import pytest

from noctule.model import Grid
from noctule.operators import alr
from noctule.operators.alr import AlrParams, compute_alr, ring_sums, row_segments, route_segments, layout, weigh_rings
from noctule.sources.rasters import read_segments, write_segments

PLANE = Grid(c=3_500_000, f=3_000_000, a=450.0, e=-450.0, rows=60, cols=70, geographic=False, epsg=3035)
GLOBE = Grid(c=2.0, f=60.0, a=0.02, e=-0.02, rows=50, cols=60)
SMALL = AlrParams(max_km=4.5, rings=6, noise_floor=0.5)


def field(grid, seed=0):
    return np.random.default_rng(seed).uniform(0, 20, (grid.rows, grid.cols))


def frame(spark, values):
    r, c = np.indices(values.shape)
    pdf = pd.DataFrame({"row": r.ravel().astype("int32"), "col": c.ravel().astype("int32"), "radiance": values.ravel()})
    return spark.createDataFrame(pdf).repartition(4)


def image(df, grid, name="alr"):
    out = np.full((grid.rows, grid.cols), np.nan)
    pdf = df.toPandas()
    assert not pdf.duplicated(["row", "col"]).any()
    out[pdf["row"], pdf["col"]] = pdf[name]
    return out


def brute(values, grid, params):
    """Every pixel against every pixel."""
    v = np.where(values < params.noise_floor, 0.0, values)
    outer, w = params.edges(), params.weights()
    r, c = np.indices(v.shape)
    out = np.full(v.shape, np.nan)
    lat = np.radians(grid.f + grid.e * (r + 0.5)) if grid.geographic else None
    for i in range(grid.rows):
        for j in range(grid.cols):
            if grid.geographic:
                a = np.sin((lat - lat[i, j]) / 2) ** 2 + np.cos(lat) * np.cos(lat[i, j]) * np.sin(np.radians((c - j) * grid.a) / 2) ** 2
                km = 2 * 6371.0 * np.arcsin(np.sqrt(a))
                area = np.cos(lat) * abs(grid.a * grid.e) * (np.pi * 6371000.0 / 180 / params.work_resolution_m) ** 2
                half = np.degrees(np.arcsin(np.sin(params.max_km / 6371.0) / np.cos(lat[i, j]))) / grid.a
                up = params.max_km / (abs(grid.e) * np.pi * 6371.0 / 180)
            else:
                km = np.hypot((r - i) * grid.e, (c - j) * grid.a) / 1000
                area, half, up = 1.0, params.max_km * 1000 / grid.a, params.max_km * 1000 / abs(grid.e)
            half, up = int(half + 1e-9), int(up + 1e-9)
            if not (up <= i < grid.rows - up and half <= j < grid.cols - half):
                continue
            k = np.searchsorted(outer, km, side="left")
            inside = k < outer.size
            out[i, j] = params.calib_c * (v * area * np.where(inside, w[np.minimum(k, outer.size - 1)], 0)).sum()
    return out


@pytest.mark.parametrize("block_px", [4096, 17])
@pytest.mark.parametrize("grid", [PLANE, GLOBE])
def test_blocked_equals_every_pixel_against_every_pixel(spark, grid, block_px):
    values = field(grid)
    got = image(compute_alr(frame(spark, values), grid, SMALL, block_px), grid)
    np.testing.assert_allclose(got, brute(values, grid, SMALL), rtol=1e-9, atol=1e-12)
    assert np.isfinite(got).any() and np.isnan(got[0]).all()


CIRCLE = Grid(c=-180.0, f=40.0, a=4.5, e=-4.0, rows=20, cols=80)
FAR = AlrParams(max_km=1500, rings=5, noise_floor=0.5)


@pytest.mark.parametrize("block_px,segment_px", [(4096, 256), (6, 7)])
def test_full_circle_has_no_seam(spark, block_px, segment_px):
    """A turned raster has the turned ratio, and far from the old seam it is that of the grid with edges."""
    values = field(CIRCLE, 8)
    got = image(compute_alr(frame(spark, values), CIRCLE, FAR, block_px, segment_px), CIRCLE)
    assert np.isnan(got[:3]).all() and np.isfinite(got[3:-3]).all()
    turned = image(compute_alr(frame(spark, np.roll(values, 33, axis=1)), CIRCLE, FAR, block_px, segment_px), CIRCLE)
    np.testing.assert_allclose(turned, np.roll(got, 33, axis=1), rtol=1e-9, atol=1e-9)
    part = Grid(c=-180.0 + 4.5, f=40.0, a=4.5, e=-4.0, rows=20, cols=79)
    inside = brute(values[:, 1:], part, FAR)
    some = np.isfinite(inside)
    assert some.sum() > 500
    np.testing.assert_allclose(got[:, 1:][some], inside[some], rtol=1e-9, atol=1e-9)


def test_radius_around_the_globe_is_refused(spark):
    with pytest.raises(ValueError):
        layout(CIRCLE, AlrParams(max_km=17_000), 20)


def test_kernels_of_a_row_are_made_once(monkeypatch):
    """Block columns of a part share the transforms, which are those of the whole kernel."""
    made = []
    one = alr.row_spectra
    monkeypatch.setattr(alr, "row_spectra", lambda *a: made.append(a[0]) or one(*a))
    grid = Grid(c=2.0, f=60.0, a=0.02, e=-0.02, rows=40, cols=600)
    blocks = layout(grid, SMALL, 20, 20)
    shape = blocks.rows + 2 * blocks.reach_y, blocks.cols + 2 * blocks.reach_x[1]
    fields = [np.random.default_rng(k).uniform(0, 20, shape) for k in range(5)]
    convolve = alr._rows_kernel(grid, SMALL, blocks)
    together = convolve(fields, 1)
    assert len(made) == blocks.rows
    for f, out in zip(fields, together):
        np.testing.assert_allclose(convolve([f], 1)[0], out, rtol=1e-9)
    n, reach = 64, 5
    half = one(60.0, np.array([60.1]), reach, 0.02, n, SMALL)
    kernel = np.fft.irfft(half, n, axis=1)[0]
    np.testing.assert_allclose(kernel[1 : reach + 1], kernel[: -reach - 1 : -1], atol=1e-12)


def test_stored_segments_save_an_exchange(spark, tmp_path):
    values = field(PLANE, 9)
    values[10, 20] = np.nan
    write_segments(frame(spark, values), str(tmp_path), "a", 2025, 16)
    write_segments(frame(spark, values * 2), str(tmp_path), "b", 2025, 16)
    stored = read_segments(spark, str(tmp_path), "a", 2025, 16)
    from_pixels, from_segments = compute_alr(frame(spark, values), PLANE, SMALL, 16, 16), compute_alr(stored, PLANE, SMALL, 16, 16)
    np.testing.assert_array_equal(image(from_segments, PLANE), image(from_pixels, PLANE))

    def exchanges(raster):
        # plans not run yet, so each exchange is written once
        return compute_alr(raster, PLANE, SMALL, 16, 16)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(stored) == exchanges(frame(spark, values)) - 1
    window = read_segments(spark, str(tmp_path), "a", 2025, 16, rows=(5, 7), cols=(16, 20))
    assert sorted((r.row, r.seg) for r in window.collect()) == [(5, 1), (6, 1)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "PushedFilters: [IsNotNull(row)" in plan
    assert read_segments(spark, str(tmp_path), "a", 2024, 16).count() == 0


def test_several_block_columns(spark):
    grid = Grid(c=0, f=0, a=450.0, e=-450.0, rows=30, cols=600, geographic=False, epsg=3035)
    values = field(grid, 3)
    one = image(compute_alr(frame(spark, values), grid, SMALL, 4096), grid)
    many = image(compute_alr(frame(spark, values), grid, SMALL, 25), grid)
    np.testing.assert_allclose(many, one, rtol=1e-9)
    stored = image(compute_alr(row_segments(frame(spark, values)), grid, SMALL, 25), grid)
    np.testing.assert_array_equal(stored, many)


def test_ring_sums_weigh_to_the_ratio(spark):
    values = field(PLANE, 5)
    sums = ring_sums(frame(spark, values), PLANE, SMALL, 32)
    np.testing.assert_allclose(
        image(weigh_rings(sums, SMALL), PLANE), image(compute_alr(frame(spark, values), PLANE, SMALL), PLANE), rtol=1e-9
    )


def test_linear_and_constant(spark):
    values = field(PLANE, 6) + 1.0
    one = image(compute_alr(frame(spark, values), PLANE, SMALL), PLANE)
    three = image(compute_alr(frame(spark, values * 3), PLANE, SMALL), PLANE)
    np.testing.assert_allclose(three, one * 3, rtol=1e-9)
    flat = image(compute_alr(frame(spark, np.full((60, 70), 2.0)), PLANE, SMALL), PLANE)
    assert np.nanmax(flat) - np.nanmin(flat) < 1e-12
    mean = image(compute_alr(frame(spark, np.full((60, 70), 2.0)), PLANE, AlrParams(max_km=4.5, rings=6, ring_stat="mean")), PLANE)
    assert np.nanmax(mean) < np.nanmax(flat)


def test_missing_pixels_give_nothing_and_get_nothing(spark):
    values = field(PLANE, 7)
    values[30, 30] = np.nan
    got = image(compute_alr(frame(spark, values), PLANE, SMALL), PLANE)
    assert np.isnan(got[30, 30])
    filled = np.where(np.isnan(values), 0.0, values)
    want = brute(filled, PLANE, SMALL)
    want[30, 30] = np.nan
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_each_pixel_reaches_exactly_the_blocks_that_need_it(spark):
    blocks = layout(PLANE, SMALL, 20)
    routed = route_segments(row_segments(frame(spark, field(PLANE))), PLANE, blocks)
    got = {(r.row, r.b_row) for r in routed.select("row", "b_row").distinct().collect()}
    reach = blocks.reach_y
    assert got == {(row, b) for row in range(60) for b in range(3) if b * 20 - reach <= row < b * 20 + 20 + reach}


def test_no_room_for_the_kernel_is_all_nan(spark):
    wide = AlrParams(max_km=300)
    assert np.isnan(image(compute_alr(frame(spark, field(PLANE)), PLANE, wide), PLANE)).all()


def test_blocks_without_data_are_part_of_the_result(spark):
    grid = Grid(c=0.0, f=0.0, a=450.0, e=-450.0, rows=40, cols=64, geographic=False)
    corner = spark.createDataFrame([(1, 2, 5.0)], "row int, col int, radiance double")
    out = compute_alr(corner, grid, SMALL, 8, 8)
    assert out.count() == 40 * 64 and out.filter("NOT isnan(alr)").count() <= 1


def test_registered_queries_run_over_many_blocks(spark):
    from noctule.catalog import queries as q, tables as t

    sf_dir = "/root/testdata/sf0.01"
    for grid, params, size in ((t.metric_grid(spark, sf_dir), q.ALR_QUERY, q.BLOCK_PX), (t.grid(spark, sf_dir), q.ALR_GEO_QUERY, 100 // q.GEO_BLOCK_ROWS)):
        blocks = layout(grid, params, size, q.SEGMENT_PX)
        down, across = blocks.across(grid)
        assert down >= 3 and across >= 3
    assert blocks.reach_y > 0


def test_many_rows_take_no_kernel_for_every_pair_of_them(monkeypatch):
    rng = np.random.default_rng(5)
    params = AlrParams(max_km=700.0, rings=8, noise_floor=0.5)
    grid = Grid(c=-180.0, f=60.0, a=2.4, e=-0.2, rows=600, cols=150)
    blocks = alr.layout(grid, params, 30, 16)
    for b_row in (0, 9, 19):
        fields = [rng.uniform(0, 25, (blocks.rows + 2 * blocks.reach_y, blocks.cols + 2 * blocks.reach_x[b_row])) for _ in range(2)]
        with monkeypatch.context() as m:
            m.setattr(alr, "_narrow", lambda *_: False, raising=False)
            want = alr._rows_kernel(grid, params, blocks)(fields, b_row)
        with monkeypatch.context() as m:
            m.setattr(alr, "row_spectra", lambda *_: pytest.fail("a kernel of pairs of rows"))
            got = alr._rows_kernel(grid, params, blocks)(fields, b_row)
        for g, w in zip(got, want, strict=True):
            np.testing.assert_allclose(g, w, rtol=1e-12)
