"""All-sky light pollution ratio: ring-weighted sum of radiance around every pixel.

The raster is cut into blocks. Row segments of pixels are sent to every block whose surroundings they belong
to, and each block is convolved on its own with a Fourier transform, so memory per task is fixed by the block
size and the radius, and blocks are independent of each other.

    ratio(p) = calib_c * sum over rings k of  weight(r_k) * (sum of radiance in ring k around p)
    weight(r) = r ** -(alpha_base * (r / alpha_ref_km) ** alpha_exp)

The published method leaves ring edges open; here they grow geometrically from the work resolution to the
radius, and ``ring_edges_km`` overrides them. Pixels closer to the raster edge than the radius are NaN. A grid that goes
once around the globe has no edge to the west and east: segments also go to blocks on the other side of its seam.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData, functions as F

from noctule import constants as K
from noctule.model import Grid
from noctule.operators.proximity import KM_PER_DEG

SEGMENT_PX = 256
# Working arrays of the block columns that a task on a latitude/longitude grid convolves with the same kernels.
PART_BYTES = 256 << 20


@dataclass(frozen=True)
class AlrParams:
    work_resolution_m: float = K.ALR_WORK_RESOLUTION_M
    rings: int = K.ALR_RINGS
    max_km: float = K.ALR_MAX_KM
    alpha_base: float = K.ALR_ALPHA_BASE
    alpha_exp: float = K.ALR_ALPHA_EXP
    calib_c: float = K.ALR_CALIB_C
    noise_floor: float = K.ALR_NOISE_FLOOR
    alpha_ref_km: float = 350.0
    ring_edges_km: tuple[float, ...] | None = None
    ring_stat: str = "sum"

    def edges(self) -> np.ndarray:
        """Outer edge of every ring; a distance belongs to the first ring whose edge it does not exceed."""
        if self.ring_edges_km is not None:
            return np.asarray(self.ring_edges_km, dtype=float)
        first = self.work_resolution_m / 1000.0
        outer = first * (self.max_km / first) ** (np.arange(self.rings) / max(self.rings - 1, 1))
        outer[-1] = self.max_km
        return outer

    def weights(self) -> np.ndarray:
        outer = self.edges()
        mid = (np.concatenate([[0.0], outer[:-1]]) + outer) / 2.0
        return mid ** -(self.alpha_base * (mid / self.alpha_ref_km) ** self.alpha_exp)


@dataclass(frozen=True)
class Blocks:
    """Block layout: block size, the reach in pixels of each block row, and the width of row segments."""

    rows: int
    cols: int
    reach_y: int
    reach_x: tuple[int, ...]  # per block row
    segment: int = SEGMENT_PX
    around: int = 0  # columns of a full circle, else 0

    @property
    def per_part(self) -> int:
        """Block columns that one task handles together, on a latitude/longitude grid."""
        # the field, its transform and a copy of both
        widest = 32 * (self.rows + 2 * self.reach_y) * (self.cols + 2 * max(self.reach_x))
        return max(1, PART_BYTES // widest)

    def across(self, grid: Grid) -> tuple[int, int]:
        """Numbers of block rows and block columns."""
        return -(-grid.rows // self.rows), -(-grid.cols // self.cols)


def layout(grid: Grid, params: AlrParams, block_px: int, segment_px: int = SEGMENT_PX) -> Blocks:
    size_y, size_x = min(block_px, grid.rows), min(block_px, grid.cols)
    size_x = -(-size_x // segment_px) * segment_px
    n_rows = -(-grid.rows // size_y)
    if not grid.geographic:
        reach_x = int(params.max_km * 1000 / abs(grid.a) + 1e-9)
        return Blocks(size_y, size_x, int(params.max_km * 1000 / abs(grid.e) + 1e-9), (reach_x,) * n_rows, segment_px)
    lats = grid.f + grid.e * (np.arange(grid.rows) + 0.5)
    px = _half_width_px(lats, grid, params)
    reach_x = tuple(int(px[b * size_y : (b + 1) * size_y].max()) for b in range(n_rows))
    around = grid.cols if grid.full_circle else 0
    if around and 2 * max(reach_x) + 1 > around:
        raise ValueError("the radius reaches around the globe")
    return Blocks(size_y, size_x, int(params.max_km / (abs(grid.e) * KM_PER_DEG) + 1e-9), reach_x, segment_px, around)


def _half_width_px(lats: np.ndarray, grid: Grid, params: AlrParams) -> np.ndarray:
    """Pixels along a row that the circle around its centre can cover."""
    ratio = math.sin(params.max_km / K.EARTH_RADIUS_KM) / np.cos(np.radians(lats))
    if (np.abs(lats) + params.max_km / KM_PER_DEG >= 90).any():
        raise ValueError("rows within the radius of a pole need a projected grid")
    return np.floor(np.degrees(np.arcsin(ratio)) / abs(grid.a) + 1e-9).astype(int)


def row_segments(pixels: DataFrame, segment_px: int = SEGMENT_PX) -> DataFrame:
    """Pixels packed as (row, seg, cols, vals), which takes half the bytes of single rows in a shuffle.

    Pixels without data are left out. A raster stored in this form (``sources.rasters.write_segments``) skips the
    shuffle made here.
    """
    data = pixels.filter(F.col("radiance").isNotNull() & ~F.isnan("radiance"))
    return (
        data.groupBy("row", F.floor(F.col("col") / segment_px).cast("int").alias("seg"))
        .agg(F.collect_list(F.struct("col", F.col("radiance").cast("double").alias("val"))).alias("px"))
        .select("row", "seg", F.col("px.col").alias("cols"), F.col("px.val").alias("vals"))
    )


def _routed(raster: DataFrame, grid: Grid, blocks: Blocks, every: bool = False, per_part: int = 1) -> GroupedData:
    """Segments by block row and part of ``per_part`` block columns; with ``every`` also blocks that no segment reaches."""
    segments = raster if "vals" in raster.columns else row_segments(raster, blocks.segment)
    routed = route_segments(segments, grid, blocks)
    if every:
        n_rows, n_cols = blocks.across(grid)
        number = F.col("id")
        there = raster.sparkSession.range(n_rows * n_cols).select(
            F.lit(0).alias("row"), F.lit(0).alias("seg"), F.array().cast("array<int>").alias("cols"), F.array().cast("array<double>").alias("vals"),
            F.floor(number / n_cols).cast("int").alias("b_row"), (number % n_cols).cast("int").alias("b_col"), F.lit(0).alias("shift"),
        )
        routed = routed.unionByName(there)
    return routed.groupBy("b_row", F.floor(F.col("b_col") / per_part).cast("int").alias("part"))


def route_segments(segments: DataFrame, grid: Grid, blocks: Blocks) -> DataFrame:
    """Repeat each segment for every block (b_row, b_col) that needs it; ``shift`` is added to its columns there."""
    last_row, last_col = (n - 1 for n in blocks.across(grid))

    def span(first, last, size: int, top: int):
        low = F.greatest(F.floor(first / size), F.lit(0)).cast("int")
        high = F.least(F.floor(last / size), F.lit(top)).cast("int")
        return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    down = segments.withColumn(
        "b_row", F.explode(span(F.col("row") - blocks.reach_y, F.col("row") + blocks.reach_y, blocks.rows, last_row))
    )
    if len(set(blocks.reach_x)) == 1:
        reach = F.lit(blocks.reach_x[0])
    else:
        reach = F.get(F.lit(list(blocks.reach_x)), F.col("b_row"))
    # on a full circle a segment also stands one turn further west and east
    down = down.withColumn("shift", F.explode(F.array(*[F.lit(k * blocks.around) for k in ((-1, 0, 1) if blocks.around else (0,))])))
    start = F.col("seg") * blocks.segment + F.col("shift")
    return down.withColumn("b_col", F.explode(span(start - reach, start + blocks.segment - 1 + reach, blocks.cols, last_col)))


def compute_alr(
    pixels: DataFrame, grid: Grid, params: AlrParams = AlrParams(), block_px: int = 2048, segment_px: int = SEGMENT_PX
) -> DataFrame:
    """(row, col, alr) for every pixel of the grid from (row, col, radiance) or from row segments of ``segment_px``.

    On a projected grid one two-dimensional transform per block is enough. On a latitude/longitude grid pixel
    widths change from row to row, so rows are convolved pair by pair, with pixels weighted by their area. Where the
    radius covers many rows and few columns, sums of stretches of rows give the same in less.
    """
    blocks = layout(grid, params, block_px, segment_px)
    convolve, per_part = (_rows_kernel(grid, params, blocks), blocks.per_part) if grid.geographic else (_plane_kernel(grid, params, blocks), 1)

    def part(key: tuple, segments: pa.Table) -> pa.Table:
        b_row = key[0].as_py()
        columns = pa.compute.unique(segments["b_col"]).to_pylist()
        # a part of one block column needs no cutting
        own = {b: segments.filter(pa.compute.equal(segments["b_col"], b)) for b in columns} if len(columns) > 1 else {columns[0]: segments}
        padded = [_padded(own[b], b_row, b, blocks, params.noise_floor) for b in columns]
        filled = [k for k, (_, known) in enumerate(padded) if known.any()]
        ratios = dict(zip(filled, convolve([padded[k][0] for k in filled], b_row) if filled else [], strict=True))
        parts = []
        for k, (b_col, (_, known)) in enumerate(zip(columns, padded)):
            out = ratios[k] * params.calib_c if k in ratios else np.empty(known.shape)
            out[~known] = np.nan
            parts.append(_emit(_mask_edge(out, b_row, b_col, grid, params, blocks), b_row, b_col, grid, blocks))
        return pa.concat_tables(parts)

    return _routed(pixels, grid, blocks, True, per_part).applyInArrow(part, "row int, col int, alr double")


def ring_sums(
    pixels: DataFrame, grid: Grid, params: AlrParams = AlrParams(), block_px: int = 1024, segment_px: int = SEGMENT_PX
) -> DataFrame:
    """(row, col, ring, ring_sum) of a projected grid: the sums before weighting, for pixels off the edge."""
    if grid.geographic:
        raise ValueError("ring sums are defined on a projected grid")
    blocks = layout(grid, params, block_px, segment_px)
    ring = _ring_index(grid, params, blocks)

    def block(key: tuple, segments: pa.Table) -> pa.Table:
        b_row, b_col = key[0].as_py(), key[1].as_py()
        field, known = _padded(segments, b_row, b_col, blocks, params.noise_floor)
        parts = []
        for k in range(params.edges().size):
            if not (ring == k).any():
                continue
            out = _fft_valid(field, (ring == k).astype(float))
            out[~known] = np.nan
            part = _emit(_mask_edge(out, b_row, b_col, grid, params, blocks), b_row, b_col, grid, blocks)
            part = part.filter(pa.compute.invert(pa.compute.is_nan(part["alr"])))
            parts.append(
                pa.table({"row": part["row"], "col": part["col"], "ring": pa.array(np.full(len(part), k, "int32")), "ring_sum": part["alr"]})
            )
        return pa.concat_tables(parts)

    return _routed(pixels, grid, blocks).applyInArrow(block, "row int, col int, ring int, ring_sum double")


def weigh_rings(sums: DataFrame, params: AlrParams = AlrParams()) -> DataFrame:
    """(row, col, alr) from ring sums, as a plain aggregate."""
    weight = F.get(F.lit([float(w) for w in params.weights()]), F.col("ring"))
    return sums.groupBy("row", "col").agg((F.sum(F.col("ring_sum") * weight) * params.calib_c).alias("alr"))


# --- inside one block ---------------------------------------------------------------------------


def _padded(
    segments: pa.Table, b_row: int, b_col: int, blocks: Blocks, noise_floor: float
) -> tuple[np.ndarray, np.ndarray]:
    """Radiance of the block with its surroundings, and which block pixels are known.

    Unknown pixels and radiance under the noise floor count as 0.
    """
    ry, rx = blocks.reach_y, blocks.reach_x[b_row]
    field = np.full((blocks.rows + 2 * ry, blocks.cols + 2 * rx), np.nan)
    vals = segments["vals"].combine_chunks()
    lengths = np.diff(vals.offsets.to_numpy())
    rows = np.repeat(segments["row"].to_numpy(), lengths) - (b_row * blocks.rows - ry)
    cols = segments["cols"].combine_chunks().flatten().to_numpy() - (b_col * blocks.cols - rx)
    cols = cols + np.repeat(segments["shift"].to_numpy(), lengths)
    inside = (cols >= 0) & (cols < field.shape[1])
    field[rows[inside], cols[inside]] = vals.flatten().to_numpy()[inside]
    known = ~np.isnan(field[ry : ry + blocks.rows, rx : rx + blocks.cols])
    field[np.isnan(field) | (field < noise_floor)] = 0.0
    return field, known


def _ring_index(grid: Grid, params: AlrParams, blocks: Blocks) -> np.ndarray:
    """Ring of every kernel pixel, -1 outside the radius."""
    dy = np.arange(-blocks.reach_y, blocks.reach_y + 1) * abs(grid.e) / 1000.0
    dx = np.arange(-blocks.reach_x[0], blocks.reach_x[0] + 1) * abs(grid.a) / 1000.0
    km = np.sqrt(dy[:, None] ** 2 + dx[None, :] ** 2)
    return _ring_of(km, params)


def _ring_of(km: np.ndarray, params: AlrParams) -> np.ndarray:
    outer = params.edges()
    ring = np.searchsorted(outer, km, side="left")
    return np.where(ring >= outer.size, -1, ring)


def _good_size(n: int) -> int:
    """Least number >= n with no prime factor above 5, a fast transform length."""
    while True:
        m = n
        for p in (2, 3, 5):
            while m % p == 0:
                m //= p
        if m == 1:
            return n
        n += 1


def _fft_valid(field: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Sum of field x kernel around every pixel whose whole surroundings are in ``field``; the kernel is symmetric."""
    shape = [_good_size(s) for s in field.shape]
    full = np.fft.irfft2(np.fft.rfft2(field, shape) * np.fft.rfft2(kernel, shape), shape)
    ky, kx = kernel.shape
    return full[ky - 1 : field.shape[0], kx - 1 : field.shape[1]]


Convolve = Callable[[list[np.ndarray], int], list[np.ndarray]]


def _plane_kernel(grid: Grid, params: AlrParams, blocks: Blocks) -> Convolve:
    def convolve(fields: list[np.ndarray], b_row: int) -> list[np.ndarray]:
        ring = _ring_index(grid, params, blocks)
        weights = params.weights()
        if params.ring_stat == "mean":
            weights = weights / np.maximum(np.bincount(ring[ring >= 0], minlength=weights.size), 1)
        return [_fft_valid(field, np.where(ring >= 0, weights[ring], 0.0)) for field in fields]

    return convolve


def row_spectra(here: float, there: np.ndarray, reach: int, step_deg: float, n: int, params: AlrParams) -> np.ndarray:
    """Transforms of length ``n`` of the weights that pixels of the rows ``there`` have for a pixel of the row ``here``.

    Weights are the same to the west and east, so half of them is computed, and with the pixel at place 0 the transform
    is real.
    """
    dx = np.sin(np.radians(np.arange(reach + 1) * step_deg) / 2) ** 2
    here, there = np.radians(here), np.radians(there)
    chord = np.sin((there - here) / 2)[:, None] ** 2 + (np.cos(here) * np.cos(there))[:, None] * dx
    ring = _ring_of(2 * K.EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(chord, 1.0))), params)
    east = np.where(ring >= 0, params.weights()[ring], 0.0)
    kernel = np.zeros((len(there), n))
    kernel[:, : reach + 1] = east
    kernel[:, n - reach :] = east[:, :0:-1]
    return np.fft.rfft(kernel, axis=1).real


def reach_rows(here: np.ndarray, lat: np.ndarray, reach: int, step_deg: float, params: AlrParams) -> tuple[np.ndarray, np.ndarray]:
    """First row and the one after the last of ``lat`` within every outer ring edge, by row of ``here``, pixels to the side and ring.

    Rows of ``lat`` go evenly from north to south or back. Along a meridian the distance falls up to its least and rises
    from there, so these rows are one stretch, whose ends are found by bisection of the distance as ``row_spectra`` has it.
    """
    dx = (np.arange(reach + 1) * step_deg)[None, :, None]
    outer, phi = params.edges(), np.radians(here)[:, None, None]
    side, rows = np.sin(np.radians(dx) / 2) ** 2, np.radians(lat)

    def within(row: np.ndarray) -> np.ndarray:
        there = rows[np.clip(row, 0, lat.size - 1)]
        chord = np.sin((there - phi) / 2) ** 2 + (np.cos(phi) * np.cos(there)) * side
        km = 2 * K.EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))
        return (km <= outer) & (row >= 0) & (row < lat.size)

    least = np.degrees(np.arctan2(np.sin(phi), np.cos(phi) * np.cos(np.radians(dx))))
    at = np.floor((least - lat[0]) / (lat[1] - lat[0]) if lat.size > 1 else least * 0).astype(np.int64)
    at = np.broadcast_to(at, (here.size, reach + 1, outer.size))
    at = np.clip(np.where(within(at), at, at + 1), 0, lat.size - 1)
    any_ = within(at)

    def end(out: int) -> np.ndarray:
        """The first row off the stretch towards ``out``."""
        good, bad = at.copy(), np.full_like(at, out)
        while (open_ := np.abs(bad - good) > 1).any():
            mid = (good + bad) // 2
            good, bad = np.where(open_ & (ok := within(mid)), mid, good), np.where(open_ & ~ok, mid, bad)
        return bad

    first = end(-1) + 1
    return np.where(any_, first, 0), np.where(any_, end(lat.size), 0)


# Ends of stretches that are looked up together.
STRETCHES = 1 << 17


def _narrow(blocks: Blocks, params: AlrParams) -> bool:
    """Few pixels to the side and many rows: sums of stretches of rows take less than a transform for every pair of rows."""
    return params.edges().size * (max(blocks.reach_x) + 1) <= 2 * blocks.reach_y + 1


def _stretch_kernel(grid: Grid, params: AlrParams, blocks: Blocks) -> Convolve:
    """The sums of ``_rows_kernel`` from running sums down every column.

    What lies within a ring's outer edge and so many pixels to the side is one stretch of rows, the difference of two
    running sums. The work is pixels times pixels to the side times rings, whatever the number of rows in the radius.
    """
    weights = params.weights()
    # weight of all within an edge, so that what lies in a ring gets the ring's weight from the edges around it
    steps = weights - np.append(weights[1:], 0.0)

    def convolve(fields: list[np.ndarray], b_row: int) -> list[np.ndarray]:
        ry, rx = blocks.reach_y, blocks.reach_x[b_row]
        lat = grid.f + grid.e * (np.arange(fields[0].shape[0]) + b_row * blocks.rows - ry + 0.5)
        area = np.cos(np.radians(lat)) * abs(grid.a * grid.e) * (KM_PER_DEG * 1000.0 / params.work_resolution_m) ** 2
        out = [np.zeros((blocks.rows, blocks.cols)) for _ in fields]
        # running sums hold many rows, so they get more digits than the pixels
        sums = [np.vstack([np.zeros((1, f.shape[1]), np.longdouble), np.cumsum(f * area[:, None], axis=0, dtype=np.longdouble)]) for f in fields]
        at_once = max(1, STRETCHES // (steps.size * (rx + 1)))
        for at in range(0, blocks.rows, at_once):
            rows = slice(at, min(at + at_once, blocks.rows))
            first, end = reach_rows(lat[ry:][rows], lat, rx, grid.a, params)
            # ring edges beyond the radius end there
            own = np.arange(rows.start, rows.stop)[:, None, None]
            first = np.maximum(first, own)
            end = np.maximum(np.minimum(end, own + 2 * ry + 1), first)
            for k in range(rx + 1):
                some = [n for n in range(steps.size) if (first[:, k, n] < end[:, k, n]).any()]
                for total, to in zip(sums, out):
                    for side in {rx - k, rx + k}:
                        columns = total[:, side : side + blocks.cols]
                        for n in some:
                            to[rows] += (columns[end[:, k, n]] - columns[first[:, k, n]]).astype(float) * steps[n]
        return out

    return convolve


def _rows_kernel(grid: Grid, params: AlrParams, blocks: Blocks) -> Convolve:
    if params.ring_stat != "sum":
        raise ValueError("ring means need a projected grid")
    if _narrow(blocks, params):
        return _stretch_kernel(grid, params, blocks)

    def convolve(fields: list[np.ndarray], b_row: int) -> list[np.ndarray]:
        ry, rx = blocks.reach_y, blocks.reach_x[b_row]
        lat = grid.f + grid.e * (np.arange(fields[0].shape[0]) + b_row * blocks.rows - ry + 0.5)
        area = np.cos(np.radians(lat)) * abs(grid.a * grid.e) * (KM_PER_DEG * 1000.0 / params.work_resolution_m) ** 2
        # what wraps around the end of the transform ends up in the surroundings, which are cut off
        n = _good_size(fields[0].shape[1])
        spectra = np.stack([np.fft.rfft(field * area[:, None], n, axis=1) for field in fields])
        out = np.empty((len(fields), blocks.rows, blocks.cols))
        for i in range(blocks.rows):
            near = slice(i, i + 2 * ry + 1)
            # one set of transforms for all block columns
            kernel = row_spectra(lat[i + ry], lat[near], rx, grid.a, n, params)
            lines = np.fft.irfft(np.einsum("bhf,hf->bf", spectra[:, near], kernel), n, axis=1)
            out[:, i] = lines[:, rx : rx + blocks.cols]
        return list(out)

    return convolve


def _mask_edge(out: np.ndarray, b_row: int, b_col: int, grid: Grid, params: AlrParams, blocks: Blocks) -> np.ndarray:
    """NaN where the kernel would leave the raster."""
    rows = np.arange(blocks.rows) + b_row * blocks.rows
    cols = np.arange(blocks.cols) + b_col * blocks.cols
    if grid.geographic:
        reach = _half_width_px(grid.f + grid.e * (np.minimum(rows, grid.rows - 1) + 0.5), grid, params)
    else:
        reach = np.full(blocks.rows, blocks.reach_x[b_row])
    keep_row = (rows >= blocks.reach_y) & (rows < grid.rows - blocks.reach_y)
    keep_col = (cols[None, :] >= reach[:, None]) & (cols[None, :] < grid.cols - reach[:, None]) | bool(blocks.around)
    out[~(keep_row[:, None] & keep_col)] = np.nan
    return out


def _emit(out: np.ndarray, b_row: int, b_col: int, grid: Grid, blocks: Blocks) -> pa.Table:
    row0, col0 = b_row * blocks.rows, b_col * blocks.cols
    out = out[: grid.rows - row0, : grid.cols - col0]
    rows, cols = np.indices(out.shape, dtype="int32")
    return pa.table({"row": (rows + np.int32(row0)).ravel(), "col": (cols + np.int32(col0)).ravel(), "alr": out.ravel()})
