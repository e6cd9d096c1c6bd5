"""Pixel-table operators: scores, mesh selection, point sampling and the debug export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from noctule.functions.sky import alr_to_bortle, alr_to_darkness
from noctule.model import Grid
from noctule.runtime import broadcast_if_small

# alr_to_darkness yields multiples of 2^-53 in [0, 1]: 54 bits. The 9 bits left of a BIGINT number the cell's pixels.
UNIT_STEPS = float(2**53)
PACKED_CELL_PIXELS = 2**9


def score_pixels(pixels: DataFrame) -> DataFrame:
    """Add darkness and Bortle class to pixels that carry ``alr``."""
    return pixels.withColumns({"darkness": alr_to_darkness(F.col("alr")), "bortle": alr_to_bortle(F.col("alr"))})


def mesh_minima(
    scored: DataFrame, grid: Grid, mesh_km: float = 5, pick: str = "min", unit_darkness: bool = False
) -> DataFrame:
    """One candidate site per mesh cell: the pixel of least ``darkness``.

    Darkness is 1 at the darkest, so ``pick="min"`` returns the *brightest* pixel of a cell. That is what
    published releases contain, hence the default; ``pick="max"`` returns the darkest. Ties take the first
    pixel in row-major order. NaN pixels are skipped and a cell without any other pixel has no candidate.
    ``cand_ord`` numbers candidates in scan order of the cells.

    The group-by aggregates on the map side, so only one row per cell and task is shuffled. With
    ``unit_darkness`` (values straight from ``alr_to_darkness``) darkness and pixel number are packed in one
    BIGINT: all buffers are then primitive and Spark uses a hash aggregate without a sort.
    """
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    px_y, px_x = grid.mesh_cell_px(mesh_km)
    cell_cols = -(-grid.cols // px_x)
    cell_row, cell_col = F.floor(F.col("row") / px_y), F.floor(F.col("col") / px_x)
    cells = scored.select(
        (cell_row * F.lit(cell_cols).cast("bigint") + cell_col).alias("cand_ord"), "row", "col", "darkness", "bortle"
    )
    if unit_darkness and px_y * px_x <= PACKED_CELL_PIXELS:
        best = _packed_best(cells, px_y, px_x, cell_cols, pick)
    else:
        rank = F.col("darkness") if pick == "min" else -F.col("darkness")
        best = (
            cells.filter(F.col("darkness").isNotNull() & ~F.isnan("darkness"))
            .groupBy("cand_ord")
            .agg(F.min(F.struct(rank.alias("rank"), "row", "col", "darkness", "bortle")).alias("b"))
            .select("cand_ord", "b.row", "b.col", "b.darkness", "b.bortle")
        )
    return best.select(
        "cand_ord",
        grid.lat_of(F.col("row")).alias("lat"),
        grid.lon_of(F.col("col")).alias("lon"),
        "darkness",
        F.col("row").cast("int").alias("row"),
        F.col("col").cast("int").alias("col"),
        F.col("bortle").cast("int").alias("bortle"),
    )


def _packed_best(cells: DataFrame, px_y: int, px_x: int, cell_cols: int, pick: str) -> DataFrame:
    steps = F.col("darkness") * F.lit(UNIT_STEPS)
    exact = (F.col("darkness") >= 0) & (F.col("darkness") <= 1) & (steps == F.floor(steps).cast("double"))
    wrong = F.raise_error(F.lit("unit_darkness needs values computed by alr_to_darkness")).cast("bigint")
    # NULL for no data: min and min_by skip it, and the score is evaluated once instead of again in a filter
    no_data = F.col("darkness").isNull() | F.isnan("darkness")
    whole = F.when(no_data, F.lit(None).cast("bigint")).when(exact, steps.cast("bigint")).otherwise(wrong)
    level = whole if pick == "min" else F.lit(int(UNIT_STEPS)).cast("bigint") - whole
    pixel = (F.col("row") % px_y) * px_x + F.col("col") % px_x
    packed = cells.select("cand_ord", "bortle", (level * PACKED_CELL_PIXELS + pixel).alias("packed"))
    best = packed.groupBy("cand_ord").agg(F.min("packed").alias("packed"), F.min_by("bortle", "packed").alias("bortle"))
    best = best.filter(F.col("packed").isNotNull())
    pixel = F.pmod("packed", F.lit(PACKED_CELL_PIXELS).cast("bigint"))
    level = F.shiftright("packed", 9)
    whole = level if pick == "min" else F.lit(int(UNIT_STEPS)).cast("bigint") - level
    return best.select(
        "cand_ord",
        (F.floor(F.col("cand_ord") / cell_cols) * px_y + F.floor(pixel / px_x)).alias("row"),
        (F.col("cand_ord") % cell_cols * px_x + pixel % px_x).alias("col"),
        (whole.cast("double") / F.lit(UNIT_STEPS)).alias("darkness"),
        "bortle",
    )


def sample_at(points: DataFrame, scored: DataFrame, grid: Grid) -> DataFrame:
    """Attach the darkness and Bortle class of the pixel under each (lat, lon) point.

    Points off the grid, or on a missing pixel, keep NaN darkness and class 9. The different pixels asked for are
    counted, and broadcast past the raster if they are few.
    """
    usable = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon")
    keyed = points.withColumns(
        {
            "row": F.when(usable, grid.row_at(F.col("lat"))),
            "col": F.when(usable, grid.col_at(F.col("lon"))),
        }
    )
    keys = keyed.select("row", "col").distinct()
    keys = broadcast_if_small(keys, keys.count())
    hits = scored.select("row", "col", "darkness", "bortle").join(keys, ["row", "col"])
    return keyed.join(hits, ["row", "col"], "left").withColumns(
        {
            "darkness": F.coalesce("darkness", F.lit(float("nan"))),
            "bortle": F.coalesce("bortle", F.lit(9)).cast("int"),
        }
    )


def debug_raster(scored: DataFrame) -> DataFrame:
    """Darkness and Bortle class of every pixel as 32-bit floats."""
    return scored.select(
        "row", "col", F.col("darkness").cast("float").alias("darkness"), F.col("bortle").cast("float").alias("bortle")
    )


def bortle_histogram(scored: DataFrame) -> DataFrame:
    return scored.groupBy("bortle").agg(F.count(F.lit(1)).alias("pixels"))
