"""Distance joins over a grid of cells.

Cells have one height in degrees; every latitude band has its own number of cells around the globe, so cells
stay about square up to the poles and wrap at the antimeridian. A *query* row is repeated for the few cells
its radius can touch, a *point* row lies in one cell, and the join is an equi-join on the cell followed by
the exact distance.

A cell with very many points (``hot``) is never paired row by row. It is split 4 x 4, again and again, into
sub-cells that carry a row count and a bounding radius. A query then takes a sub-cell whole, drops it, or
looks one level deeper, so the work per query depends on geometry and not on how many points share a cell.
A cell crowded with queries is dealt into salts (``crowd_join``).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from noctule import constants as K
from noctule.functions.geo import haversine_km
from noctule.runtime import broadcast_if_small, materialize

KM_PER_DEG = math.pi * K.EARTH_RADIUS_KM / 180.0
# below the true 111.19 km so that a cell is always wider than the radius it was made for
CELL_KM_PER_DEG = 111.0
BAND_SHIFT = 1 << 24
HOT_CELL_ROWS = 2_000
CROWD_QUERIES = 50_000
MAX_DEPTH = 12
FANOUT = 4
SLACK_KM = 1e-6
HALF_GLOBE_KM = 20_020.0
# Points that one of them may see in its cell, on average, before a search for the nearest starts with a smaller radius.
DENSE_ROWS = 16
MAX_STEPS = 4
SUB_CELL = ("cell", "vy", "ux")


def cell_deg(radius_km: float) -> float:
    return min(radius_km / CELL_KM_PER_DEG, 60.0)


def _band_cells(band: Column, deg: float) -> Column:
    """Number of cells around the globe in a latitude band."""
    edge = F.greatest(F.abs(band * F.lit(deg)), F.abs((band + 1) * F.lit(deg)))
    return F.greatest(
        F.floor(F.lit(360.0 / deg) * F.cos(F.radians(F.least(edge, F.lit(90.0))))), F.lit(1).cast("bigint")
    )


def _cell_key(band: Column, col: Column) -> Column:
    return band * F.lit(BAND_SHIFT) + col


def with_cell(points: DataFrame, deg: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add the one ``cell`` a point lies in."""
    band = F.floor(F.col(lat) / F.lit(deg))
    return points.withColumn("cell", _cell_key(band, _col_at(F.col(lon), _band_cells(band, deg))))


def _col_at(lon: Column, n: Column) -> Column:
    return F.pmod(F.floor((lon + F.lit(180.0)) * n / F.lit(360.0)), n)


def _reach_deg(radius_km: float) -> float:
    return math.degrees((radius_km + SLACK_KM) / K.EARTH_RADIUS_KM)


def half_width(lat: Column, radius_km: float) -> Column:
    """Degrees of longitude that the circle around a point at ``lat`` can cover to either side."""
    ang_deg = _reach_deg(radius_km)
    sine = math.sin(math.radians(min(ang_deg, 90.0)))
    return F.when(F.abs(lat) + F.lit(ang_deg + 1e-9) >= 90, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(sine) / F.cos(F.radians(lat)), F.lit(1.0)))) + F.lit(1e-9)
    )


def with_reach(queries: DataFrame, radius_km: float, deg: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Repeat each query for every ``cell`` that can hold a point within ``radius_km``.

    ``half`` is kept: the half width in longitude of the query's circle.
    """
    ang_deg = _reach_deg(radius_km)
    la, lo = F.col(lat), F.col(lon)
    bands = F.sequence(F.floor((la - F.lit(ang_deg)) / F.lit(deg)), F.floor((la + F.lit(ang_deg)) / F.lit(deg)))
    banded = queries.withColumns({"half": half_width(la, radius_km), "_band": F.explode(bands)})
    n = _band_cells(F.col("_band"), deg)
    first = F.floor((lo - F.col("half") + F.lit(180.0)) * n / F.lit(360.0))
    last = F.floor((lo + F.col("half") + F.lit(180.0)) * n / F.lit(360.0))
    all_round = last - first + 1 >= n
    cols = F.sequence(F.when(all_round, F.lit(0).cast("bigint")).otherwise(first), F.when(all_round, n - 1).otherwise(last))
    spread = banded.withColumn("_col", F.explode(cols))
    return spread.withColumn("cell", _cell_key(F.col("_band"), F.pmod(F.col("_col"), n))).drop("_band", "_col")


def _prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ("cell",)) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def crowd_join(
    queries: DataFrame, points: DataFrame, keys: tuple[str, ...], crowd: int = CROWD_QUERIES, base: DataFrame | None = None
) -> DataFrame:
    """Equi-join for a query side of which a large share may have one key; points have a bounded number per key.

    The queries of a crowded key are dealt into salts of about ``crowd`` rows by a hash of their columns, and the
    key's few points are repeated per salt, so no task gets the whole key. ``base`` are the rows that ``queries`` were made
    from with no key twice for a row: if they are few, no key is crowded.
    """
    if (queries if base is None else base).limit(crowd + 1).count() <= crowd:
        return queries.join(points, list(keys))
    sizes = queries.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
    sizes = materialize(sizes.select(*keys, F.ceil(F.col("n") / crowd).cast("int").alias("_salts")), "salts")
    n_crowded = sizes.count()
    if not n_crowded:
        return queries.join(points, list(keys))
    sizes = broadcast_if_small(sizes, n_crowded)
    dealt = F.pmod(F.xxhash64(*queries.columns), F.coalesce("_salts", F.lit(1)).cast("bigint")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    q = queries.join(sizes, list(keys), "left").withColumn("_salt", dealt).drop("_salts")
    p = points.join(sizes, list(keys), "left").withColumn("_salt", every).drop("_salts")
    return q.join(p, [*keys, "_salt"]).drop("_salt")


def range_pairs(
    queries: DataFrame,
    points: DataFrame,
    radius_km: float,
    keys: tuple[str, ...] = (),
    inclusive: bool = True,
    crowd: int = CROWD_QUERIES,
) -> DataFrame:
    """Rows ``q_*, p_*, km`` of each query and each point within the radius, with equal (or both null) ``keys``."""
    deg = cell_deg(radius_km)
    q = _prefixed(with_reach(queries, radius_km, deg), "q_")
    p = _prefixed(with_cell(points, deg), "p_")
    # keys go into the equi-join, null as a value of its own
    same = [f"_same_{k}" for k in keys]
    for name, k in zip(same, keys):
        q = q.withColumn(name, F.struct(F.col("q_" + k).isNull(), F.coalesce(F.col("q_" + k).cast("string"), F.lit(""))))
        p = p.withColumn(name, F.struct(F.col("p_" + k).isNull(), F.coalesce(F.col("p_" + k).cast("string"), F.lit(""))))
    # plain comparisons first: more than half of the pairs need no trigonometry
    dlon = F.abs(F.col("p_lon") - F.col("q_lon"))
    boxed = F.abs(F.col("p_lat") - F.col("q_lat")) <= _reach_deg(radius_km)
    boxed = boxed & (F.least(dlon, F.lit(360.0) - dlon) <= F.col("q_half"))
    km = haversine_km(F.col("q_lat"), F.col("q_lon"), F.col("p_lat"), F.col("p_lon"))
    pairs = crowd_join(q, p, ("cell", *same), crowd, queries).filter(boxed).drop("cell", "q_half", *same).withColumn("km", km)
    return pairs.filter(F.col("km") <= radius_km if inclusive else F.col("km") < radius_km)


# --- split of hot cells -------------------------------------------------------------------------


def _sub_index(points: DataFrame, deg: float) -> DataFrame:
    """``cell`` plus the position inside it, both axes in [0, 1)."""
    band = F.floor(F.col("lat") / F.lit(deg))
    n = _band_cells(band, deg)
    x = (F.col("lon") + F.lit(180.0)) * n / F.lit(360.0)
    return points.withColumns(
        {
            "cell": _cell_key(band, F.pmod(F.floor(x), n)),
            "_v": F.col("lat") / F.lit(deg) - band,
            "_u": x - F.floor(x),
        }
    )


def _at_level(level: int) -> list[Column]:
    side = float(FANOUT**level)
    return [F.floor(F.col("_v") * side).alias("vy"), F.floor(F.col("_u") * side).alias("ux")]


def _centre(level: int, deg: float) -> tuple[Column, Column]:
    """Middle of a sub-cell from its keys."""
    side = float(FANOUT**level)
    band = F.floor(F.col("cell") / F.lit(BAND_SHIFT))
    n = _band_cells(band, deg)
    lat = (band + (F.col("vy") + F.lit(0.5)) / side) * F.lit(deg)
    lon = (F.pmod(F.col("cell"), F.lit(BAND_SHIFT)) + (F.col("ux") + F.lit(0.5)) / side) * F.lit(360.0) / n - 180.0
    return F.greatest(F.least(lat, F.lit(90.0)), F.lit(-90.0)), lon


class CellTree:
    """Nested cells over points, refined only below hot cells."""

    def __init__(self, points: DataFrame, deg: float, hot_rows: int = HOT_CELL_ROWS):
        self.deg, self.hot_rows = deg, hot_rows
        self.levels: list[DataFrame] = []
        self.hot_members: list[DataFrame] = []
        leaves: list[DataFrame] = []
        rest = _sub_index(points, deg)
        for level in range(MAX_DEPTH + 1):
            keyed = rest.select("*", *_at_level(level))
            clat, clon = _centre(level, deg)
            spread = F.max(haversine_km(F.col("lat"), F.col("lon"), clat, clon)) + SLACK_KM
            cells = materialize(keyed.groupBy(*SUB_CELL).agg(F.count(F.lit(1)).alias("n"), spread.alias("rad")), "cells")
            self.levels.append(cells)
            hot = cells.filter(F.col("n") > hot_rows).select(*SUB_CELL)
            n_hot = hot.count() if level < MAX_DEPTH else 0
            members = keyed.withColumn("level", F.lit(level))
            if not n_hot:
                leaves.append(members.drop("_v", "_u"))
                break
            # hot cells number at most rows / hot_rows, so the crowded keys themselves are not shuffled
            hot = broadcast_if_small(hot, n_hot)
            leaves.append(members.join(hot, list(SUB_CELL), "left_anti").drop("_v", "_u"))
            crowded = materialize(keyed.join(hot, list(SUB_CELL), "left_semi"), "crowded")
            self.hot_members.append(crowded)
            rest = crowded.drop("vy", "ux")
        self.leaves = reduce(DataFrame.unionByName, leaves)

    def bounds(self, frontier: DataFrame, level: int) -> DataFrame:
        """Least and greatest possible distance from each query to the sub-cell it faces."""
        clat, clon = _centre(level, self.deg)
        km = haversine_km(F.col("q_lat"), F.col("q_lon"), clat, clon)
        return frontier.withColumns(
            {"lb": F.greatest(km - F.col("rad"), F.lit(0.0)), "ub": km + F.col("rad")}
        )

    def children(self, frontier: DataFrame, level: int) -> DataFrame:
        """Replace faced sub-cells by their non-empty children on the next level."""
        below = self.levels[level + 1].withColumns({"_py": F.floor(F.col("vy") / FANOUT), "_px": F.floor(F.col("ux") / FANOUT)})
        up = frontier.select(*[c for c in frontier.columns if c.startswith("q_")], "cell", F.col("vy").alias("_py"), F.col("ux").alias("_px"))
        return up.join(below, ["cell", "_py", "_px"]).drop("_py", "_px")

    def facing(self, queries: DataFrame, radius_km: float) -> DataFrame:
        q = _prefixed(with_reach(queries, radius_km, self.deg).drop("half"), "q_")
        return q.join(self.levels[0], "cell")


def has_hot_cell(points: DataFrame, deg: float, hot_rows: int = HOT_CELL_ROWS) -> bool:
    """One small aggregate: does any cell hold more than ``hot_rows`` points?"""
    sizes = with_cell(points.select("lat", "lon"), deg).groupBy("cell").count()
    return bool(sizes.filter(F.col("count") > hot_rows).take(1))


def _within(queries: DataFrame, tree: CellTree, radius_km: float) -> tuple[DataFrame, list[DataFrame]]:
    """Query x leaf rows that may hold points in reach, and per level the hot sub-cells wholly in reach."""
    frontier = tree.facing(queries, radius_km)
    leaves, whole = [], []
    for level in range(len(tree.levels)):
        # used three ways below, so it is computed once
        near = materialize(tree.bounds(frontier, level).filter(F.col("lb") <= radius_km), "faced")
        is_leaf = (F.col("n") <= tree.hot_rows) | F.lit(level == MAX_DEPTH)
        leaves.append(near.filter(is_leaf).withColumn("level", F.lit(level)))
        whole.append(near.filter(~is_leaf & (F.col("ub") <= radius_km)).withColumn("level", F.lit(level)))
        if level + 1 < len(tree.levels):
            frontier = tree.children(near.filter(~is_leaf & (F.col("ub") > radius_km)), level)
    return reduce(DataFrame.unionByName, leaves), whole


def _leaf_pairs(faced: DataFrame, tree: CellTree) -> DataFrame:
    members = _prefixed(tree.leaves, "p_", ("level", *SUB_CELL))
    km = haversine_km(F.col("q_lat"), F.col("q_lon"), F.col("p_lat"), F.col("p_lon"))
    faced = faced.drop("n", "rad", "lb", "ub")
    return crowd_join(faced, members, ("level", *SUB_CELL)).withColumn("km", km)


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def count_within(
    queries: DataFrame, points: DataFrame, radius_km: float, key: str, hot_rows: int = HOT_CELL_ROWS
) -> DataFrame:
    """Queries with ``within``: how many points lie at most ``radius_km`` away (0 included).

    Only if some cell is hot are points at the same coordinates folded into one weighted point.
    """
    spots = _located(points).select("lat", "lon", F.lit(1).cast("bigint").alias("w"))
    q = queries.select(key, "lat", "lon")
    deg = cell_deg(radius_km)
    hot = has_hot_cell(spots, deg, hot_rows)
    if hot:
        spots = materialize(spots.groupBy("lat", "lon").agg(F.sum("w").alias("w")), "points")
        hot = has_hot_cell(spots, deg, hot_rows)
    if not hot:
        parts = range_pairs(q, spots, radius_km).select(F.col("q_" + key).alias(key), F.col("p_w").alias("w"))
    else:
        tree = CellTree(spots, deg, hot_rows)
        leaves, whole = _within(q, tree, radius_km)
        parts = _leaf_pairs(leaves, tree).filter(F.col("km") <= radius_km)
        parts = parts.select(F.col("q_" + key).alias(key), F.col("p_w").alias("w"))
        for level, taken in enumerate(whole[: len(tree.hot_members)]):
            weights = tree.hot_members[level].groupBy(*SUB_CELL).agg(F.sum("w").alias("w"))
            parts = parts.unionByName(
                taken.join(weights, list(SUB_CELL)).select(F.col("q_" + key).alias(key), "w")
            )
    counts = parts.groupBy(key).agg(F.sum("w").alias("within"))
    return queries.join(counts, key, "left").withColumn("within", F.coalesce("within", F.lit(0)).cast("bigint"))


def top_within(
    queries: DataFrame,
    points: DataFrame,
    radius_km: float,
    k: int,
    key: str,
    order: tuple[tuple[str, str], ...],
    hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """The first ``k`` points by ``order`` at most ``radius_km`` from each query, as ``q_*, p_*, km, rnk``.

    ``order`` lists (point column, "asc" | "desc"). If some cell is hot: of the points at one place, and of a
    hot sub-cell wholly in reach, only their own first ``k`` can matter, so only those are paired.
    """
    pts = _located(points)
    deg = cell_deg(radius_km)
    hot = has_hot_cell(pts, deg, hot_rows)
    if hot:
        pts = materialize(_first_k(pts, k, ("lat", "lon"), _ordering(order)), "points")
        hot = has_hot_cell(pts, deg, hot_rows)
    if not hot:
        pairs = range_pairs(queries, pts, radius_km)
    else:
        tree = CellTree(pts, deg, hot_rows)
        leaves, whole = _within(queries, tree, radius_km)
        pairs = _leaf_pairs(leaves, tree).filter(F.col("km") <= radius_km).drop("level", *SUB_CELL)
        km = haversine_km(F.col("q_lat"), F.col("q_lon"), F.col("p_lat"), F.col("p_lon"))
        for level, taken in enumerate(whole[: len(tree.hot_members)]):
            best = _first_k(tree.hot_members[level], k, SUB_CELL, _ordering(order)).drop("_v", "_u")
            found = taken.drop("n", "rad", "lb", "ub", "level").join(_prefixed(best, "p_", SUB_CELL), list(SUB_CELL))
            pairs = pairs.unionByName(found.drop(*SUB_CELL).withColumn("km", km))
    by_query = Window.partitionBy("q_" + key).orderBy(*_ordering(order, "p_"))
    return pairs.withColumn("rnk", F.row_number().over(by_query)).filter(F.col("rnk") <= k)


def _ordering(order: tuple[tuple[str, str], ...], prefix: str = "") -> list[Column]:
    return [F.desc(prefix + c) if way == "desc" else F.asc(prefix + c) for c, way in order]


def _first_k(df: DataFrame, k: int, group: tuple[str, ...], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_r") <= k).drop("_r")


def nearest_within(
    queries: DataFrame, points: DataFrame, radius_km: float, key: str, ord_col: str, hot_rows: int = HOT_CELL_ROWS
) -> DataFrame:
    """``key``, the nearest point's columns as ``p_*`` and ``km``, for queries with a point at most ``radius_km`` away.

    Equal distances take the lowest ``ord_col``, so only that point is kept of every place. Where points are dense the
    search starts with a smaller radius, so that a query meets about as many of them however many there are.
    """
    pts = materialize(_one_per_place(_located(points), ord_col), "points")
    return _widening(_located(queries).select(key, "lat", "lon"), pts, _start_km(pts, radius_km), radius_km, key, ord_col, hot_rows)


def _start_km(pts: DataFrame, radius_km: float) -> float:
    """A quarter of the radius as often as points in cells of it see more than ``DENSE_ROWS`` in theirs; each leaves a sixteenth."""
    sizes = with_cell(pts.select("lat", "lon"), cell_deg(radius_km)).groupBy("cell").agg(F.count(F.lit(1)).cast("double").alias("n"))
    seen = sizes.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 0.0
    steps = math.ceil(math.log(max(seen / DENSE_ROWS, 1.0), FANOUT * FANOUT))
    return radius_km / FANOUT ** min(steps, MAX_STEPS)


def _widening(
    queries: DataFrame, pts: DataFrame, start_km: float, end_km: float, key: str, ord_col: str, hot_rows: int
) -> DataFrame:
    """Search a radius, then a four times wider one for queries that found nothing, up to ``end_km``.

    A point found within a radius is the nearest overall, so most queries are done after the first search.
    """
    left, radius, found = queries, min(start_km, end_km), []
    while radius < end_km:
        found.append(materialize(_nearest(left, pts, radius, key, ord_col, hot_rows), "nearest"))
        left = materialize(left.join(found[-1].select(key), key, "left_anti"), "queries")
        if not left.take(1):
            break
        radius = min(radius * FANOUT, end_km)
    else:
        found.append(_nearest(left, pts, radius, key, ord_col, hot_rows))
    return reduce(DataFrame.unionByName, found)


def _nearest(queries: DataFrame, pts: DataFrame, radius_km: float, key: str, ord_col: str, hot_rows: int) -> DataFrame:
    """``nearest_within`` of located queries and points of which no two lie at the same place."""
    deg = cell_deg(radius_km)
    if not has_hot_cell(pts, deg, hot_rows):
        return _first_by_distance(queries, key, key, lambda q: range_pairs(q, pts, radius_km), ord_col)
    tree = CellTree(pts, deg, hot_rows)
    faced = _closest_leaves(tree.facing(queries, radius_km), tree, key)
    return _first_by_distance(faced, "q_" + key, key, lambda q: _leaf_pairs(q, tree).filter(F.col("km") <= radius_km), ord_col)


def nearest_any(
    queries: DataFrame,
    points: DataFrame,
    key: str,
    ord_col: str,
    start_km: float = 25.0,
    hot_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Nearest point at any distance, see ``_widening``."""
    pts = materialize(_one_per_place(_located(points), ord_col), "points")
    left = materialize(_located(queries).select(key, "lat", "lon"), "queries")
    return _widening(left, pts, _start_km(pts, start_km), HALF_GLOBE_KM, key, ord_col, hot_rows)


def _one_per_place(points: DataFrame, ord_col: str) -> DataFrame:
    first = points.groupBy("lat", "lon").agg(F.min(ord_col).alias("_first")).withColumnsRenamed({"lat": "_lat", "lon": "_lon"})
    same = (F.col("lat") == F.col("_lat")) & (F.col("lon") == F.col("_lon")) & F.col(ord_col).eqNullSafe(F.col("_first"))
    return points.join(first, same, "left_semi")


def _closest_leaves(frontier: DataFrame, tree: CellTree, key: str) -> DataFrame:
    """Queries with the leaves that can still hold the nearest point after the best upper bound is known."""
    by_query = Window.partitionBy("q_" + key)
    kept = None
    for level in range(len(tree.levels)):
        faced = tree.bounds(frontier, level).withColumn("level", F.lit(level))
        faced = faced if kept is None else kept.unionByName(faced)
        faced = faced.withColumn("_best", F.min("ub").over(by_query)).filter(F.col("lb") <= F.col("_best")).drop("_best")
        faced = materialize(faced, "faced")
        deeper = (F.col("level") == level) & (F.col("n") > tree.hot_rows) & F.lit(level < MAX_DEPTH)
        kept = faced.filter(~deeper)
        if level + 1 == len(tree.levels):
            break
        frontier = tree.children(faced.filter(deeper), level)
    return kept


def _first_by_distance(
    queries: DataFrame, query_col: str, key: str, pairs_of: Callable[[DataFrame], DataFrame], ord_col: str
) -> DataFrame:
    """The nearest of the pairs that ``pairs_of`` makes of ``queries``, whose key is in ``query_col``.

    Pairs are made twice. The first time only the least distance of a query is kept, a number that a hash aggregate holds;
    a least row would sort all pairs. The second time only pairs at that distance are left, give or take rounding.
    """
    least = pairs_of(queries).groupBy(F.col("q_" + key).alias(query_col)).agg(F.min("km").alias("q_least"))
    least = materialize(least, "least")
    name = "least" if query_col == key else "q_least"
    pairs = pairs_of(queries.join(least.withColumnRenamed("q_least", name), query_col))
    pairs = pairs.filter(F.col("km") <= F.col("q_least") * (1 + 1e-9) + SLACK_KM).drop("q_least")
    cols = [c for c in pairs.columns if c.startswith("p_") and c != "p_" + ord_col]
    best = F.min(F.struct("km", "p_" + ord_col, *cols)).alias("_b")
    return pairs.groupBy(F.col("q_" + key).alias(key)).agg(best).select(key, "_b.*")
