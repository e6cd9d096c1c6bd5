"""Greedy distance thinning of candidates, exactly as one sequential scan would decide it.

The scan goes by (darkness descending, cand_ord) and keeps a candidate unless a kept one of the same Bortle
class is nearer than the minimum distance. That decision depends only on earlier candidates close by, so it
can be made block by block: a group decides what it can and waits where an undecided neighbour of another group
matters. Decisions move on as a wavefront: only groups that learnt something from a neighbour run again, and a
round reads the rows of these groups and of their neighbours alone. The result does not depend on the grouping.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from noctule import constants as K
from noctule.functions.geo import haversine_km
from noctule.operators.proximity import CROWD_QUERIES, KM_PER_DEG, half_width, range_pairs, with_cell, with_reach
from noctule.runtime import broadcast_if_small, materialize

GROUP_ROWS = 50_000
CROWD_ROWS = 2_000
# height and width of the pieces that groups are put together from
STRIP_DEG = 0.25
SEGMENT_DEG = 1.0
MAX_PARTS = 16
SLIM = ["cand_ord", "lat", "lon", "darkness", "bortle"]


def priority() -> list[Column]:
    return [F.desc("darkness"), F.asc("cand_ord")]


def redundancy_edges(
    candidates: DataFrame, min_distance_km: float = K.REDUNDANCY_KM, crowd: int = CROWD_QUERIES
) -> DataFrame:
    """Pairs (first_ord, second_ord) of one class nearer than the distance, the first one earlier in the scan.

    A report for looking at conflicts; ``redundancy_filter`` never builds it.
    """
    slim = candidates.select(*SLIM)
    pairs = range_pairs(slim, slim, min_distance_km, keys=("bortle",), inclusive=False, crowd=crowd)
    earlier = (F.col("q_darkness") > F.col("p_darkness")) | (
        (F.col("q_darkness") == F.col("p_darkness")) & (F.col("q_cand_ord") < F.col("p_cand_ord"))
    )
    return pairs.filter(earlier).select(
        F.col("q_cand_ord").alias("first_ord"), F.col("p_cand_ord").alias("second_ord"), "km"
    )


def redundancy_filter(
    candidates: DataFrame,
    min_distance_km: float = K.REDUNDANCY_KM,
    group_rows: int = GROUP_ROWS,
    crowd_rows: int = CROWD_ROWS,
    rounds: list[int] | None = None,
) -> DataFrame:
    """Candidates that survive thinning; order them by (darkness desc, cand_ord) for the scan's output order.

    ``rounds``, if given, gets the number of groups that ran in each round.
    """
    left = materialize(candidates.select(*SLIM), "thin-in")
    left, kept, largest = _settle_crowds(left, min_distance_km, crowd_rows)
    kept = kept + _wavefront(left, min_distance_km, group_rows, largest, [] if rounds is None else rounds)
    ids = reduce(DataFrame.unionByName, [k.select("cand_ord") for k in kept], left.select("cand_ord").limit(0))
    return candidates.join(ids, "cand_ord", "left_semi")


# --- crowded places -----------------------------------------------------------------------------


def _settle_crowds(left: DataFrame, km: float, crowd_rows: int) -> tuple[DataFrame, list[DataFrame], int]:
    """Thin with aggregates only while some sub-cell holds more than ``crowd_rows`` candidates of a class.

    Sub-cells are smaller than the distance, so each ends with at most one kept candidate. A sub-cell's first
    candidate that precedes the first of every sub-cell in reach is kept for certain; everything of its class
    in reach is dropped. No group is ever collected. Returns what is left, the kept, and the rows of the largest class.
    """
    deg = 0.45 * km / KM_PER_DEG
    kept: list[DataFrame] = []
    while True:
        fullest, largest = _crowding(left, deg)
        if fullest <= crowd_rows:
            return left, kept, largest
        celled = with_cell(left, deg)
        rank = F.struct((-F.col("darkness")).alias("k"), F.col("cand_ord"), F.col("lat"), F.col("lon"))
        tops = materialize(
            celled.groupBy("bortle", "cell").agg(F.min(rank).alias("top")).select("bortle", "cell", "top.*"), "tops"
        )
        rivals = tops.select(
            F.col("bortle").alias("r_bortle"), "cell", F.col("k").alias("r_k"), F.col("cand_ord").alias("r_ord")
        )
        reach = with_reach(tops.drop("cell"), km, deg)
        beaten = (F.col("r_k") < F.col("k")) | ((F.col("r_k") == F.col("k")) & (F.col("r_ord") < F.col("cand_ord")))
        same = (reach["cell"] == rivals["cell"]) & reach["bortle"].eqNullSafe(rivals["r_bortle"])
        losers = reach.join(rivals, same).filter(beaten).select("cand_ord").distinct()
        winners = materialize(tops.join(losers, "cand_ord", "left_anti"), "winners")
        kept.append(winners)
        near = with_reach(
            winners.select(F.col("bortle").alias("w_bortle"), F.col("lat").alias("w_lat"), F.col("lon").alias("w_lon")),
            km, deg, "w_lat", "w_lon",
        )
        near = broadcast_if_small(near, near.count())
        hit = (
            (celled["cell"] == near["cell"])
            & celled["bortle"].eqNullSafe(near["w_bortle"])
            & (haversine_km(F.col("lat"), F.col("lon"), F.col("w_lat"), F.col("w_lon")) < km)
        )
        # a winner is at distance 0 of itself and leaves with its neighbours
        left = materialize(celled.join(near, hit, "left_anti").select(*SLIM), "thin-left")


def _crowding(left: DataFrame, deg: float) -> tuple[int, int]:
    """Rows of the fullest sub-cell of a class, and of the largest class."""
    cells = with_cell(left.select("bortle", "lat", "lon"), deg).groupBy("bortle", "cell").agg(F.count(F.lit(1)).alias("n"))
    classes = cells.groupBy("bortle").agg(F.max("n").alias("fullest"), F.sum("n").alias("rows"))
    return tuple(x or 0 for x in classes.agg(F.max("fullest"), F.max("rows")).first())


# --- blocks ---------------------------------------------------------------------------------------


def _piece(lat: Column, lon: Column) -> dict[str, Column]:
    return {"b_row": F.floor(lat / F.lit(STRIP_DEG)), "b_col": F.floor((lon + F.lit(180.0)) / F.lit(SEGMENT_DEG))}


def _class_group() -> Column:
    """Number of a class's first group; further ones follow by strip and place in the strip."""
    return F.shiftleft((F.coalesce(F.col("bortle"), F.lit(-1)) + 1).cast("bigint"), 48)


def _groups(left: DataFrame, group_rows: int) -> DataFrame:
    """Group number ``grp`` of every (class, piece): blocks of about ``group_rows`` candidates, about as many across as down.

    Ties are scanned from north-west along the rows, so such blocks are decided along diagonals, many at a
    time, where strips of the whole width would be one after the other. The histogram has one row per piece.
    """
    pieces = left.select("bortle", *[c.alias(n) for n, c in _piece(F.col("lat"), F.col("lon")).items()])
    sizes = materialize(pieces.groupBy("bortle", "b_row", "b_col").agg(F.count(F.lit(1)).alias("n")), "pieces")
    rows = sizes.groupBy("bortle", "b_row").agg(F.sum("n").alias("row_n"))
    of_class = Window.partitionBy("bortle")
    down = of_class.orderBy(F.desc("b_row")).rowsBetween(Window.unboundedPreceding, -1)
    high = F.greatest(F.sqrt(F.sum("row_n").over(of_class) * F.lit(float(group_rows))), F.lit(float(group_rows)))
    rows = rows.withColumn("strip", F.floor(F.coalesce(F.sum("row_n").over(down), F.lit(0)) / high))
    joined = sizes.join(
        rows.withColumnsRenamed({"bortle": "r_bortle", "b_row": "r_row"}),
        sizes["bortle"].eqNullSafe(F.col("r_bortle")) & (sizes["b_row"] == F.col("r_row")),
    )
    # columns of a strip, over all its rows
    columns = joined.groupBy("bortle", "strip", "b_col").agg(F.sum("n").alias("col_n"))
    along = Window.partitionBy("bortle", "strip").orderBy("b_col").rowsBetween(Window.unboundedPreceding, -1)
    columns = columns.withColumn("part", F.floor(F.coalesce(F.sum("col_n").over(along), F.lit(0)) / F.lit(group_rows)))
    columns = columns.withColumnsRenamed({"bortle": "c_bortle", "strip": "c_strip", "b_col": "c_col"})
    same = joined["bortle"].eqNullSafe(columns["c_bortle"]) & (joined["strip"] == columns["c_strip"]) & (joined["b_col"] == columns["c_col"])
    grp = _class_group() + F.shiftleft(F.col("strip").cast("bigint"), 24) + F.col("part")
    return joined.join(columns, same).select("bortle", "b_row", "b_col", grp.alias("grp"))


def _routed(left: DataFrame, km: float, group_rows: int) -> DataFrame:
    """Every candidate with its own group and all groups within the distance (``targets``, own included)."""
    groups = materialize(_groups(left, group_rows), "groups")
    groups = broadcast_if_small(groups, groups.count())
    ang = km / KM_PER_DEG + 1e-9
    lat, lon = F.col("lat"), F.col("lon")
    half = half_width(lat, km)
    n_cols = int(360 / SEGMENT_DEG)
    west, east = F.floor((lon - half + 180.0) / SEGMENT_DEG), F.floor((lon + half + 180.0) / SEGMENT_DEG)
    cols = F.when(east - west >= n_cols, F.sequence(F.lit(0).cast("bigint"), F.lit(n_cols - 1).cast("bigint"))).otherwise(
        F.transform(F.sequence(west, east), lambda c: F.pmod(c, F.lit(n_cols).cast("bigint")))
    )
    rows = F.sequence(F.floor((lat - ang) / STRIP_DEG), F.floor((lat + ang) / STRIP_DEG))
    own = _piece(lat, lon)
    spread = (
        left.withColumns({"o_row": own["b_row"], "o_col": own["b_col"]})
        .withColumn("t_row", F.explode(rows))
        .withColumn("t_col", F.explode(cols))
    )
    on = (
        spread["bortle"].eqNullSafe(groups["bortle"])
        & (spread["t_row"] == groups["b_row"])
        & (spread["t_col"] == F.pmod(groups["b_col"], F.lit(n_cols).cast("bigint")))
    )
    hit = spread.join(groups.select(F.col("bortle").alias("s_bortle"), "*"), on).select(
        *[spread[c] for c in SLIM],
        "grp",
        ((F.col("t_row") == F.col("o_row")) & (F.col("t_col") == F.pmod("o_col", F.lit(n_cols).cast("bigint")))).alias("mine"),
    )
    return hit.groupBy(*SLIM).agg(
        F.max(F.when(F.col("mine"), F.col("grp"))).alias("grp"), F.collect_set("grp").alias("targets")
    )


# --- wavefront ------------------------------------------------------------------------------------

UNDECIDED, KEPT, DROPPED = 0, 1, 2
STATE = "cand_ord bigint, lat double, lon double, darkness double, bortle int, grp bigint, targets array<bigint>, state int, fresh boolean"


def _wavefront(left: DataFrame, km: float, group_rows: int, largest: int, rounds: list[int]) -> list[DataFrame]:
    """The kept candidates. Each round writes the groups that ran, one partition each, and nothing else.

    The driver holds the last round and the neighbours of every group; groups have about ``group_rows`` candidates, so that
    is little.
    """
    decide = _local_pass(km)
    if largest <= group_rows:
        # no group faces another one: the first round is the last
        rows = left.withColumn("grp", _class_group()).withColumn("target", F.col("grp"))
        rows = rows.withColumns({"targets": F.array("grp"), "state": F.lit(UNDECIDED)})
        rounds.append(1)
        return [materialize(rows.groupBy("target").applyInPandas(decide, STATE), "thin-round").filter(F.col("state") == KEPT)]

    routed = materialize(_routed(left, km, group_rows), "thin-routed", by="grp")
    tables, last = [routed.withColumns({"state": F.lit(UNDECIDED), "fresh": F.lit(False)})], {}
    faced_by: dict[int, set[int]] = defaultdict(set)
    for r in routed.select("grp", F.explode("targets").alias("target")).distinct().collect():
        faced_by[r["target"]].add(r["grp"])
        last[r["grp"]] = 0
    kept: list[DataFrame] = []
    active, waiting = set(last), set(last)
    while active:
        rounds.append(len(active))
        wanted: dict[int, list[int]] = defaultdict(list)
        for group in set().union(*(faced_by[a] for a in active)):
            wanted[last[group]].append(group)
        rows = reduce(DataFrame.unionByName, [tables[k].filter(F.col("grp").isin(groups)) for k, groups in wanted.items()])
        sent = rows.filter(F.col("state") != DROPPED).withColumn("target", F.explode("targets")).filter(F.col("target").isin(sorted(active)))
        done = materialize(sent.groupBy("target").applyInPandas(decide, STATE), "thin-round", by="grp")
        last.update(dict.fromkeys(active, len(tables)))
        tables.append(done)
        kept.append(done.filter((F.col("state") == KEPT) & F.col("fresh")).select("cand_ord"))
        if len(kept) > MAX_PARTS:
            kept = [materialize(reduce(DataFrame.unionByName, kept), "thin-kept")]
        told = done.select("grp", "state", "fresh", F.explode("targets").alias("target"))
        told = told.groupBy("grp", "target").agg(F.max(F.col("state") == UNDECIDED).alias("open"), F.max("fresh").alias("news")).collect()
        # who waits hears of news; a group that waits without news would repeat itself
        waiting = waiting - active | {r["grp"] for r in told if r["open"]}
        active = {r["target"] for r in told if r["news"] and r["target"] != r["grp"]} & waiting
    return kept


def _local_pass(km: float):
    """Function for one group: decide its own rows as far as the rows at hand allow."""

    def decide(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["darkness", "cand_ord"], ascending=[False, True], kind="stable")
        own = (rows["grp"] == key[0]).to_numpy()
        before = rows["state"].to_numpy()
        after = greedy_states(rows["lat"].to_numpy(), rows["lon"].to_numpy(), before, own, km)
        fresh = (before == UNDECIDED) & (after != UNDECIDED)
        # dropped rows matter only where another group waits for them
        told = (after != DROPPED) | (rows["targets"].str.len() > 1).to_numpy()
        return rows.assign(state=after, fresh=fresh)[own & told].drop(columns=["target"])

    return decide


def greedy_states(lat: np.ndarray, lon: np.ndarray, state: np.ndarray, own: np.ndarray, km: float) -> np.ndarray:
    """Scan rows in priority order: drop near a kept row, wait near a waiting one, else keep.

    Rows of other groups are never kept here, only dropped or waited for. Settled rows sit in a grid of cells
    as wide as the distance, so each row looks at a handful of them.
    """
    out = state.copy()
    deg = km / 111.0
    band = np.floor(lat / deg).astype(np.int64)
    phi, lam = np.radians(lat), np.radians(lon)
    xyz = np.column_stack([np.cos(phi) * np.cos(lam), np.cos(phi) * np.sin(lam), np.sin(phi)]).tolist()
    ang = km / K.EARTH_RADIUS_KM
    with np.errstate(invalid="ignore", divide="ignore"):
        half = np.degrees(np.arcsin(np.minimum(np.sin(ang) / np.cos(phi), 1.0))) + 1e-9
    half = np.where(np.abs(lat) + math.degrees(ang) >= 90, 180.0, half)

    def width(b: np.ndarray) -> np.ndarray:
        edge = np.minimum(np.maximum(np.abs(b * deg), np.abs((b + 1) * deg)), 90.0)
        return np.maximum(np.floor(360.0 / deg * np.cos(np.radians(edge))), 1).astype(np.int64)

    n0 = width(band)
    home = np.floor((lon + 180.0) * n0 / 360.0).astype(np.int64) % n0
    looks = []
    for step in (-1, 0, 1):
        n = width(band + step)
        west = np.floor((lon - half + 180.0) * n / 360.0).astype(np.int64)
        east = np.minimum(np.floor((lon + half + 180.0) * n / 360.0).astype(np.int64), west + n - 1)
        looks.append((n.tolist(), west.tolist(), east.tolist()))
    bands, homes, mine, given = band.tolist(), home.tolist(), own.tolist(), state.tolist()
    lats, lons = lat.tolist(), lon.tolist()
    limit = (2.0 * math.sin(ang / 2.0)) ** 2
    settled: dict[tuple[int, int], list[int]] = {}
    waiting: dict[tuple[int, int], list[int]] = {}

    def near(cells: dict, i: int) -> bool:
        x, y, z = xyz[i]
        for step, (n, west, east) in zip((-1, 0, 1), looks):
            for c in range(west[i], east[i] + 1):
                for j in cells.get((bands[i] + step, c % n[i]), ()):
                    u, v, w = xyz[j]
                    chord = (x - u) ** 2 + (y - v) ** 2 + (z - w) ** 2
                    if chord < limit * (1 - 1e-9) or (
                        chord < limit * (1 + 1e-9) and _haversine(lats[j], lons[j], lats[i], lons[i]) < km
                    ):
                        return True
        return False

    for i in range(len(lats)):
        spot = (bands[i], homes[i])
        if given[i] == KEPT:
            settled.setdefault(spot, []).append(i)
        elif near(settled, i):
            out[i] = DROPPED
        elif not mine[i] or (waiting and near(waiting, i)):
            waiting.setdefault(spot, []).append(i)
        else:
            out[i] = KEPT
            settled.setdefault(spot, []).append(i)
    return out


def _haversine(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    s = math.sin(math.radians(lat2 - lat1) / 2)
    t = math.sin(math.radians(lon2 - lon1) / 2)
    a = min(s * s + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * t * t, 1.0)
    return K.EARTH_RADIUS_KM * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
