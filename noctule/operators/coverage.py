"""Guarantee a least number of sites around every place, and label sites with their nearest place.

Places are served in file order; a place short of sites takes the darkest free mesh points in its radius, and
later places see what earlier ones took. What a place may take is in its wish list, the darkest free points it
would need if nobody were before it, so a place depends only on earlier short places with a wish within its radius.
Blocks of places serve their own in order and let those wait that depend on an unsettled place of another block; the
next round goes on with these. Only places, wish lists and taken points are moved, never pairs of places and points.
"""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from noctule import constants as K
from noctule.operators.proximity import cell_deg, count_within, nearest_any, nearest_within, top_within, with_cell, with_reach
from noctule.runtime import broadcast_if_small, materialize

MAX_PARTS = 8
# Places that a block serves in one round, about.
PLACES_AT_ONCE = 20_000
DARKEST_FIRST = (("darkness", "desc"), ("cand_ord", "asc"))


def distinct_places(places: DataFrame) -> DataFrame:
    """First place (lowest ``place_ord``) of every location.

    A later place at the same spot finds the same surroundings after the first one was served, or an exhausted
    pool, and never adds anything.
    """
    here = places.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return here.groupBy("lat", "lon").agg(F.min("place_ord").alias("place_ord")).select("place_ord", "lat", "lon")


def coverage_deficit(
    kept: DataFrame, places: DataFrame, min_spots: int = K.MIN_SPOTS_PER_AREA, radius_km: float = K.COVERAGE_RADIUS_KM
) -> DataFrame:
    """Places with fewer than ``min_spots`` kept sites in the radius, with ``within`` and ``need``."""
    counted = count_within(places, kept, radius_km, "place_ord")
    return counted.filter(F.col("within") < min_spots).withColumn("need", (F.lit(min_spots) - F.col("within")).cast("int"))


def coverage_pool(
    kept: DataFrame,
    mesh: DataFrame,
    places: DataFrame,
    min_spots: int = K.MIN_SPOTS_PER_AREA,
    radius_km: float = K.COVERAGE_RADIUS_KM,
) -> DataFrame:
    """Every mesh point a short place could take: the first ``need`` non-kept points by (darkness desc, cand_ord).

    More is never needed: a point of this list that an earlier place took counts towards ``min_spots`` here.
    """
    short = materialize(coverage_deficit(kept, places, min_spots, radius_km), "short")
    return _pool(short, kept, mesh, min_spots, radius_km)


def _pool(short: DataFrame, kept: DataFrame, mesh: DataFrame, min_spots: int, radius_km: float) -> DataFrame:
    free = mesh.select("cand_ord", "lat", "lon", "darkness").join(kept.select("cand_ord"), "cand_ord", "left_anti")
    top = top_within(short.select("place_ord", "lat", "lon", "need"), free, radius_km, min_spots, "place_ord", DARKEST_FIRST)
    return top.filter(F.col("rnk") <= F.col("q_need")).select(
        F.col("q_place_ord").alias("place_ord"),
        F.col("q_need").alias("need"),
        F.col("p_cand_ord").alias("cand_ord"),
        F.col("p_lat").alias("lat"),
        F.col("p_lon").alias("lon"),
        F.col("p_darkness").alias("darkness"),
        "rnk",
    )


def ensure_coverage(
    kept: DataFrame,
    mesh: DataFrame,
    places: DataFrame,
    min_spots: int = K.MIN_SPOTS_PER_AREA,
    radius_km: float = K.COVERAGE_RADIUS_KM,
    at_once: int = PLACES_AT_ONCE,
    rounds: list[int] | None = None,
) -> DataFrame:
    """Kept sites plus the added ones, with ``added_by`` (-1 for kept, else the place served).

    The sequential result order is ``coverage_order()``. Sites are identified by ``cand_ord``, never by their
    coordinates: an equal-valued second mesh point is a site of its own. ``rounds``, if given, gets the number of
    places open before each round.
    """
    short = materialize(coverage_deficit(kept, distinct_places(places), min_spots, radius_km), "short")
    added = _serve(short, _pool(short, kept, mesh, min_spots, radius_km), radius_km, at_once, [] if rounds is None else rounds)
    cols = kept.columns
    base = kept.withColumn("added_by", F.lit(-1).cast("bigint"))
    new = mesh.join(added, "cand_ord").select(*cols, "added_by")
    return base.unionByName(new)


def coverage_order() -> list[Column]:
    return [F.asc("added_by"), F.desc("darkness"), F.asc("cand_ord")]


# --- serving --------------------------------------------------------------------------------------

TAKEN = "place_ord bigint, first boolean, cand_ord bigint, lat double, lon double"


def _serve(short: DataFrame, pool: DataFrame, radius_km: float, at_once: int, rounds: list[int]) -> DataFrame:
    """(cand_ord, added_by) of every addition.

    Places are taken in order up to a place ``cut`` and served in rounds. Then places that got enough from these leave,
    and the next stretch of the order follows. Where places are dense the first ones serve most of the others, so a
    stretch has about ``at_once`` places; it gets longer while more than half of the others are left. No block has more
    than about ``at_once`` places of a stretch.
    """
    listed = F.array_sort(F.collect_list(F.struct("rnk", "cand_ord", "lat", "lon"))).alias("wishes")
    wishes = pool.groupBy("place_ord").agg(listed)
    counts: dict[str, int] = {}
    # a place without a wish takes nothing and keeps nobody waiting
    left = materialize(
        short.select("place_ord", "lat", "lon", "need").join(wishes, "place_ord").select(
            "place_ord", "lat", "lon", "need", F.col("wishes.cand_ord").alias("w_ord"), F.col("wishes.lat").alias("w_lat"), F.col("wishes.lon").alias("w_lon")
        ),
        "waiting",
        counts,
    )
    taken: list[DataFrame] = []
    none = left.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(TAKEN)]).limit(0)
    n_left, stretch = counts["waiting"], at_once
    while n_left:
        cut = _cut(left, stretch / n_left) if n_left > stretch else None
        open_ = _up_to(left, cut)
        n_open = n_left if cut is None else open_.count()
        deg, block_cut = _blocks(open_, n_open, radius_km, at_once)
        if block_cut is not None:
            cut, open_ = block_cut, _up_to(left, block_cut)
            n_open = open_.count()
        n_others = n_left - n_open
        while n_open:
            rounds.append(n_open)
            if len(taken) > MAX_PARTS:
                taken = [materialize(reduce(DataFrame.unionByName, taken), "taken")]
            routed = _routed(open_, reduce(DataFrame.unionByName, taken, none), radius_km, deg)
            served = materialize(routed.groupBy("cell").applyInArrow(_block_pass(radius_km), TAKEN), "served")
            taken.append(served.filter(F.col("cand_ord").isNotNull()))
            settled = served.filter("first").select("place_ord")
            n_settled = settled.count()
            if n_settled < n_open:
                open_ = materialize(open_.join(broadcast_if_small(settled, n_settled), "place_ord", "left_anti"), "open")
            n_open -= n_settled
        if cut is None:
            break
        later = count_within(left.filter(F.col("place_ord") > cut), reduce(DataFrame.unionByName, taken, none), radius_km, "place_ord")
        left = materialize(later.filter(F.col("within") < F.col("need")).drop("within"), "waiting", counts)
        n_left = counts["waiting"]
        if 2 * n_left > n_others:
            stretch *= 4
    return reduce(DataFrame.unionByName, taken, none).select("cand_ord", F.col("place_ord").alias("added_by"))


def _cut(left: DataFrame, share: float) -> int:
    """The place up to which about this share of the places lies in order."""
    return left.agg(F.percentile_approx("place_ord", share, 10_000)).first()[0]


def _up_to(left: DataFrame, cut: int | None) -> DataFrame:
    return left if cut is None else left.filter(F.col("place_ord") <= cut)


def _blocks(left: DataFrame, n_left: int, radius_km: float, at_once: int) -> tuple[float, int | None]:
    """Block height in degrees, and the last place for now if a block of the least height holds too many.

    One block for all if they are few, else the highest blocks that are not too full.
    """
    if n_left <= at_once:
        return 360.0, None
    least = cell_deg(4 * radius_km)
    deg = max(45.0, least)
    while True:
        sizes = with_cell(left.select("place_ord", "lat", "lon"), deg).groupBy("cell")
        fullest = sizes.count().agg(F.max("count")).first()[0]
        if fullest <= at_once:
            return deg, None
        if deg == least:
            break
        deg = max(deg / 2, least)
    # an estimate will do: any cut is right, it only bounds what a block holds
    shares = [2.0**-k for k in range(1, 40)]
    full = sizes.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("place_ord", shares, 10_000).alias("cuts")).filter(F.col("n") > at_once)
    step = F.least(F.ceil(F.log2(F.col("n") / F.lit(at_once))).cast("int"), F.lit(len(shares)))
    return deg, full.agg(F.min(F.get("cuts", step - 1))).first()[0]


def _routed(open_: DataFrame, taken: DataFrame, radius_km: float, deg: float) -> DataFrame:
    """What every block needs to see: its own places, others whose wishes may matter to them, and points taken near them.

    A taken point is a row without ``need`` at the place in the order that took it.
    """
    homes = with_cell(open_, deg).withColumnRenamed("cell", "home")
    # a wish of a place within twice the radius can lie in another's radius
    places = with_reach(homes, 2 * radius_km, deg).select(
        "cell", (F.col("cell") == F.col("home")).alias("own"), "place_ord", "lat", "lon", "need", "w_ord", "w_lat", "w_lon"
    )
    points = with_reach(taken, radius_km, deg).select(
        "cell", F.lit(False).alias("own"), "place_ord", "lat", "lon", F.lit(0).alias("need"), F.array("cand_ord").alias("w_ord"), F.array("lat").alias("w_lat"), F.array("lon").alias("w_lon")
    )
    if deg >= 360:
        return places.unionByName(points)
    live = materialize(homes.select(F.col("home").alias("cell")).distinct(), "blocks")
    return places.unionByName(points).join(broadcast_if_small(live, live.count()), "cell", "left_semi")


class _Near:
    """Points in boxes as wide as the radius, for looking around one place at a time."""

    def __init__(self, radius_km: float) -> None:
        self.km = radius_km
        chord = 2 * math.sin(min(radius_km / K.EARTH_RADIUS_KM, math.pi) / 2)
        self.side, self.limit = chord * (1 + 1e-9) + 1e-12, chord * chord
        self.boxes: dict[tuple[int, int, int], list] = {}
        self.fixed: dict[tuple[int, int, int], np.ndarray] = {}

    def _at(self, lat: float, lon: float) -> tuple[float, float, float]:
        phi, lam = math.radians(lat), math.radians(lon)
        return math.cos(phi) * math.cos(lam), math.cos(phi) * math.sin(lam), math.sin(phi)

    def add(self, lat: float, lon: float) -> None:
        x, y, z = self._at(lat, lon)
        box = (math.floor(x / self.side), math.floor(y / self.side), math.floor(z / self.side))
        self.boxes.setdefault(box, []).append((x, y, z, lat, lon))
        self.fixed.pop(box, None)

    def count(self, lat: float, lon: float, enough: int) -> int:
        """Points at most the radius away; looking ends at ``enough``."""
        x, y, z = self._at(lat, lon)
        i, j, k = math.floor(x / self.side), math.floor(y / self.side), math.floor(z / self.side)
        n = 0
        for box in itertools.product((i, i - 1, i + 1), (j, j - 1, j + 1), (k, k - 1, k + 1)):
            if box not in self.boxes:
                continue
            rows = self.fixed.get(box)
            if rows is None:
                rows = self.fixed[box] = np.array(self.boxes[box])
            far = ((rows[:, :3] - (x, y, z)) ** 2).sum(axis=1)
            n += int((far <= self.limit * (1 - 1e-9)).sum())
            for at in np.flatnonzero(np.abs(far - self.limit) < self.limit * 1e-9):
                n += great_circle_km(*rows[at, 3:], lat, lon) <= self.km
            if n >= enough:
                break
        return n


def great_circle_km(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    s, t = math.sin(math.radians(lat2 - lat1) / 2), math.sin(math.radians(lon2 - lon1) / 2)
    half_chord2 = s * s + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * t * t
    return math.asin(math.sqrt(min(half_chord2, 1.0))) * 2 * K.EARTH_RADIUS_KM


def _block_pass(radius_km: float):
    """Function for one block: serve its own places in order as far as the rows at hand allow."""

    def serve(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place_ord")
        taken, open_wishes, gone = _Near(radius_km), _Near(radius_km), set()
        out: list[tuple] = []
        columns = [rows[c].to_pylist() for c in ("own", "place_ord", "lat", "lon", "need", "w_ord", "w_lat", "w_lon")]
        for own, place, lat, lon, need, *wishes in zip(*columns, strict=True):
            points = list(zip(*wishes, strict=True))
            if not need:
                gone.add(points[0][0])
                taken.add(lat, lon)
                continue
            free = [p for p in points if p[0] not in gone]
            # an earlier place that is not settled may still take a point here
            if not own or (open_wishes.boxes and open_wishes.count(lat, lon, 1)):
                for p in free:
                    open_wishes.add(*p[1:])
                continue
            picks = free[: max(0, need - taken.count(lat, lon, need))]
            out.append((place, True, *(picks[0] if picks else (None, None, None))))
            out += [(place, False, *p) for p in picks[1:]]
            for p in picks:
                gone.add(p[0])
                taken.add(*p[1:])
        schema = pa.schema([("place_ord", pa.int64()), ("first", pa.bool_()), ("cand_ord", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64())])
        return pa.table([list(c) for c in zip(*out, strict=True)] or [[]] * 5, schema=schema)

    return serve


def attach_nearest_place(
    spots: DataFrame, places: DataFrame, max_km: float | None = K.MAX_NEAR_DISTANCE_KM, key: str = "cand_ord"
) -> DataFrame:
    """Spots with ``near``: the closest place's name, or "" when none is at most ``max_km`` away.

    A ``near`` that is already set, also "", is kept. Equal distances take the first place in file order.
    """
    named = places.select("place_ord", "name", "lat", "lon")
    open_ = spots.filter(F.col("near").isNull()) if "near" in spots.columns else spots
    if max_km is None:
        found = nearest_any(open_, named, key, "place_ord")
    else:
        found = nearest_within(open_, named, max_km, key, "place_ord")
    found = found.select(key, F.col("p_name").alias("_found"))
    known = F.col("near") if "near" in spots.columns else F.lit(None).cast("string")
    return spots.join(found, key, "left").withColumn("near", F.coalesce(known, F.col("_found"), F.lit(""))).drop("_found")
