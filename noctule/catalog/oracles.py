"""SQL for DuckDB that computes the rows of the registered queries in a plain, unindexed way."""

from __future__ import annotations

import math

from noctule import constants as K
from noctule.catalog import tables as t
from noctule.catalog.queries import (
    ALR_CIRCLE_QUERY,
    ALR_GEO_QUERY,
    ALR_QUERY,
    BOX_MARGIN_KM,
    COVER_KM,
    MESH_COARSE,
    MESH_COVER,
    MESH_FINE,
    MIN_SPOTS,
)
from noctule.operators.alr import AlrParams

COLS = t.RASTER_COLS


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"least(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2), 1.0)"
    )
    return f"({K.EARTH_RADIUS_KM} * 2 * asin(sqrt({a})))"


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts)


GRID = f"grid AS (SELECT (max(o_orderkey) + 1) // {COLS} AS n_rows, -10.0::DOUBLE / ((max(o_orderkey) + 1) // {COLS}) AS e FROM orders)"


def _pixels(tied: bool = False) -> str:
    dark = "WHEN o_orderstatus = 'F' THEN 0.01::DOUBLE" if tied else ""
    return f"""pixels AS (
  SELECT (o_orderkey // {COLS})::INT AS "row", (o_orderkey % {COLS})::INT AS col,
         CASE WHEN o_orderkey % 17 = 0 THEN 'NaN'::DOUBLE {dark} ELSE o_totalprice / 40000.0::DOUBLE END AS alr
  FROM orders)"""


_CLASSES = " ".join(f"WHEN alr <= {bound}::DOUBLE THEN {cls}" for bound, cls in K.BORTLE_THRESHOLDS)
SCORED = f"""scored AS (
  SELECT "row", col,
         CASE WHEN isnan(alr) OR alr + {K.ALR_EPS}::DOUBLE < 0 THEN NULL
              WHEN alr + {K.ALR_EPS}::DOUBLE = 0 THEN 1.0::DOUBLE
              ELSE least(greatest(1.0::DOUBLE - (log10(alr + {K.ALR_EPS}::DOUBLE) - log10({K.ALR_DARK}::DOUBLE))
                   / (log10({K.ALR_BRIGHT}::DOUBLE) - log10({K.ALR_DARK}::DOUBLE)), 0.0), 1.0) END AS darkness,
         (CASE WHEN isnan(alr) THEN {K.BORTLE_NO_DATA} {_CLASSES} ELSE {K.BORTLE_ABOVE} END)::INT AS bortle
  FROM pixels)"""


def _mesh(mesh_km: float, pick: str = "min") -> str:
    deg = mesh_km / K.MESH_KM_PER_DEG
    px_x = max(1, round(deg / 0.1))
    way = "" if pick == "min" else "DESC"
    return f"""cells AS (
  SELECT s.*, greatest(1, round_even({deg!r}::DOUBLE / abs(g.e), 0))::BIGINT AS px_y, g.e FROM scored s, grid g WHERE darkness IS NOT NULL),
mesh AS (
  SELECT cand_ord, 51.0::DOUBLE + e * ("row" + 0.5::DOUBLE) AS lat, -5.0::DOUBLE + 0.1::DOUBLE * (col + 0.5::DOUBLE) AS lon,
         darkness, "row", col, bortle
  FROM (SELECT *, row_number() OVER (PARTITION BY cand_ord ORDER BY darkness {way}, "row", col) AS nth
        FROM (SELECT *, ("row" // px_y) * {-(-COLS // px_x)} + col // {px_x} AS cand_ord FROM cells))
  WHERE nth = 1)"""


def _edges(limit: float = K.REDUNDANCY_KM) -> str:
    dist = km("a.lat", "a.lon", "b.lat", "b.lon")
    return f"""edges AS MATERIALIZED (
  SELECT a.cand_ord AS first_ord, b.cand_ord AS second_ord, {dist} AS km
  FROM mesh a JOIN mesh b ON a.bortle = b.bortle AND abs(a.lat - b.lat) < {limit / 111.0!r}
   AND (a.darkness > b.darkness OR (a.darkness = b.darkness AND a.cand_ord < b.cand_ord))
  WHERE {dist} < {limit})"""


# every round settles the candidates whose earlier neighbours are all settled
THIN = """thin_rounds AS (
  SELECT 0 AS it, cand_ord, 0 AS s FROM mesh
  UNION ALL
  SELECT c.it + 1, c.cand_ord,
         CASE WHEN c.s <> 0 THEN c.s WHEN bool_or(h.s = 1) THEN 2 WHEN coalesce(bool_and(h.s = 2), true) THEN 1 ELSE 0 END
  FROM thin_rounds c LEFT JOIN edges ON edges.second_ord = c.cand_ord LEFT JOIN thin_rounds h ON h.cand_ord = edges.first_ord
  WHERE EXISTS (SELECT 1 FROM thin_rounds WHERE s = 0)
  GROUP BY c.it, c.cand_ord, c.s),
kept AS MATERIALIZED (
  SELECT mesh.* FROM mesh JOIN thin_rounds r USING (cand_ord) WHERE r.it = (SELECT max(it) FROM thin_rounds) AND r.s = 1)"""

PLACES = """places AS (
  SELECT c_custkey AS place_ord, c_name AS name, 40.5::DOUBLE + ((c_custkey * 7919) % 11000) / 1000.0::DOUBLE AS lat,
         -6.0::DOUBLE + ((c_custkey * 6151) % 17000) / 1000.0::DOUBLE AS lon,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal)::BIGINT END AS population
  FROM customer)"""
FOLDED = """places AS (
  SELECT c_custkey AS place_ord, c_name AS name, 42.0::DOUBLE + (c_custkey % 5) * 1.5::DOUBLE AS lat, -3.0::DOUBLE + (c_custkey % 5) * 2.5::DOUBLE AS lon
  FROM customer)"""
CONTROL = """control AS (
  SELECT s_suppkey AS point, 40.5::DOUBLE + ((s_suppkey * 7919) % 11000) / 1000.0::DOUBLE AS lat,
         -6.0::DOUBLE + ((s_suppkey * 6151) % 17000) / 1000.0::DOUBLE AS lon, (1 + s_suppkey % 9)::INT AS expected_bortle
  FROM supplier)"""
BOXES = """boxes AS (
  SELECT c_nationkey AS nation, min(-6.0::DOUBLE + ((c_custkey * 6151) % 17000) / 1000.0::DOUBLE) AS lon_min,
         min(40.5::DOUBLE + ((c_custkey * 7919) % 11000) / 1000.0::DOUBLE) AS lat_min,
         max(-6.0::DOUBLE + ((c_custkey * 6151) % 17000) / 1000.0::DOUBLE) AS lon_max,
         max(40.5::DOUBLE + ((c_custkey * 7919) % 11000) / 1000.0::DOUBLE) AS lat_max
  FROM customer GROUP BY 1)"""

WITHIN = f"""within AS MATERIALIZED (
  SELECT p.place_ord, p.lat, p.lon, (count(k.cand_ord) FILTER (WHERE {km("p.lat", "p.lon", "k.lat", "k.lon")} <= {COVER_KM}))::BIGINT AS within
  FROM places p LEFT JOIN kept k ON abs(p.lat - k.lat) < {COVER_KM / 111.0!r}
  GROUP BY 1, 2, 3),
short AS (SELECT place_ord, lat, lon, within, ({MIN_SPOTS} - within)::INT AS need FROM within WHERE within < {MIN_SPOTS})"""
POOL = f"""pool AS MATERIALIZED (
  SELECT s.place_ord, s.need, m.cand_ord, row_number() OVER (PARTITION BY s.place_ord ORDER BY m.darkness DESC, m.cand_ord) AS rnk
  FROM short s JOIN mesh m ON abs(s.lat - m.lat) < {COVER_KM / 111.0!r}
  WHERE m.cand_ord NOT IN (SELECT cand_ord FROM kept) AND {km("s.lat", "s.lon", "m.lat", "m.lon")} <= {COVER_KM})"""
# one place after the other, with the points taken so far in a list
SERVE = """queue AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY place_ord) AS turn, place_ord, any_value(need) AS need, list(cand_ord ORDER BY rnk) AS wishes
  FROM pool GROUP BY place_ord),
serve AS (
  SELECT 0::BIGINT AS turn, []::BIGINT[] AS taken, -1::BIGINT AS place_ord, []::BIGINT[] AS picks
  UNION ALL
  SELECT q.turn, list_concat(s.taken, p.picks), q.place_ord, p.picks
  FROM serve s JOIN queue q ON q.turn = s.turn + 1,
  LATERAL (SELECT list_filter(q.wishes, lambda x: NOT list_contains(s.taken, x))
                  [1:greatest(q.need - len(list_filter(q.wishes, lambda x: list_contains(s.taken, x))), 0)] AS picks) p),
added AS (SELECT unnest(picks) AS cand_ord, place_ord AS added_by FROM serve),
covered AS (
  SELECT kept.*, -1::BIGINT AS added_by FROM kept
  UNION ALL
  SELECT mesh.*, added.added_by FROM mesh JOIN added USING (cand_ord))"""


def tile(lat: str, lon: str) -> str:
    return f"printf('%s%03d%s%03d', CASE WHEN {lat} >= 0 THEN 'N' ELSE 'S' END, abs(floor({lat}))::INT, CASE WHEN {lon} >= 0 THEN 'E' ELSE 'W' END, abs(floor({lon}))::INT)"


def spot(lat: str, lon: str) -> str:
    return f"printf('%.4f_%.4f', {lat} + 0.0::DOUBLE, {lon} + 0.0::DOUBLE)"


def _nearest(spots: str, limit: float | None) -> str:
    dist = km("s.lat", "s.lon", "p.lat", "p.lon")
    on = "true" if limit is None else f"abs(s.lat - p.lat) < {limit / 111.0!r}"
    where = "" if limit is None else f"WHERE {dist} <= {limit}"
    return f"""closest AS (
  SELECT s.cand_ord, arg_min(p.name, struct_pack(d := {dist}, o := p.place_ord)) AS name
  FROM {spots} s JOIN places p ON {on} {where} GROUP BY 1),
named AS (SELECT s.*, coalesce(c.name, '') AS near FROM {spots} s LEFT JOIN closest c USING (cand_ord))"""


def _box_places(margin_km: float) -> str:
    lon_min, lat_min, lon_max, lat_max = t.BOX.bbox
    d_lat = margin_km / K.BBOX_KM_PER_DEG
    d_lon = d_lat / math.cos(math.radians((lat_min + lat_max) / 2.0))
    return f"lat BETWEEN {lat_min - d_lat!r} AND {lat_max + d_lat!r} AND lon BETWEEN {lon_min - d_lon!r} AND {lon_max + d_lon!r}"


def _enumerated(source: str, keep: str) -> str:
    lat = "(floor(lat_min)::INT + i)"
    lon = "(floor(lon_min)::INT + j)"
    return f"""SELECT {keep} {tile(lat, lon)} AS tile FROM {source},
  LATERAL (SELECT unnest(range(0, floor(lat_max)::INT - floor(lat_min)::INT)) AS i),
  LATERAL (SELECT unnest(range(0, floor(lon_max)::INT - floor(lon_min)::INT)) AS j)"""


def _snapshot(name: str, left_out: int, bump: str) -> str:
    return f"""{name}_spots AS (
  SELECT c_custkey AS k, c_custkey::VARCHAR AS id, c_custkey % 40 AS tile_no,
         ((c_custkey * 37) % 1000) / 1000.0::DOUBLE {bump} AS darkness
  FROM customer WHERE c_custkey % 10 <> {left_out}),
{name}_tiles AS (
  SELECT '2025.' || (tile_no % 12 + 1) AS version, 'T' || tile_no AS tile,
         list(struct_pack(id := id, darkness := darkness) ORDER BY k) AS spots
  FROM {name}_spots GROUP BY tile_no)"""


OLD = _snapshot("old", 0, "")
NEW = _snapshot("new", 1, "+ CASE WHEN c_custkey % 7 = 0 THEN 0.001::DOUBLE ELSE 0 END")
CHANGES = """changes AS (
  SELECT coalesce(o.tile, n.tile) AS tile,
         CASE WHEN o.tile IS NULL THEN 'added' WHEN n.tile IS NULL THEN 'removed'
              WHEN o.spots IS NOT DISTINCT FROM n.spots THEN 'same' ELSE 'modified' END AS change
  FROM old_tiles o FULL JOIN new_tiles n ON o.tile = n.tile)"""


def _version(latest: str, changed: str, year: int) -> str:
    return f"""SELECT CASE WHEN NOT changed THEN latest WHEN split_part(latest, '.', 1)::INT <> {year} THEN '{year}.1'
       ELSE '{year}.' || (split_part(latest, '.', 2)::INT + 1) END AS version, changed
FROM (SELECT ({latest}) AS latest, ({changed}) AS changed)"""


NUMERIC_MAX = "SELECT arg_max(version, split_part(version, '.', 1)::INT * 100000 + split_part(version, '.', 2)::INT) FROM old_tiles"
TEXT_MAX = "SELECT max(version) FROM old_tiles"
ANY_CHANGE = "SELECT bool_or(change <> 'same') FROM changes"


def _rings(p: AlrParams) -> str:
    edges = [float(v) for v in p.edges()]
    rows = ", ".join(f"({k}, {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for k, (lo, hi) in enumerate(zip([-1.0, *edges], edges)))
    return f"""rings AS (
  SELECT ring, lo, hi, pow((greatest(lo, 0) + hi) / 2, -({p.alpha_base} * pow((greatest(lo, 0) + hi) / 2 / {p.alpha_ref_km}, {p.alpha_exp}))) AS weight
  FROM (VALUES {rows}) AS v(ring, lo, hi))"""


def _radiance(p: AlrParams) -> str:
    return f"""radiance AS (
  SELECT o_orderkey // {COLS} AS "row", o_orderkey % {COLS} AS col,
         CASE WHEN o_totalprice / 20000.0::DOUBLE < {p.noise_floor} THEN 0 ELSE o_totalprice / 20000.0::DOUBLE END AS v
  FROM orders)"""


def _plane_rings(p: AlrParams) -> str:
    reach = int(p.max_km * 1000 / 450.0 + 1e-9)
    return f"""offsets AS MATERIALIZED (
  SELECT dy, dx, ring, weight
  FROM (SELECT y - {reach} AS dy, x - {reach} AS dx, sqrt(pow((y - {reach}) * 450.0::DOUBLE / 1000, 2) + pow((x - {reach}) * 450.0::DOUBLE / 1000, 2)) AS km
        FROM range({2 * reach + 1}) a(y), range({2 * reach + 1}) b(x)) o
  JOIN rings ON o.km > lo AND o.km <= hi),
inner_px AS (
  SELECT r."row", r.col FROM radiance r, grid g
  WHERE r."row" >= {reach} AND r."row" < g.n_rows - {reach} AND r.col >= {reach} AND r.col < {COLS - reach}),
ring_px AS (
  SELECT i."row", i.col, o.ring, any_value(o.weight) AS weight, sum(r.v) AS ring_sum
  FROM inner_px i CROSS JOIN offsets o JOIN radiance r ON r."row" = i."row" + o.dy AND r.col = i.col + o.dx
  GROUP BY 1, 2, 3)"""


def _globe_alr(p: AlrParams) -> str:
    """Every pixel against every pixel of the rows in reach, weighted by pixel area."""
    per_deg = math.pi * K.EARTH_RADIUS_KM / 180.0
    lat = "(51.0::DOUBLE + g.e * ({} + 0.5::DOUBLE))"
    half = f"floor(degrees(asin({math.sin(p.max_km / K.EARTH_RADIUS_KM)!r}::DOUBLE / cos(radians({lat.format('r.row')})))) / 0.1::DOUBLE + 1e-9)"
    up = f"floor({p.max_km}::DOUBLE / (abs(g.e) * {per_deg!r}::DOUBLE) + 1e-9)"
    area = f"cos(radians(q.lat)) * abs(0.1::DOUBLE * q.e) * {(per_deg * 1000.0 / p.work_resolution_m) ** 2!r}::DOUBLE"
    return f"""located AS MATERIALIZED (
  SELECT r."row", r.col, r.v, g.e, {lat.format('r.row')} AS lat, 0.1::DOUBLE * (r.col + 0.5::DOUBLE) AS lon,
         r."row" >= {up} AND r."row" < g.n_rows - {up} AND r.col >= {half} AND r.col < {COLS} - {half} AS inside, {up} AS up, {half} AS half
  FROM radiance r, grid g),
pairs AS (
  SELECT p."row", p.col, q.v * {area} AS v, {km("p.lat", "p.lon", "q.lat", "q.lon")} AS km
  FROM (SELECT *, unnest(range((-up)::BIGINT, (up + 1)::BIGINT)) AS dy FROM located WHERE inside) p
  JOIN located q ON q."row" = p."row" + p.dy AND q.col BETWEEN p.col - p.half AND p.col + p.half),
alr AS (
  SELECT "row", col, {p.calib_c!r}::DOUBLE * sum(v * weight) AS alr
  FROM pairs JOIN rings ON km > lo AND km <= hi GROUP BY 1, 2)"""


def _circle_alr(p: AlrParams) -> str:
    """The same around the globe: columns are neighbours over the seam as well."""
    per_deg = math.pi * K.EARTH_RADIUS_KM / 180.0
    lat = "(60.0::DOUBLE + c.e * ({} + 0.5::DOUBLE))"
    half = f"floor(degrees(asin({math.sin(p.max_km / K.EARTH_RADIUS_KM)!r}::DOUBLE / cos(radians({lat.format('r.row')})))) / 2.4::DOUBLE + 1e-9)"
    up = f"floor({p.max_km}::DOUBLE / (abs(c.e) * {per_deg!r}::DOUBLE) + 1e-9)"
    area = f"cos(radians(q.lat)) * abs(2.4::DOUBLE * q.e) * {(per_deg * 1000.0 / p.work_resolution_m) ** 2!r}::DOUBLE"
    return f"""circle AS (SELECT n_rows, -120.0::DOUBLE / n_rows AS e FROM grid),
located AS MATERIALIZED (
  SELECT r."row", r.col, r.v, c.e, {lat.format('r.row')} AS lat, 2.4::DOUBLE * (r.col + 0.5::DOUBLE) AS lon,
         r."row" >= {up} AND r."row" < c.n_rows - {up} AS inside, {up}::BIGINT AS up, {half}::BIGINT AS half
  FROM radiance r, circle c),
sides AS (SELECT *, unnest(range(-half, half + 1)) AS dx FROM located WHERE inside),
pairs AS (
  SELECT p."row", p.col, q.v * {area} AS v, {km("p.lat", "p.lon", "q.lat", "q.lon")} AS km
  FROM (SELECT *, unnest(range(-up, up + 1)) AS dy FROM sides) p
  JOIN located q ON q."row" = p."row" + p.dy AND q.col = (p.col + p.dx + {COLS}) % {COLS}),
alr AS (
  SELECT "row", col, {p.calib_c!r}::DOUBLE * sum(v * weight) AS alr
  FROM pairs JOIN rings ON km > lo AND km <= hi GROUP BY 1, 2)"""


def _candidates(mesh_km: float, pick: str = "min", tied: bool = False) -> list[str]:
    return [GRID, _pixels(tied), SCORED, _mesh(mesh_km, pick)]


CAND_ROWS = 'SELECT cand_ord, round(lat, 6) AS lat, round(lon, 6) AS lon, round(darkness, 6) AS darkness, "row", col, bortle FROM mesh'
THINNED = "SELECT cand_ord, round(darkness, 6) AS darkness, bortle FROM kept"
COVER = [*_candidates(MESH_COVER), _edges(), THIN, PLACES, WITHIN]
SAMPLED = [GRID, _pixels(), SCORED, CONTROL, """sampled AS (
  SELECT c.lat, c.lon, c.expected_bortle, coalesce(s.bortle, 9)::INT AS got_bortle, s.darkness AS got_darkness,
         abs(coalesce(s.bortle, 9) - c.expected_bortle) <= 1 AS "match"
  FROM (SELECT c.*, floor((c.lat - 51.0::DOUBLE) / g.e)::INT AS r, floor((c.lon + 5.0::DOUBLE) / 0.1::DOUBLE)::INT AS k FROM control c, grid g) c
  LEFT JOIN scored s ON s."row" = c.r AND s.col = c.k)"""]

NIGHT = """night AS (
  SELECT *, CASE WHEN cloud IS NULL THEN 1.0::DOUBLE ELSE pow(1.0::DOUBLE - cloud, 2) END AS weather,
         CASE WHEN moon_deg < 0 THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - moon_lit END AS moon,
         CASE WHEN sun_deg <= -18 THEN 1.0::DOUBLE WHEN sun_deg < -12 THEN 1.0::DOUBLE - (sun_deg + 18) / 6.0::DOUBLE * 0.6::DOUBLE
              ELSE greatest((-6 - sun_deg) / 6.0::DOUBLE * 0.4::DOUBLE, 0) END AS twilight,
         coalesce(darkness, (9 - bortle) / 8.0::DOUBLE) AS dark
  FROM scored JOIN (
    SELECT (o_orderkey // 150)::INT AS "row", (o_orderkey % 150)::INT AS col,
           CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey * 37 % 101) / 100.0::DOUBLE END AS cloud, (o_orderkey * 53 % 121) - 60 AS moon_deg,
           (o_orderkey * 29 % 101) / 100.0::DOUBLE AS moon_lit, (o_orderkey * 31 % 300) / 10.0::DOUBLE - 25.0::DOUBLE AS sun_deg
    FROM orders) USING ("row", col))"""

# queries that take another route to the same rows
SAME_ROWS = {
    "alr_from_segments": "alr_blocked",
    "redundancy_edges_crowded": "redundancy_edges",
    "redundancy_filter_strips": "redundancy_filter",
    "redundancy_filter_ties_strips": "redundancy_filter_ties",
    "redundancy_filter_crowds": "redundancy_filter",
    "within_radius_counts_hot": "within_radius_counts",
    "snapshot_roundtrip": "tile_envelopes",
    "publish_replaced": "tile_envelopes",
    "debug_raster_stored": "debug_raster",
    "tile_changes_digests": "tile_changes",
    "new_version_digests": "new_version",
    "spots_in_radius_stored": "spots_in_radius",
}

LON_MIN, LAT_MIN, LON_MAX, LAT_MAX = t.BOX.bbox


def oracle_sql() -> dict[str, str]:
    dark = "round(darkness, 6) AS darkness"
    boxed_places = PLACES.replace("places AS", "every_place AS"), f"places AS (SELECT * FROM every_place WHERE {_box_places(K.BBOX_MARGIN_KM)})"
    sql = {
        "darkness_bortle": with_(_pixels(), SCORED) + f' SELECT "row", col, {dark}, bortle FROM scored',
        "bortle_histogram": with_(_pixels(), SCORED) + " SELECT bortle, count(*) AS pixels FROM scored GROUP BY 1",
        "debug_raster": with_(_pixels(), SCORED)
        + ' SELECT "row", col, round(darkness::FLOAT::DOUBLE, 4) AS darkness, bortle::FLOAT AS bortle FROM scored',
        "mesh_minima": with_(*_candidates(MESH_COARSE)) + CAND_ROWS,
        "mesh_darkest": with_(*_candidates(MESH_COARSE, "max")) + CAND_ROWS,
        "redundancy_edges": with_(*_candidates(MESH_FINE), _edges()) + " SELECT first_ord, second_ord, round(km, 6) AS km FROM edges",
        "redundancy_filter": with_(*_candidates(MESH_FINE), _edges(), THIN) + THINNED,
        "redundancy_filter_ties": with_(*_candidates(MESH_FINE, tied=True), _edges(), THIN) + THINNED,
        "haversine_to_centre": with_(PLACES) + f" SELECT place_ord, round({km('lat', 'lon', '46.0::DOUBLE', '2.5::DOUBLE')}, 6) AS km FROM places",
        "places_in_bbox": with_(PLACES)
        + f" SELECT place_ord, name, round(lat, 6) AS lat, round(lon, 6) AS lon, population FROM places WHERE {_box_places(BOX_MARGIN_KM)}",
        "geonames_parse": with_(PLACES)
        + " SELECT place_ord, name, round(lat, 6) AS lat, round(lon, 6) AS lon, population FROM places WHERE place_ord % 13 <> 0 AND place_ord % 11 <> 0",
        "places_scan": with_(PLACES, "numbered AS (SELECT *, place_ord AS k, row_number() OVER (ORDER BY place_ord) - 1 AS line FROM places)")
        + f""" SELECT line AS place_ord, CASE WHEN k % 17 = 0 THEN '' ELSE name END AS name, round(lat, 6) AS lat, round(lon, 6) AS lon, population
FROM numbered WHERE k % 13 <> 0 AND k % 11 <> 0 AND {_box_places(K.BBOX_MARGIN_KM)}""",
        "regions_scan": with_(BOXES)
        + """ SELECT 'n' || nation AS region, 'Nation ' || nation AS name, round(lon_min, 6) AS lon_min, round(lat_min, 6) AS lat_min,
  round(lon_max, 6) AS lon_max, round(lat_max, 6) AS lat_max, 3035::INT AS equal_area_epsg, (nation % 10)::INT AS admin_level, 'FR' AS osm_country_code FROM boxes""",
        "control_points_scan": with_(CONTROL)
        + " SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, expected_bortle, NULL::VARCHAR AS name FROM control",
        "validation_results": with_(*SAMPLED)
        + """ SELECT run_id, round(lat, 6) AS lat, round(lon, 6) AS lon, expected_bortle, got_bortle, "match" FROM sampled, (VALUES ('a'), ('b')) r(run_id)""",
        "nearest_place_kept": with_(*_candidates(MESH_FINE), PLACES, _nearest("mesh", K.MAX_NEAR_DISTANCE_KM))
        + """ SELECT cand_ord, CASE WHEN cand_ord % 3 = 0 AND cand_ord % 2 = 0 THEN '' WHEN cand_ord % 3 = 0 THEN 'known'
  WHEN cand_ord % 4 = 0 THEN '' ELSE near END AS near FROM named""",
        "nearest_place": with_(*_candidates(MESH_FINE), PLACES, _nearest("mesh", K.MAX_NEAR_DISTANCE_KM)) + " SELECT cand_ord, near FROM named",
        "nearest_place_unbounded": with_(*_candidates(MESH_COARSE), PLACES, _nearest("mesh", None)) + " SELECT cand_ord, near FROM named",
        "within_radius_counts": with_(*COVER) + " SELECT place_ord, within FROM within",
        "coverage_deficit": with_(*COVER) + " SELECT place_ord, within, need FROM short",
        "coverage_pool_topk": with_(*COVER, POOL) + " SELECT place_ord, cand_ord, rnk::INT AS rnk FROM pool WHERE rnk <= need",
        "ensure_coverage": with_(*COVER, POOL, SERVE) + " SELECT cand_ord, added_by, bortle FROM covered",
        "spot_ids": with_(GRID, _pixels())
        + f""" SELECT "row", col, {spot('(51.0::DOUBLE + e * ("row" + 0.5::DOUBLE))', '(-5.0::DOUBLE + 0.1::DOUBLE * (col + 0.5::DOUBLE))')} AS id FROM pixels, grid""",
        "tile_ids": with_(PLACES)
        + f" SELECT place_ord, 0::INT AS mirrored, {tile('lat', 'lon')} AS tile FROM places UNION ALL SELECT place_ord, 1::INT, {tile('(-lat)', '(-lon)')} FROM places",
        "tile_counts": with_(*_candidates(MESH_COARSE)) + f" SELECT {tile('lat', 'lon')} AS tile, count(*) AS spots FROM mesh GROUP BY 1",
        "tile_bounds": with_(PLACES)
        + f" SELECT DISTINCT {tile('lat', 'lon')} AS tile, floor(lat) AS lat_min, floor(lon) AS lon_min, floor(lat) + 1 AS lat_max, floor(lon) + 1 AS lon_max FROM places",
        "tile_enumerate": with_(BOXES) + " " + _enumerated("boxes", "nation,"),
        "empty_tiles": with_(
            PLACES,
            BOXES,
            "wide AS (SELECT min(lon_min) - 2 AS lon_min, min(lat_min) - 2 AS lat_min, max(lon_max) + 2 AS lon_max, max(lat_max) + 2 AS lat_max FROM boxes)",
        )
        + f" SELECT tile FROM ({_enumerated('wide', '')}) WHERE tile NOT IN (SELECT {tile('lat', 'lon')} FROM places)",
        "tile_envelopes": with_(
            *_candidates(MESH_COARSE),
            BOXES,
            f"clipped AS (SELECT greatest(min(lon_min), {LON_MIN}) AS lon_min, greatest(min(lat_min), {LAT_MIN}) AS lat_min, least(max(lon_max), {LON_MAX}) AS lon_max, least(max(lat_max), {LAT_MAX}) AS lat_max FROM boxes)",
            f"placed AS (SELECT {tile('lat', 'lon')} AS tile, {spot('lat', 'lon')} AS id, * FROM mesh)",
            f"all_tiles AS (SELECT tile FROM placed UNION SELECT tile FROM ({_enumerated('clipped', '')}))",
        )
        + """ SELECT '2025.1' AS version, 'VIIRS/2025/france' AS source, '2026-01-01T00:00:00Z' AS generated, a.tile,
  CASE WHEN id IS NOT NULL THEN (row_number() OVER (PARTITION BY a.tile ORDER BY darkness DESC, cand_ord) - 1)::INT END AS pos,
  id, round(darkness, 6) AS darkness, bortle, NULL::DOUBLE AS altitude
FROM all_tiles a LEFT JOIN placed USING (tile)""",
        "spot_diff": with_(OLD, NEW)
        + """ SELECT added + removed + modified > 0 AS changed, added, removed, modified FROM (
  SELECT count(*) FILTER (WHERE o.id IS NULL) AS added, count(*) FILTER (WHERE n.id IS NULL) AS removed,
         count(*) FILTER (WHERE o.darkness <> n.darkness) AS modified
  FROM old_spots o FULL JOIN new_spots n ON o.id = n.id)""",
        "tile_changes": with_(OLD, NEW, CHANGES) + " SELECT tile, change FROM changes",
        "new_version": with_(OLD, NEW, CHANGES) + _version(NUMERIC_MAX, ANY_CHANGE, 2025),
        "new_version_as_text": with_(OLD, NEW, CHANGES) + _version(TEXT_MAX, ANY_CHANGE, 2025),
        "new_version_unchanged": with_(OLD) + _version(NUMERIC_MAX, "SELECT false", 2026),
        "current_version": with_(OLD) + f" SELECT ({NUMERIC_MAX}) AS version",
        "version_bump": with_(OLD, NEW, CHANGES)
        + """ SELECT tile, CASE WHEN change <> 'same' THEN split_part(version, '.', 1) || '.' || (split_part(version, '.', 2)::INT + 1) ELSE version END AS version
FROM old_tiles JOIN changes USING (tile)""",
        "alr_blocked": with_(
            GRID, _radiance(ALR_QUERY), _rings(ALR_QUERY), _plane_rings(ALR_QUERY),
            f'alr AS (SELECT "row", col, {ALR_QUERY.calib_c!r}::DOUBLE * sum(weight * ring_sum) AS alr FROM ring_px GROUP BY 1, 2)',
        )
        + ' SELECT r."row"::INT AS "row", r.col::INT AS col, round(a.alr, 6) AS alr FROM radiance r LEFT JOIN alr a USING ("row", col)',
        "alr_latlon": with_(GRID, _radiance(ALR_GEO_QUERY), _rings(ALR_GEO_QUERY), _globe_alr(ALR_GEO_QUERY))
        + ' SELECT r."row"::INT AS "row", r.col::INT AS col, round(a.alr, 6) AS alr FROM radiance r LEFT JOIN alr a USING ("row", col)',
        "alr_full_circle": with_(GRID, _radiance(ALR_CIRCLE_QUERY), _rings(ALR_CIRCLE_QUERY), _circle_alr(ALR_CIRCLE_QUERY))
        + ' SELECT r."row"::INT AS "row", r.col::INT AS col, round(a.alr, 6) AS alr FROM radiance r LEFT JOIN alr a USING ("row", col)',
        "alr_ring_sums": with_(GRID, _radiance(ALR_QUERY), _rings(ALR_QUERY), _plane_rings(ALR_QUERY))
        + ' SELECT "row"::INT AS "row", col::INT AS col, ring::INT AS ring, round(ring_sum, 7) AS ring_sum FROM ring_px',
        "validate_bortle": with_(*SAMPLED)
        + ' SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, expected_bortle, got_bortle, round(got_darkness, 6) AS got_darkness, "match" FROM sampled',
        "validation_summary": with_(*SAMPLED)
        + """ SELECT count(*) AS points, round(avg("match"::INT), 6) AS match_share, count(*) FILTER (WHERE got_bortle = expected_bortle) AS exact,
  round(avg(got_bortle - expected_bortle), 6) AS mean_delta FROM sampled""",
        "spots_in_radius": with_(*_candidates(MESH_COARSE), CONTROL)
        + f""" SELECT point, rnk::INT AS rnk, id, round(km, 6) AS km FROM (
  SELECT *, row_number() OVER (PARTITION BY point ORDER BY darkness DESC, id) AS rnk FROM (
    SELECT c.point, m.darkness, {spot('m.lat', 'm.lon')} AS id, {km('c.lat', 'c.lon', 'm.lat', 'm.lon')} AS km FROM control c, mesh m)
  WHERE km <= 75) WHERE rnk <= 20""",
        "tile_neighbours": with_(PLACES)
        + f""" SELECT place_ord, {tile('(floor(lat) + dy)', '(floor(lon) + dx)')} AS tile, dy = 0 AND dx = 0 AS own
FROM places, (VALUES (-1), (0), (1)) a(dy), (VALUES (-1), (0), (1)) b(dx)""",
        "night_scores": with_(_pixels(), SCORED, NIGHT)
        + """ SELECT "row", col, floor(dark * moon * twilight * weather * 10 + 0.5)::INT AS score, round(dark * moon * twilight * weather, 6) AS raw,
  cloud IS NULL AS weather_missing,
  CASE WHEN least(weather, moon, twilight) >= 0.8::DOUBLE THEN 'ideal' WHEN weather = least(weather, moon, twilight) THEN 'clouds'
       WHEN moon = least(weather, moon, twilight) THEN 'moon' ELSE 'twilight' END AS limiting FROM night""",
        "weather_freshness": """SELECT event_id, CASE WHEN epoch_us(now) - epoch_us(ts) <= 3 * 3600000000 THEN 'fresh'
  WHEN epoch_us(now) - epoch_us(ts) <= 12 * 3600000000 THEN 'aged' ELSE 'stale' END AS age
FROM events JOIN (SELECT user_id, max(ts) AS now FROM events GROUP BY 1) USING (user_id)""",
        "nearest_place_hot": with_(*_candidates(MESH_FINE), FOLDED)
        + f""" SELECT cand_ord, place_ord, round(km, 6) AS km FROM (
  SELECT s.cand_ord, p.place_ord, {km("s.lat", "s.lon", "p.lat", "p.lon")} AS km FROM mesh s JOIN places p ON abs(s.lat - p.lat) < {K.MAX_NEAR_DISTANCE_KM / 111.0!r})
WHERE km <= {K.MAX_NEAR_DISTANCE_KM} QUALIFY row_number() OVER (PARTITION BY cand_ord ORDER BY km, place_ord) = 1""",
        "top_points_hot": with_(*_candidates(MESH_FINE), PLACES)
        + f""" SELECT place_ord, cand_ord, rnk::INT AS rnk FROM (
  SELECT p.place_ord, m.cand_ord, row_number() OVER (PARTITION BY p.place_ord ORDER BY m.darkness DESC, m.cand_ord) AS rnk
  FROM places p JOIN mesh m ON abs(p.lat - m.lat) < {COVER_KM / 111.0!r} WHERE {km("p.lat", "p.lon", "m.lat", "m.lon")} <= {COVER_KM})
WHERE rnk <= {MIN_SPOTS}""",
        "ensure_coverage_from_none": with_(
            *_candidates(MESH_COVER), "kept AS (SELECT * FROM mesh WHERE false)", PLACES,
            "short AS (SELECT place_ord, lat, lon, 2 AS need FROM places)", POOL, SERVE,
        )
        + " SELECT cand_ord, added_by, bortle FROM covered",
        "alr_from_rings": with_(GRID, _radiance(ALR_QUERY), _rings(ALR_QUERY), _plane_rings(ALR_QUERY))
        + f' SELECT "row"::INT AS "row", col::INT AS col, round({ALR_QUERY.calib_c!r}::DOUBLE * sum(weight * ring_sum), 6) AS alr FROM ring_px GROUP BY 1, 2',
        "annual_release": with_(
            GRID, _radiance(ALR_GEO_QUERY), _rings(ALR_GEO_QUERY), _globe_alr(ALR_GEO_QUERY),
            """pixels AS MATERIALIZED (
  SELECT r."row"::INT AS "row", r.col::INT AS col, coalesce(a.alr, 'NaN'::DOUBLE) AS alr FROM radiance r LEFT JOIN alr a USING ("row", col))""",
            SCORED, _mesh(MESH_COVER), _edges(), THIN, *boxed_places, WITHIN, POOL, SERVE, _nearest("covered", K.MAX_NEAR_DISTANCE_KM),
            f"placed AS (SELECT {tile('lat', 'lon')} AS tile, {spot('lat', 'lon')} AS id, * FROM named)",
            f"box AS (SELECT {LON_MIN} AS lon_min, {LAT_MIN} AS lat_min, {LON_MAX} AS lon_max, {LAT_MAX} AS lat_max)",
            f"all_tiles AS (SELECT tile FROM placed UNION SELECT tile FROM ({_enumerated('box', '')}))",
        )
        + """ SELECT '2025.13' AS version, 'VIIRS/2025/france' AS source, '2026-01-01T00:00:00Z' AS generated, a.tile,
  CASE WHEN id IS NOT NULL THEN (row_number() OVER (PARTITION BY a.tile ORDER BY added_by, darkness DESC, cand_ord) - 1)::INT END AS pos,
  id, round(darkness, 6) AS darkness, bortle, NULL::DOUBLE AS altitude, true AS changed
FROM all_tiles a LEFT JOIN placed USING (tile)""",
        "annual_sites": with_(
            *_candidates(MESH_COVER), _edges(), THIN, *boxed_places,
            WITHIN, POOL, SERVE, _nearest("covered", K.MAX_NEAR_DISTANCE_KM),
        )
        + f" SELECT {tile('lat', 'lon')} AS tile, {spot('lat', 'lon')} AS id, {dark}, bortle, near, added_by FROM named",
    }
    published = sql["tile_envelopes"]
    older = "a.tile LIKE 'N045%' OR (a.tile LIKE 'N044%' AND id IS NOT NULL)"
    sql["publish_changed"] = published.replace(
        "'2025.1' AS version", f"CASE WHEN {older} THEN '2025.1' ELSE '2024.7' END AS version"
    ).replace("'2026-01-01T00:00:00Z' AS generated", f"CASE WHEN {older} THEN '2026-01-01T00:00:00Z' ELSE '2024-12-01T00:00:00Z' END AS generated")
    sql["tolerant_tiles"] = published + " WHERE a.tile NOT LIKE 'N045%'"
    sql["missing_tiles_written"] = published.replace("'2025.1' AS version", "CASE WHEN a.tile LIKE 'N045%' THEN '2025.1' ELSE '2024.7' END AS version")
    for same, of in SAME_ROWS.items():
        sql[same] = sql[of]
    return sql
