"""The registered queries: each takes the session and a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from noctule import constants as K
from noctule.catalog import tables as t
from noctule.functions import bump_version, haversine_km, spot_id, tile_bounds, tile_id
from noctule.functions.night import (
    darkness_or_bortle,
    limiting_factor,
    moon_factor,
    night_score,
    twilight_factor,
    weather_age,
)
from noctule.operators.alr import AlrParams, compute_alr, ring_sums, weigh_rings
from noctule.operators.coverage import (
    attach_nearest_place,
    coverage_deficit,
    coverage_pool,
    ensure_coverage,
)
from noctule.model import ENVELOPE
from noctule.operators.proximity import count_within, nearest_within, top_within
from noctule.operators.raster import bortle_histogram as histogram
from noctule.operators.raster import debug_raster as debug_export
from noctule.operators.raster import mesh_minima as mesh
from noctule.operators.raster import score_pixels
from noctule.operators.release import current_version, spot_diff, tile_changes, with_digest
from noctule.operators.release import new_version as next_version
from noctule.operators.search import spots_around, stored_spots_around, tiles_around, write_spots
from noctule.operators.thinning import redundancy_edges as edges
from noctule.operators.thinning import redundancy_filter as thin
from noctule.operators.tiles import (
    empty_tiles,
    enrich,
    enumerate_tiles,
    envelopes,
    tile_arrays,
    tile_counts,
    with_empty_tiles,
)
from noctule.operators.validation import validate_bortle as validate
from noctule.operators.validation import validation_summary as summarize
from noctule.plans.annual import SiteParams, build_release, select_sites
from noctule.runtime import materialize, scratch_dir
from noctule.sinks.tables import append_results, write_debug_raster
from noctule.sinks.tile_json import publish_changes, publish_tiles, write_missing_tiles, write_tiles
from noctule.sources.control_points import read_control_points
from noctule.sources.places import bbox_filter, load_places, parse_places
from noctule.sources.rasters import read_segments, write_segments
from noctule.sources.regions import load_regions, regions_frame
from noctule.sources.snapshots import read_digests, read_snapshot, read_tiles

GENERATED = "2026-01-01T00:00:00Z"
# test parameters that exercise every branch on the given tables
MESH_COARSE, MESH_COVER, MESH_FINE = 50, 20, 5
COVER_KM, MIN_SPOTS = 30, 4
BOX_MARGIN_KM = 10
ALR_QUERY = AlrParams(max_km=9.1, rings=12, noise_floor=0.5)
ALR_GEO_QUERY = AlrParams(max_km=40.0, rings=8, noise_floor=0.5)
ALR_CIRCLE_QUERY = AlrParams(max_km=700.0, rings=8, noise_floor=0.5)


def r6(name: str) -> Column:
    return F.round(name, 6).alias(name)


# so small that the given tables fill many groups, blocks and cells: what a large raster does at the usual sizes
BLOCK_PX, SEGMENT_PX, GEO_BLOCK_ROWS, GROUPS = 16, 16, 20, 120
HOT_ROWS, CROWD = 20, 200


def no_nan(name: str) -> Column:
    return F.when(~F.isnan(name), F.round(name, 6)).alias(name)


def scored(spark: SparkSession, d: str) -> DataFrame:
    return score_pixels(t.pixels(spark, d))


def candidates(spark: SparkSession, d: str, mesh_km: float, pick: str = "min", tied: bool = False) -> DataFrame:
    source = t.tied_pixels if tied else t.pixels
    return mesh(score_pixels(source(spark, d)), t.grid(spark, d), mesh_km, pick, unit_darkness=True)


def cover_input(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Thinned sites and all candidates of the 20 km mesh, each computed once."""
    all_points = materialize(candidates(spark, d, MESH_COVER), "mesh")
    return materialize(thin(all_points), "kept"), all_points


def darkness_bortle(spark, d):
    return scored(spark, d).select("row", "col", no_nan("darkness"), "bortle")


def bortle_histogram(spark, d):
    return histogram(scored(spark, d))


def debug_raster(spark, d):
    out = debug_export(scored(spark, d))
    return out.select("row", "col", F.when(~F.isnan("darkness"), F.round(F.col("darkness").cast("double"), 4)).alias("darkness"), "bortle")


def _candidate_rows(df):
    return df.select("cand_ord", r6("lat"), r6("lon"), r6("darkness"), "row", "col", "bortle")


def mesh_minima(spark, d):
    return _candidate_rows(candidates(spark, d, MESH_COARSE))


def mesh_darkest(spark, d):
    return _candidate_rows(candidates(spark, d, MESH_COARSE, "max"))


def redundancy_edges(spark, d):
    return edges(materialize(candidates(spark, d, MESH_FINE), "mesh")).select("first_ord", "second_ord", r6("km"))


def redundancy_filter(spark, d):
    return thin(materialize(candidates(spark, d, MESH_FINE), "mesh")).select("cand_ord", r6("darkness"), "bortle")


def redundancy_filter_ties(spark, d):
    return thin(materialize(candidates(spark, d, MESH_FINE, tied=True), "mesh")).select("cand_ord", r6("darkness"), "bortle")


def redundancy_edges_crowded(spark, d):
    """Edges with every cell of more than 200 candidates dealt into salts."""
    return edges(materialize(candidates(spark, d, MESH_FINE), "mesh"), crowd=CROWD).select("first_ord", "second_ord", r6("km"))


def _in_strips(points):
    return thin(points, group_rows=max(1, points.count() // GROUPS)).select("cand_ord", r6("darkness"), "bortle")


def redundancy_filter_strips(spark, d):
    """Thinning in about 120 groups over all classes, which wait for each other round by round."""
    return _in_strips(materialize(candidates(spark, d, MESH_FINE), "mesh"))


def redundancy_filter_ties_strips(spark, d):
    return _in_strips(materialize(candidates(spark, d, MESH_FINE, tied=True), "mesh"))


def redundancy_filter_crowds(spark, d):
    """Thinning that settles every sub-cell of more than two candidates of a class by aggregates."""
    points = materialize(candidates(spark, d, MESH_FINE), "mesh")
    return thin(points, crowd_rows=2).select("cand_ord", r6("darkness"), "bortle")


def haversine_to_centre(spark, d):
    km = haversine_km(F.col("lat"), F.col("lon"), F.lit(46.0), F.lit(2.5))
    return t.places(spark, d).select("place_ord", F.round(km, 6).alias("km"))


def places_in_bbox(spark, d):
    return bbox_filter(t.places(spark, d), t.BOX, BOX_MARGIN_KM).select("place_ord", "name", r6("lat"), r6("lon"), "population")


def geonames_parse(spark, d):
    return parse_places(t.gazetteer_lines(spark, d)).select("place_ord", "name", r6("lat"), r6("lon"), "population")


def nearest_place(spark, d):
    return attach_nearest_place(materialize(candidates(spark, d, MESH_FINE), "mesh"), t.places(spark, d)).select("cand_ord", "near")


def nearest_place_unbounded(spark, d):
    return attach_nearest_place(materialize(candidates(spark, d, MESH_COARSE), "mesh"), t.places(spark, d), None).select("cand_ord", "near")


def within_radius_counts(spark, d):
    kept, _ = cover_input(spark, d)
    return count_within(t.places(spark, d), kept, COVER_KM, "place_ord").select("place_ord", "within")


def within_radius_counts_hot(spark, d):
    """Counts with every cell of more than 20 sites split into nested cells."""
    kept, _ = cover_input(spark, d)
    return count_within(t.places(spark, d), kept, COVER_KM, "place_ord", HOT_ROWS).select("place_ord", "within")


def nearest_place_hot(spark, d):
    """Nearest of places of which a fifth lie at each of five locations."""
    spots = materialize(candidates(spark, d, MESH_FINE), "mesh")
    found = nearest_within(spots, t.folded_places(spark, d), K.MAX_NEAR_DISTANCE_KM, "cand_ord", "place_ord", HOT_ROWS)
    return found.select("cand_ord", F.col("p_place_ord").alias("place_ord"), r6("km"))


def top_points_hot(spark, d):
    """The darkest points around every place, from nested cells."""
    points = materialize(candidates(spark, d, MESH_FINE), "mesh")
    order = (("darkness", "desc"), ("cand_ord", "asc"))
    top = top_within(t.places(spark, d).select("place_ord", "lat", "lon"), points, COVER_KM, MIN_SPOTS, "place_ord", order, HOT_ROWS)
    return top.select(F.col("q_place_ord").alias("place_ord"), F.col("p_cand_ord").alias("cand_ord"), F.col("rnk").cast("int").alias("rnk"))


def coverage_deficit_places(spark, d):
    kept, _ = cover_input(spark, d)
    return coverage_deficit(kept, t.places(spark, d), MIN_SPOTS, COVER_KM).select("place_ord", "within", "need")


def coverage_pool_topk(spark, d):
    kept, points = cover_input(spark, d)
    return coverage_pool(kept, points, t.places(spark, d), MIN_SPOTS, COVER_KM).select("place_ord", "cand_ord", F.col("rnk").cast("int").alias("rnk"))


def ensure_coverage_sites(spark, d):
    kept, points = cover_input(spark, d)
    return ensure_coverage(kept, points, t.places(spark, d), MIN_SPOTS, COVER_KM).select("cand_ord", "added_by", "bortle")


def ensure_coverage_from_none(spark, d):
    """Coverage without any thinned site, so that all places compete for points."""
    points = materialize(candidates(spark, d, MESH_COVER), "mesh")
    covered = ensure_coverage(points.limit(0), points, t.places(spark, d), 2, COVER_KM)
    return covered.select("cand_ord", "added_by", "bortle")


def spot_ids(spark, d):
    g = t.grid(spark, d)
    points = t.pixels(spark, d).select("row", "col", g.lat_of(F.col("row")).alias("lat"), g.lon_of(F.col("col")).alias("lon"))
    return points.select("row", "col", spot_id(F.col("lat"), F.col("lon")).alias("id"))


def tile_ids(spark, d):
    # mirrored places as well, so that all four hemispheres occur
    p = t.places(spark, d)
    here = p.select("place_ord", F.lit(0).alias("mirrored"), "lat", "lon")
    there = p.select("place_ord", F.lit(1).alias("mirrored"), (-F.col("lat")).alias("lat"), (-F.col("lon")).alias("lon"))
    return here.unionByName(there).select("place_ord", "mirrored", tile_id(F.col("lat"), F.col("lon")).alias("tile"))


def tile_counts_query(spark, d):
    return tile_counts(candidates(spark, d, MESH_COARSE))


def tile_bounds_query(spark, d):
    tiles = t.places(spark, d).select(tile_id(F.col("lat"), F.col("lon")).alias("tile")).distinct()
    return tiles.select("tile", tile_bounds(F.col("tile")).alias("b")).select("tile", "b.*")


def tile_enumerate(spark, d):
    return enumerate_tiles(t.place_boxes(spark, d)).select("nation", "tile")


def empty_tiles_query(spark, d):
    occupied = t.places(spark, d).select(tile_id(F.col("lat"), F.col("lon")).alias("tile"))
    boxes = t.place_boxes(spark, d).groupBy().agg(
        (F.min("lon_min") - 2).alias("lon_min"), (F.min("lat_min") - 2).alias("lat_min"),
        (F.max("lon_max") + 2).alias("lon_max"), (F.max("lat_max") + 2).alias("lat_max"),
    )
    return empty_tiles(occupied, enumerate_tiles(boxes))


def _folder(spark, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def places_scan(spark, d):
    """Places of the box from gazetteer text files, numbered by their line; every 17th has no name."""
    folder = _folder(spark, "gazetteer")
    t.nameless_lines(spark, d).orderBy("place_ord").select("value").write.text(folder)
    return load_places(spark, t.BOX, folder).select("place_ord", "name", r6("lat"), r6("lon"), "population")


def regions_scan(spark, d):
    """A settings file with one region per nation, read as a region table."""
    folder = _folder(spark, "regions")
    settings = F.struct(
        F.concat(F.lit("Nation "), F.col("nation").cast("string")).alias("name"), F.array("lon_min", "lat_min", "lon_max", "lat_max").alias("bbox"),
        F.lit(3035).alias("equal_area_epsg"), (F.col("nation") % 10).alias("admin_level"), F.lit("FR").alias("osm_country_code"),
    )
    nations = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("n"), F.col("nation").cast("string")), settings)))
    t.place_boxes(spark, d).agg(F.to_json(nations).alias("value")).write.text(folder)
    found = regions_frame(spark, load_regions(spark, folder))
    box = [F.round(F.col("bbox")[i], 6).alias(c) for i, c in enumerate(("lon_min", "lat_min", "lon_max", "lat_max"))]
    return found.select("region", "name", *box, "equal_area_epsg", "admin_level", "osm_country_code")


def control_points_scan(spark, d):
    """Control points from JSON documents of up to 100 points each."""
    folder = _folder(spark, "control")
    points = t.control_points(spark, d).select((F.col("point") / 100).cast("int").alias("doc"), F.struct("lat", "lon", "expected_bortle").alias("p"))
    docs = points.groupBy("doc").agg(F.to_json(F.collect_list("p")).alias("value"))
    docs.write.partitionBy("doc").text(folder)
    return read_control_points(spark, folder).select(r6("lat"), r6("lon"), "expected_bortle", "name")


def nearest_place_kept(spark, d):
    """Nearest places where every third site has a name already and every fourth has no coordinates."""
    k = F.col("cand_ord")
    sites = materialize(candidates(spark, d, MESH_FINE), "mesh").withColumns(
        {
            "near": F.when(k % 3 == 0, F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("known"))),
            "lat": F.when(k % 4 != 0, F.col("lat")),
        }
    )
    return attach_nearest_place(sites, t.places(spark, d)).select("cand_ord", "near")


def debug_raster_stored(spark, d):
    """The debug raster written to its folder of region and year and read back."""
    folder = _folder(spark, "debug")
    write_debug_raster(scored(spark, d), folder, "france", 2025)
    out = spark.read.parquet(folder).filter("region = 'france' AND year = 2025")
    return out.select("row", "col", F.when(~F.isnan("darkness"), F.round(F.col("darkness").cast("double"), 4)).alias("darkness"), "bortle")


def validation_results(spark, d):
    """Results of two validation runs, the first of them stored twice."""
    folder = _folder(spark, "results")
    results = materialize(_validated(spark, d), "validated")
    append_results(results.filter("expected_bortle > 4"), folder, "a")
    append_results(results, folder, "b")
    append_results(results, folder, "a")
    return spark.read.parquet(folder).select("run_id", r6("lat"), r6("lon"), "expected_bortle", "got_bortle", "match")


def _mesh_envelopes(spark, d):
    sites = enrich(candidates(spark, d, MESH_COARSE).withColumn("added_by", F.lit(-1).cast("bigint")))
    lon_min, lat_min, lon_max, lat_max = t.BOX.bbox
    box = t.place_boxes(spark, d).groupBy().agg(
        F.greatest(F.min("lon_min"), F.lit(lon_min)).alias("lon_min"), F.greatest(F.min("lat_min"), F.lit(lat_min)).alias("lat_min"),
        F.least(F.max("lon_max"), F.lit(lon_max)).alias("lon_max"), F.least(F.max("lat_max"), F.lit(lat_max)).alias("lat_max"),
    )
    return envelopes(with_empty_tiles(tile_arrays(sites), enumerate_tiles(box)), "2025.1", "VIIRS/2025/france", GENERATED)


def _flat(out):
    """One row per spot, or one for an empty tile."""
    flat = out.select("version", "source", "generated", "tile", F.posexplode_outer("spots").alias("pos", "spot"))
    return flat.select(
        "version", "source", "generated", "tile", F.col("pos").cast("int").alias("pos"),
        F.col("spot.id").alias("id"), F.round("spot.darkness", 6).alias("darkness"), F.col("spot.bortle").alias("bortle"),
        F.col("spot.altitude").alias("altitude"),
    )


def tile_envelopes(spark, d):
    """Envelopes of the 50 km mesh with the box's empty tiles."""
    return _flat(_mesh_envelopes(spark, d))


def snapshot_roundtrip(spark, d):
    """The same envelopes written as documents to the shared folder and read back."""
    folder = f"{scratch_dir(spark)}/documents-{uuid.uuid4().hex}"
    write_tiles(_mesh_envelopes(spark, d), folder)
    return _flat(read_snapshot(spark, folder))


def publish_replaced(spark, d):
    """The same envelopes published over a set of other tiles and other versions, and read back."""
    folder = f"{scratch_dir(spark)}/published-{uuid.uuid4().hex}"
    tiles = materialize(_mesh_envelopes(spark, d), "envelopes")
    older = tiles.filter(F.size("spots") > 0).withColumns({"tile": F.concat(F.lit("S"), F.substring("tile", 2, 7)), "version": F.lit("2024.7")})
    publish_tiles(older.unionByName(tiles.filter(F.size("spots") == 0)), folder)
    publish_tiles(tiles, folder)
    return _flat(read_snapshot(spark, folder))


def publish_changed(spark, d):
    """The same envelopes published as changes to a set that lacks some tiles, has others, and has some without sites."""
    folder = _folder(spark, "published")
    tiles = materialize(_mesh_envelopes(spark, d), "envelopes")
    row = F.substring("tile", 1, 4)
    none = F.array().cast(ENVELOPE["spots"].dataType)
    older = tiles.filter(row != "N045").withColumn("spots", F.when(row == "N044", none).otherwise(F.col("spots")))
    gone = tiles.filter(row == "N045").withColumn("tile", F.concat(F.lit("S"), F.substring("tile", 2, 7)))
    publish_changes(older.unionByName(gone).withColumns({"version": F.lit("2024.7"), "generated": F.lit("2024-12-01T00:00:00Z")}), folder)
    publish_changes(tiles, folder)
    return _flat(read_snapshot(spark, folder))


def tolerant_tiles(spark, d):
    """Documents of which those of a tile row name no tile: they are left out."""
    folder = _folder(spark, "documents")
    tiles = materialize(_mesh_envelopes(spark, d), "envelopes")
    nameless = tiles.filter(F.col("tile").startswith("N045")).withColumn("tile", F.lit(None).cast("string")).limit(1)
    write_tiles(tiles.filter(~F.col("tile").startswith("N045")).unionByName(nameless), folder)
    return _flat(read_tiles(spark, folder))


def missing_tiles_written(spark, d):
    """Documents of an older set and, of a newer one, those of tiles that it lacks."""
    folder = _folder(spark, "documents")
    tiles = materialize(_mesh_envelopes(spark, d), "envelopes")
    write_tiles(tiles.filter(~F.col("tile").startswith("N045")).withColumn("version", F.lit("2024.7")), folder)
    write_missing_tiles(tiles, folder)
    return _flat(read_snapshot(spark, folder))


def spot_diff_query(spark, d):
    return spot_diff(t.old_spots(spark, d), t.new_spots(spark, d))


def tile_changes_query(spark, d):
    return tile_changes(t.snapshot(spark, d, False), t.snapshot(spark, d, True))


def new_version(spark, d):
    return next_version(t.snapshot(spark, d, False), t.snapshot(spark, d, True), 2025)


def tile_changes_digests(spark, d):
    """The changes from digests of the tiles."""
    return tile_changes(with_digest(t.snapshot(spark, d, False)), with_digest(t.snapshot(spark, d, True)), by="digest")


def new_version_digests(spark, d):
    """The version from digests, those of the old tiles kept since their publication."""
    folder = _folder(spark, "published")
    spot = lambda s: F.struct(
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), s["darkness"].alias("darkness"), F.lit(1).alias("bortle"),
        F.lit("").alias("near"), s["id"].alias("id"), F.lit(None).cast("double").alias("altitude"),
    )
    old, new = [
        t.snapshot(spark, d, newer).select("version", F.lit("s").alias("source"), F.lit(GENERATED).alias("generated"), "tile", F.transform("spots", spot).alias("spots"))
        for newer in (False, True)
    ]
    publish_changes(old, folder)
    return next_version(read_digests(spark, folder), with_digest(new), 2025, by="digest")


def new_version_as_text(spark, d):
    return next_version(t.snapshot(spark, d, False), t.snapshot(spark, d, True), 2025, lexicographic=True)


def new_version_unchanged(spark, d):
    same = t.snapshot(spark, d, False)
    return next_version(same, same, 2026)


def current_version_query(spark, d):
    return current_version(t.snapshot(spark, d, False), 2025)


def version_bump(spark, d):
    old, new = t.snapshot(spark, d, False), t.snapshot(spark, d, True)
    joined = old.join(tile_changes(old, new), "tile")
    return joined.select("tile", bump_version(F.col("version"), F.col("change") != "same").alias("version"))


def alr_blocked(spark, d):
    out = compute_alr(t.radiance(spark, d), t.metric_grid(spark, d), ALR_QUERY, BLOCK_PX, SEGMENT_PX)
    return out.select("row", "col", no_nan("alr"))


def _globe_ratio(spark, d):
    g = t.grid(spark, d)
    return compute_alr(t.radiance(spark, d), g, ALR_GEO_QUERY, max(1, g.rows // GEO_BLOCK_ROWS), SEGMENT_PX)


def alr_latlon(spark, d):
    return _globe_ratio(spark, d).select("row", "col", no_nan("alr"))


def alr_full_circle(spark, d):
    """The ratio on a grid around the globe, where the first and last columns are neighbours."""
    g = t.circle_grid(spark, d)
    out = compute_alr(t.radiance(spark, d), g, ALR_CIRCLE_QUERY, max(1, g.rows // GEO_BLOCK_ROWS), SEGMENT_PX)
    return out.select("row", "col", no_nan("alr"))


def alr_from_segments(spark, d):
    """The blocked ratio of a raster stored as row segments."""
    root = f"{scratch_dir(spark)}/raster-{uuid.uuid4().hex}"
    write_segments(t.radiance(spark, d), root, "france", 2025, SEGMENT_PX)
    out = compute_alr(read_segments(spark, root, "france", 2025, SEGMENT_PX), t.metric_grid(spark, d), ALR_QUERY, BLOCK_PX, SEGMENT_PX)
    return out.select("row", "col", no_nan("alr"))


def alr_from_rings(spark, d):
    """The ratio as an aggregate of ring sums."""
    sums = ring_sums(t.radiance(spark, d), t.metric_grid(spark, d), ALR_QUERY, BLOCK_PX, SEGMENT_PX)
    return weigh_rings(sums, ALR_QUERY).select("row", "col", r6("alr"))


def alr_ring_sums(spark, d):
    # radiance comes in steps of 5e-7, so seven decimals write every sum exactly
    sums = ring_sums(t.radiance(spark, d), t.metric_grid(spark, d), ALR_QUERY, BLOCK_PX, SEGMENT_PX)
    return sums.select("row", "col", "ring", F.round("ring_sum", 7).alias("ring_sum"))


def _validated(spark, d):
    return validate(t.control_points(spark, d), scored(spark, d), t.grid(spark, d))


def validate_bortle(spark, d):
    return _validated(spark, d).select(r6("lat"), r6("lon"), "expected_bortle", "got_bortle", no_nan("got_darkness"), "match")


def validation_summary(spark, d):
    return summarize(_validated(spark, d)).select("points", r6("match_share"), "exact", r6("mean_delta"))


def annual_sites(spark, d):
    """The whole site selection, from ratio to published spots with their tile."""
    params = SiteParams(mesh_km=MESH_COVER, coverage_km=COVER_KM)
    sites = select_sites(scored(spark, d), bbox_filter(t.places(spark, d), t.BOX), t.grid(spark, d), params)
    return sites.select(tile_id(F.col("lat"), F.col("lon")).alias("tile"), "id", r6("darkness"), "bortle", "near", "added_by")


def annual_release(spark, d):
    """The whole release: radiance, ratio, mesh, thinning, coverage, nearest place, envelopes and version."""
    params = SiteParams(mesh_km=MESH_COVER, coverage_km=COVER_KM)
    ratio = score_pixels(_globe_ratio(spark, d))
    sites = select_sites(ratio, bbox_filter(t.places(spark, d), t.BOX), t.grid(spark, d), params)
    published = t.snapshot(spark, d, False).select(F.lit("").alias("source"), F.lit("").alias("generated"), "version", "tile", F.array().cast(ENVELOPE["spots"].dataType).alias("spots"))
    release = build_release(sites, t.BOX, 2025, published, GENERATED)
    return _flat(release.envelopes).withColumn("changed", F.lit(release.changed))


def spots_in_radius(spark, d):
    spots = materialize(candidates(spark, d, MESH_COARSE), "mesh").select(
        spot_id(F.col("lat"), F.col("lon")).alias("id"), "lat", "lon", F.col("darkness").alias("score")
    )
    return spots_around(t.control_points(spark, d), spots, "point").select(
        F.col("q_point").alias("point"), F.col("rnk").cast("int").alias("rnk"), F.col("p_id").alias("id"), r6("km")
    )


def spots_in_radius_stored(spark, d):
    """The same search over stored sites, of which only the partitions in reach are opened."""
    folder = _folder(spark, "spots")
    sites = candidates(spark, d, MESH_COARSE).select(spot_id(F.col("lat"), F.col("lon")).alias("id"), "lat", "lon", F.col("darkness").alias("score"))
    write_spots(sites, folder)
    found = stored_spots_around(spark, t.control_points(spark, d), folder, "point")
    return found.select(F.col("q_point").alias("point"), F.col("rnk").cast("int").alias("rnk"), F.col("p_id").alias("id"), r6("km"))


def tile_neighbours(spark, d):
    return tiles_around(t.places(spark, d)).select("place_ord", "tile", "own")


def night_scores(spark, d):
    """Score of every pixel for a night whose sun, moon and clouds are read off the order."""
    night = t.nights(spark, d)
    dark = darkness_or_bortle(F.when(~F.isnan("darkness"), F.col("darkness")), F.col("bortle"))
    moon, twilight = moon_factor(F.col("moon_deg"), F.col("moon_lit")), twilight_factor(F.col("sun_deg"))
    scored_night = score_pixels(night).select(
        "row", "col",
        night_score(dark, F.col("cloud"), moon, twilight).alias("s"),
        limiting_factor(F.col("cloud"), moon, twilight).alias("limiting"),
    )
    return scored_night.select("row", "col", "s.score", F.round("s.raw", 6).alias("raw"), "s.weather_missing", "limiting")


def weather_freshness(spark, d):
    events = t.read(spark, d, "events").select("event_id", "user_id", "ts")
    latest = events.groupBy("user_id").agg(F.max("ts").alias("now"))
    return events.join(latest, "user_id").select("event_id", weather_age(F.col("ts"), F.col("now")).alias("age"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "darkness_bortle": darkness_bortle,
    "bortle_histogram": bortle_histogram,
    "debug_raster": debug_raster,
    "debug_raster_stored": debug_raster_stored,
    "mesh_minima": mesh_minima,
    "mesh_darkest": mesh_darkest,
    "redundancy_edges": redundancy_edges,
    "redundancy_filter": redundancy_filter,
    "redundancy_filter_ties": redundancy_filter_ties,
    "redundancy_edges_crowded": redundancy_edges_crowded,
    "redundancy_filter_strips": redundancy_filter_strips,
    "redundancy_filter_ties_strips": redundancy_filter_ties_strips,
    "redundancy_filter_crowds": redundancy_filter_crowds,
    "haversine_to_centre": haversine_to_centre,
    "places_in_bbox": places_in_bbox,
    "geonames_parse": geonames_parse,
    "places_scan": places_scan,
    "regions_scan": regions_scan,
    "control_points_scan": control_points_scan,
    "nearest_place": nearest_place,
    "nearest_place_unbounded": nearest_place_unbounded,
    "nearest_place_kept": nearest_place_kept,
    "within_radius_counts": within_radius_counts,
    "within_radius_counts_hot": within_radius_counts_hot,
    "nearest_place_hot": nearest_place_hot,
    "top_points_hot": top_points_hot,
    "coverage_deficit": coverage_deficit_places,
    "coverage_pool_topk": coverage_pool_topk,
    "ensure_coverage": ensure_coverage_sites,
    "ensure_coverage_from_none": ensure_coverage_from_none,
    "spot_ids": spot_ids,
    "tile_ids": tile_ids,
    "tile_counts": tile_counts_query,
    "tile_bounds": tile_bounds_query,
    "tile_enumerate": tile_enumerate,
    "empty_tiles": empty_tiles_query,
    "tile_envelopes": tile_envelopes,
    "snapshot_roundtrip": snapshot_roundtrip,
    "publish_replaced": publish_replaced,
    "publish_changed": publish_changed,
    "tolerant_tiles": tolerant_tiles,
    "missing_tiles_written": missing_tiles_written,
    "spot_diff": spot_diff_query,
    "tile_changes": tile_changes_query,
    "tile_changes_digests": tile_changes_digests,
    "new_version": new_version,
    "new_version_digests": new_version_digests,
    "new_version_as_text": new_version_as_text,
    "new_version_unchanged": new_version_unchanged,
    "current_version": current_version_query,
    "version_bump": version_bump,
    "alr_blocked": alr_blocked,
    "alr_latlon": alr_latlon,
    "alr_full_circle": alr_full_circle,
    "alr_from_segments": alr_from_segments,
    "alr_ring_sums": alr_ring_sums,
    "alr_from_rings": alr_from_rings,
    "validate_bortle": validate_bortle,
    "validation_summary": validation_summary,
    "validation_results": validation_results,
    "annual_sites": annual_sites,
    "annual_release": annual_release,
    "spots_in_radius": spots_in_radius,
    "spots_in_radius_stored": spots_in_radius_stored,
    "tile_neighbours": tile_neighbours,
    "night_scores": night_scores,
    "weather_freshness": weather_freshness,
}
