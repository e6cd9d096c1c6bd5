"""The annual release: raster and places in, versioned tiles out.

    spark-submit -m noctule.plans.annual --region france --year 2025 --regions regions.yaml \\
        --places places.txt --raster /data/radiance --out /data/release --published /data/published

Steps: ratio -> darkness and class -> one candidate per mesh cell -> thinning -> coverage -> nearest place ->
site ids -> tiles -> version against the published set -> documents.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from noctule import constants as K
from noctule.model import ENVELOPE, Grid, Region
from noctule.operators.alr import SEGMENT_PX, AlrParams, compute_alr
from noctule.operators.coverage import attach_nearest_place, ensure_coverage
from noctule.operators.raster import mesh_minima, score_pixels
from noctule.operators.release import new_version, with_digest
from noctule.operators.thinning import redundancy_filter
from noctule.operators.tiles import enrich, enumerate_tiles, envelopes, tile_arrays, with_empty_tiles
from noctule.runtime import materialize, ship_package


@dataclass(frozen=True)
class SiteParams:
    mesh_km: float = K.MESH_KM
    pick: str = "min"
    redundancy_km: float = K.REDUNDANCY_KM
    min_spots: int = K.MIN_SPOTS_PER_AREA
    coverage_km: float = K.COVERAGE_RADIUS_KM
    near_km: float = K.MAX_NEAR_DISTANCE_KM


@dataclass(frozen=True)
class Release:
    version: str
    changed: bool
    envelopes: DataFrame
    counts: dict[str, int]


def select_sites(
    scored: DataFrame,
    places: DataFrame,
    grid: Grid,
    params: SiteParams = SiteParams(),
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Enriched sites from scored pixels; ``coverage_order()`` columns are kept for the tile arrays.

    The raster is aggregated to mesh candidates in one pass; from there on everything is as small as the mesh.
    """
    mesh = mesh_minima(scored, grid, params.mesh_km, params.pick, unit_darkness=True)
    mesh = materialize(mesh, "candidates", counts)
    kept = materialize(redundancy_filter(mesh, params.redundancy_km), "kept", counts)
    covered = ensure_coverage(kept, mesh, places, params.min_spots, params.coverage_km)
    covered = materialize(covered, "covered", counts)
    return enrich(attach_nearest_place(covered, places, params.near_km))


def build_release(
    sites: DataFrame,
    region: Region,
    year: int,
    published: DataFrame | None,
    generated: str,
    lexicographic: bool = False,
    counts: dict[str, int] | None = None,
) -> Release:
    """Envelopes of all occupied tiles and all empty tiles of the region's box, stamped with their version.

    ``published`` holds the old tiles with their ``spots``, or with a ``digest`` of these.
    """
    spark = sites.sparkSession
    box = spark.createDataFrame([region.bbox], "lon_min double, lat_min double, lon_max double, lat_max double")
    occupied = materialize(tile_arrays(sites), "occupied_tiles", counts)
    arrays = materialize(with_empty_tiles(occupied, enumerate_tiles(box)), "tiles", counts)
    old = published if published is not None else spark.createDataFrame([], ENVELOPE)
    if "digest" in old.columns:
        decided = new_version(old, with_digest(arrays), year, lexicographic, by="digest").first()
    else:
        decided = new_version(old, arrays, year, lexicographic).first()
    source = f"VIIRS/{year}/{region.name}"
    return Release(decided.version, decided.changed, envelopes(arrays, decided.version, source, generated), counts or {})


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def run(spark: SparkSession, args: argparse.Namespace) -> Release:
    from noctule.sinks.tables import write_debug_raster
    from noctule.sinks.tile_json import publish_changes, publish_tiles, write_tiles
    from noctule.sources.places import load_places
    from noctule.sources.rasters import read_pixels, read_segments
    from noctule.sources.regions import get_region, load_regions
    from noctule.sources.snapshots import read_digests, read_snapshot

    ship_package(spark)
    region = get_region(load_regions(spark, args.regions), args.region)
    where = spark, args.raster, args.region, args.year
    raster = read_segments(*where, args.segments) if args.segments else read_pixels(*where)
    grid = read_grid(spark, args)
    alr = compute_alr(raster, grid, AlrParams(max_km=args.max_km), args.block_px, args.segments or SEGMENT_PX)
    if args.debug_raster:
        # two readers of the ratio: store it; otherwise it flows straight into the mesh aggregate
        alr = materialize(alr, "alr")
        write_debug_raster(score_pixels(alr), f"{args.out}/debug", args.region, args.year)
    scored = score_pixels(alr)
    counts: dict[str, int] = {}
    places = materialize(load_places(spark, region, args.places), "places", counts)
    sites = select_sites(scored, places, grid, SiteParams(mesh_km=args.mesh_km), counts)
    read_old = read_digests if args.incremental else read_snapshot
    published = read_old(spark, args.published) if args.published else None
    release = build_release(sites, region, args.year, published, utc_now(), args.text_versions, counts)
    write_tiles(release.envelopes, f"{args.out}/spots")
    if args.published and not args.no_publish:
        publish = publish_changes if args.incremental else publish_tiles if args.atomic else write_tiles
        publish(release.envelopes, args.published)
    return release


def read_grid(spark: SparkSession, args: argparse.Namespace) -> Grid:
    """Grid of a region and year from the one-row table beside the raster."""
    schema = "region string, year int, c double, f double, a double, e double, rows int, cols int, geographic boolean, epsg int"
    row = (
        spark.read.schema(schema)
        .parquet(args.grids or f"{args.raster.rstrip('/')}_grid")
        .filter((F.col("region") == args.region) & (F.col("year") == args.year))
        .first()
    )
    if row is None:
        raise ValueError(f"no grid for {args.region} {args.year}")
    return Grid(row.c, row.f, row.a, row.e, row.rows, row.cols, row.geographic, row.epsg)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="noctule.plans.annual")
    p.add_argument("--region", required=True)
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--regions", required=True, help="YAML or JSON region settings")
    p.add_argument("--places", required=True, help="tab-separated gazetteer text")
    p.add_argument("--raster", required=True, help="radiance Parquet, partitioned by region and year")
    p.add_argument("--segments", type=int, help="the raster is stored as row segments of so many pixels")
    p.add_argument("--grids", help="grid table, by default <raster>_grid")
    p.add_argument("--out", required=True)
    p.add_argument("--published", help="published set to compare with and to replace")
    p.add_argument("--no-publish", action="store_true", help="compare with the published set but leave it as it is")
    p.add_argument("--atomic", action="store_true", help="publish as a release folder and a pointer to it, switched in one rename")
    p.add_argument("--incremental", action="store_true", help="like --atomic, but compare digests and write changed tiles only")
    p.add_argument("--debug-raster", action="store_true")
    p.add_argument("--mesh-km", type=float, default=K.MESH_KM)
    p.add_argument("--max-km", type=float, default=K.ALR_MAX_KM)
    p.add_argument("--block-px", type=int, default=2048)
    p.add_argument("--text-versions", action="store_true", help="compare versions as text, 2025.9 after 2025.10")
    return p


if __name__ == "__main__":
    session = SparkSession.builder.appName("noctule-annual").getOrCreate()
    outcome = run(session, parser().parse_args())
    print(f"version {outcome.version} changed {outcome.changed} rows {outcome.counts}")
