"""Region configuration: a YAML or JSON mapping of region name to its settings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from noctule.model import REGION, Region

REQUIRED = ("bbox", "equal_area_epsg", "admin_level", "osm_country_code")


def parse_regions(text: str) -> dict[str, Region]:
    try:
        data = json.loads(text)
    except json.JSONDecodeError:
        import yaml

        data = yaml.safe_load(text)
    if not isinstance(data, dict):
        raise ValueError(f"region settings must be a mapping, got {type(data).__name__}")
    return {name: _region(name, settings) for name, settings in data.items()}


def _region(name: str, settings: dict) -> Region:
    missing = sorted(set(REQUIRED) - set(settings))
    if missing:
        raise ValueError(f"region {name!r} lacks {', '.join(missing)}")
    if len(settings["bbox"]) != 4:
        raise ValueError(f"region {name!r}: bbox needs lon_min, lat_min, lon_max, lat_max")
    return Region(
        name=name,
        label=str(settings.get("name", name)),
        bbox=tuple(float(v) for v in settings["bbox"]),
        equal_area_epsg=int(settings["equal_area_epsg"]),
        admin_level=int(settings["admin_level"]),
        osm_country_code=str(settings["osm_country_code"]),
    )


def load_regions(spark: SparkSession, path: str) -> dict[str, Region]:
    """Settings file read through Spark, so any file system the cluster knows works."""
    row = spark.read.text(path, wholetext=True).first()
    return parse_regions(row.value if row else "{}")


def get_region(regions: dict[str, Region], name: str) -> Region:
    if name not in regions:
        raise KeyError(f"unknown region {name!r}, known: {', '.join(sorted(regions))}")
    return regions[name]


def regions_frame(spark: SparkSession, regions: dict[str, Region]) -> DataFrame:
    rows = [
        (r.name, r.label, list(r.bbox), r.equal_area_epsg, r.admin_level, r.osm_country_code) for r in regions.values()
    ]
    return spark.createDataFrame(rows, REGION)
