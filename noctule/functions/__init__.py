"""Column functions; all of them stay in JVM code generation."""

from noctule.functions.geo import haversine_km, spot_id, tile_bounds, tile_fault, tile_id
from noctule.functions.sky import alr_to_bortle, alr_to_darkness
from noctule.functions.versions import bump_version, version_parts

__all__ = [
    "alr_to_bortle",
    "alr_to_darkness",
    "bump_version",
    "haversine_km",
    "spot_id",
    "tile_bounds",
    "tile_fault",
    "tile_id",
    "version_parts",
]
