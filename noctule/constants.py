"""Results only match published releases when these are kept as they are."""

EARTH_RADIUS_KM = 6371.0

# site selection
MESH_KM = 5
REDUNDANCY_KM = 15
MIN_SPOTS_PER_AREA = 4
COVERAGE_RADIUS_KM = 100
MAX_NEAR_DISTANCE_KM = 25

# km per degree: the mesh and the bbox margin use two different roundings
MESH_KM_PER_DEG = 111.32
BBOX_KM_PER_DEG = 111.0
BBOX_MARGIN_KM = 100

# all-sky light pollution ratio
ALR_ALPHA_BASE = 2.3
ALR_ALPHA_EXP = 0.28
ALR_CALIB_C = 1.0 / 1125.44
ALR_RINGS = 38
ALR_MAX_KM = 300
ALR_NOISE_FLOOR = 0.5
ALR_WORK_RESOLUTION_M = 450

# darkness scale
ALR_DARK = 0.1
ALR_BRIGHT = 10.0
ALR_EPS = 1e-3

# Bortle class by inclusive upper bound of the ratio; above the last bound 8, no data 9
BORTLE_THRESHOLDS = [
    (0.10, 1),
    (0.20, 2),
    (0.33, 3),
    (1.0, 4),
    (2.0, 5),
    (4.0, 6),
    (10.0, 7),
]
BORTLE_ABOVE = 8
BORTLE_NO_DATA = 9
BORTLE_MIN = 1
BORTLE_MAX = 9
BORTLE_TOLERANCE = 1

# formats
TILE_SIZE_DEG = 1.0
TILE_PATTERN = r"^([NS])(\d{3})([EW])(\d{3})\z"
VERSION_PATTERN = r"^(\d{4})\.(\d+)\z"
