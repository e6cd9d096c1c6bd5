"""Grid metadata, regions and the table schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F, types as T

from noctule import constants as K


@dataclass(frozen=True)
class Grid:
    """North-up raster grid: ``lon = c + a * (col + 0.5)`` and ``lat = f + e * (row + 0.5)``.

    For a projected (equal-area) grid the same fields are metres and ``geographic`` is False.
    """

    c: float
    f: float
    a: float
    e: float
    rows: int
    cols: int
    geographic: bool = True
    epsg: int = 4326

    def lon_of(self, col: Column) -> Column:
        return F.lit(self.c) + F.lit(self.a) * (col + F.lit(0.5))

    def lat_of(self, row: Column) -> Column:
        return F.lit(self.f) + F.lit(self.e) * (row + F.lit(0.5))

    def row_at(self, lat: Column) -> Column:
        return F.floor((lat - F.lit(self.f)) / F.lit(self.e)).cast("int")

    def col_at(self, lon: Column) -> Column:
        return F.floor((lon - F.lit(self.c)) / F.lit(self.a)).cast("int")

    @property
    def full_circle(self) -> bool:
        """The columns go once around the globe, so the last one is the first one's neighbour."""
        return self.geographic and abs(self.cols * abs(self.a) - 360.0) < 1e-6 * abs(self.a)

    def mesh_cell_px(self, mesh_km: float) -> tuple[int, int]:
        """Rows and columns of one mesh cell; the same degrees on both axes, at least one pixel."""
        if not self.geographic:
            raise ValueError("the mesh is defined in degrees and needs a geographic grid")
        deg = mesh_km / K.MESH_KM_PER_DEG
        return max(1, round(deg / abs(self.e))), max(1, round(deg / abs(self.a)))


@dataclass(frozen=True)
class Region:
    name: str
    label: str
    bbox: tuple[float, float, float, float]  # lon_min, lat_min, lon_max, lat_max
    equal_area_epsg: int
    admin_level: int
    osm_country_code: str
    extra: dict = field(default_factory=dict, compare=False)


PIXELS = T.StructType(
    [
        T.StructField("row", T.IntegerType()),
        T.StructField("col", T.IntegerType()),
        T.StructField("radiance", T.DoubleType()),
    ]
)

PLACE = T.StructType(
    [
        T.StructField("place_ord", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("population", T.LongType()),
    ]
)

SPOT = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("darkness", T.DoubleType()),
        T.StructField("bortle", T.IntegerType()),
        T.StructField("near", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("altitude", T.DoubleType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("generated", T.StringType()),
        T.StructField("tile", T.StringType()),
        T.StructField("spots", T.ArrayType(SPOT)),
    ]
)

CONTROL_POINT = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("expected_bortle", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)

REGION = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("equal_area_epsg", T.IntegerType()),
        T.StructField("admin_level", T.IntegerType()),
        T.StructField("osm_country_code", T.StringType()),
    ]
)
