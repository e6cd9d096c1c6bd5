"""Distance, site ids and tile ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noctule import constants as K


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km on the 6371 km sphere.

    Each term occurs once, because join conditions do not share common subexpressions. The arc sine is as exact
    as the two-argument arc tangent up to a quarter turn and within 0.1 m of it at the antipode.
    """
    dlat, dlon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    half_chord2 = F.pow(dlat, F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(dlon, F.lit(2))
    # rounding can push antipodal points just above 1
    return F.asin(F.sqrt(F.least(half_chord2, F.lit(1.0)))) * F.lit(2 * K.EARTH_RADIUS_KM)


def _fixed4(x: Column) -> Column:
    """``x`` with four decimals, rounding the exact binary value half to even.

    ``format_string('%.4f')`` rounds the shortest decimal text instead and differs on about
    one pixel centre in six. The product ``|x| * 10^4`` is split into its double value and its
    exact rounding error (Dekker's product), so the comparison with one half is exact.
    """
    m = F.abs(x)
    hi = m * F.lit(1e4)
    split = m * F.lit(134217729.0)
    head = split - (split - m)
    tail = m - head
    # 1e4 has 14 bits, so both partial products are exact
    err = (head * F.lit(1e4) - hi) + tail * F.lit(1e4)
    whole = F.floor(hi)
    over = (hi - whole.cast("double")) - F.lit(0.5)
    up = (
        F.when((over > 0) | ((over == 0) & (err > 0)), F.lit(1))
        .when((over == 0) & (err == 0), (whole % 2).cast("int"))
        .otherwise(F.lit(0))
    )
    # an exact product just below a whole number can round up to it: over is then -0.5, still correct
    units = whole + up
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        sign,
        F.floor(units / F.lit(10000)).cast("string"),
        F.lit("."),
        F.lpad((units % 10000).cast("string"), 4, "0"),
    )


def spot_id(lat: Column, lon: Column) -> Column:
    """``lat_lon`` with four decimals; -0.0 is written as 0.0, tiny negatives keep their sign."""
    return F.concat(_fixed4(lat), F.lit("_"), _fixed4(lon))


def tile_fault(lat: Column, lon: Column) -> Column:
    """Why a point has no tile, or NULL: missing, not a number, out of range, a pole, or lon 180."""
    bad_lat = lat.isNull() | F.isnan(lat) | (F.abs(lat) > 90)
    bad_lon = lon.isNull() | F.isnan(lon) | (F.abs(lon) > 180)
    return (
        F.when(bad_lat, F.concat(F.lit("latitude out of range: "), F.coalesce(lat.cast("string"), F.lit("null"))))
        .when(bad_lon, F.concat(F.lit("longitude out of range: "), F.coalesce(lon.cast("string"), F.lit("null"))))
        .when(F.abs(lat) == 90, F.lit("a pole lies in no tile"))
        .when(lon == 180, F.lit("longitude 180 lies in no tile, use -180"))
    )


def tile_label(lat_floor: Column, lon_floor: Column) -> Column:
    """Tile name from its whole-degree south-west corner."""
    return F.concat(
        F.when(lat_floor >= 0, F.lit("N")).otherwise(F.lit("S")),
        F.lpad(F.abs(lat_floor).cast("string"), 3, "0"),
        F.when(lon_floor >= 0, F.lit("E")).otherwise(F.lit("W")),
        F.lpad(F.abs(lon_floor).cast("string"), 3, "0"),
    )


def tile_id(lat: Column, lon: Column, strict: bool = True) -> Column:
    """One-degree tile of a point, such as ``N042E001``.

    ``strict`` fails the job on a point that has no tile; otherwise such points get NULL, and
    ``tile_fault`` tells why, so that a caller can route them to a rejects table.
    """
    fault = tile_fault(lat, lon)
    name = tile_label(F.floor(lat).cast("int"), F.floor(lon).cast("int"))
    if strict:
        return F.when(fault.isNotNull(), F.raise_error(fault).cast("string")).otherwise(name)
    return F.when(fault.isNull(), name)


def tile_bounds(tile: Column, strict: bool = True) -> Column:
    """Struct of lat_min, lon_min, lat_max, lon_max of a tile name; the numbers are not range-checked."""

    def part(i: int) -> Column:
        return F.regexp_extract(tile, K.TILE_PATTERN, i)

    lat = F.when(part(1) == "S", -part(2).try_cast("double")).otherwise(part(2).try_cast("double"))
    lon = F.when(part(3) == "W", -part(4).try_cast("double")).otherwise(part(4).try_cast("double"))
    # 0.0 - 0.0 keeps S000 and W000 free of a negative zero
    lat, lon = lat + F.lit(0.0), lon + F.lit(0.0)
    bounds = F.struct(
        lat.alias("lat_min"), lon.alias("lon_min"), (lat + 1.0).alias("lat_max"), (lon + 1.0).alias("lon_max")
    )
    valid = F.coalesce(tile.rlike(K.TILE_PATTERN), F.lit(False))
    if strict:
        message = F.concat(F.lit("invalid tile name: "), F.coalesce(tile, F.lit("null")))
        tile_ok = F.when(valid, tile).otherwise(F.raise_error(message).cast("string"))
        return F.when(tile_ok.isNotNull(), bounds)
    return F.when(valid, bounds)
