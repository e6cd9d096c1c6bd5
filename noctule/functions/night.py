"""Score of a site for one night; sun, moon and cloud values come in as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noctule import constants as K

# fixed values of the night score
FULL_DARK_DEG = -18.0
USABLE_DEG = -12.0
USABLE_FACTOR = 0.4
WEATHER_EXPONENT = 2
FRESH_HOURS = 3
STALE_HOURS = 12
# left open by the published description, hence parameters below
GONE_DEG = -6.0
IDEAL_FROM = 0.8


def darkness_or_bortle(darkness: Column, bortle: Column) -> Column:
    """Darkness, or an even scale over the Bortle classes where only the class is known."""
    return F.coalesce(darkness, (F.lit(K.BORTLE_MAX) - bortle) / F.lit(float(K.BORTLE_MAX - K.BORTLE_MIN)))


def twilight_factor(sun_deg: Column, gone_deg: float = GONE_DEG) -> Column:
    """1 with the sun at -18 degrees or lower, falling to 0.4 at -12 and on to 0 at ``gone_deg``."""
    upper = F.lit(1.0) - (sun_deg - FULL_DARK_DEG) / (USABLE_DEG - FULL_DARK_DEG) * (1.0 - USABLE_FACTOR)
    lower = (F.lit(gone_deg) - sun_deg) / (gone_deg - USABLE_DEG) * USABLE_FACTOR
    return F.when(sun_deg <= FULL_DARK_DEG, 1.0).when(sun_deg < USABLE_DEG, upper).otherwise(F.greatest(lower, F.lit(0.0)))


def moon_factor(moon_deg: Column, lit_fraction: Column) -> Column:
    """1 with the moon below the horizon, else what its lit fraction leaves."""
    return F.when(moon_deg < 0, 1.0).otherwise(F.lit(1.0) - lit_fraction)


def weather_factor(cloud: Column) -> Column:
    return F.pow(F.lit(1.0) - cloud, F.lit(WEATHER_EXPONENT))


def night_score(darkness: Column, cloud: Column, moon: Column, twilight: Column) -> Column:
    """Struct (score 0..10, raw 0..1, weather_missing): the product of all factors, without an unknown cloud cover."""
    raw = darkness * moon * twilight * F.coalesce(weather_factor(cloud), F.lit(1.0))
    return F.struct(
        F.floor(raw * 10 + 0.5).cast("int").alias("score"), raw.alias("raw"), cloud.isNull().alias("weather_missing")
    )


def limiting_factor(cloud: Column, moon: Column, twilight: Column, ideal_from: float = IDEAL_FROM) -> Column:
    """The weakest of clouds, moon and twilight, or "ideal" when all are at least ``ideal_from``."""
    weather = F.coalesce(weather_factor(cloud), F.lit(1.0))
    least = F.least(weather, moon, twilight)
    return (
        F.when(least >= ideal_from, "ideal").when(weather == least, "clouds").when(moon == least, "moon").otherwise("twilight")
    )


def weather_age(observed: Column, now: Column) -> Column:
    """fresh up to 3 hours, aged up to 12, else stale."""
    age = now - observed
    fresh, stale = F.expr(f"INTERVAL {FRESH_HOURS} HOURS"), F.expr(f"INTERVAL {STALE_HOURS} HOURS")
    return F.when(age <= fresh, "fresh").when(age <= stale, "aged").otherwise("stale")
