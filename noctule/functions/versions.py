"""Release version text ``YYYY.N``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from noctule import constants as K


def version_parts(version: Column) -> Column:
    """Struct (year, minor) of a version, or NULL when the text is not a version."""
    year = F.regexp_extract(version, K.VERSION_PATTERN, 1).try_cast("int")
    minor = F.regexp_extract(version, K.VERSION_PATTERN, 2).try_cast("int")
    return F.when(version.rlike(K.VERSION_PATTERN), F.struct(year.alias("year"), minor.alias("minor")))


def format_version(parts: Column) -> Column:
    return F.concat(parts["year"].cast("string"), F.lit("."), parts["minor"].cast("string"))


def bump_version(version: Column, changed: Column) -> Column:
    """Next minor version when something changed, else the version as it is."""
    parts = version_parts(version)
    bumped = F.concat(parts["year"].cast("string"), F.lit("."), (parts["minor"] + 1).cast("string"))
    return F.when(changed, bumped).otherwise(version)
