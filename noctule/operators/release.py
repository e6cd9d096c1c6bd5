"""Versions and differences between two releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from noctule.functions.versions import format_version, version_parts


def _latest(version: Column, lexicographic: bool) -> Column:
    """Aggregate for the newest version text; 2025.10 is newer than 2025.9 unless compared as text."""
    if lexicographic:
        return F.max(version)
    return format_version(F.max(version_parts(version)))


def current_version(snapshot: DataFrame, year: int, lexicographic: bool = False) -> DataFrame:
    """One row ``version``: the newest in the snapshot, or ``year.1``; texts that are no version are skipped."""
    latest = _latest(F.when(F.col("version").rlike(r"^\d{4}\.\d+\z"), F.col("version")), lexicographic)
    return snapshot.agg(F.coalesce(latest, F.lit(f"{year}.1")).alias("version"))


def with_digest(tiles: DataFrame) -> DataFrame:
    """Tiles with ``digest`` of their spots: equal for equal spots in the same order, whatever else the tile says.

    A missing attribute is written out, so it differs from any value; 0.0 and -0.0 differ.
    """
    text = F.to_json(F.struct("spots"), {"ignoreNullFields": "false"})
    return tiles.withColumn("digest", F.sha2(text, 256))


def tile_changes(old: DataFrame, new: DataFrame, by: str = "spots") -> DataFrame:
    """(tile, change): added, removed, modified or same. Only ``by`` counts: ``spots`` in their order, or ``digest``."""
    o = old.select("tile", F.col(by).alias("old_spots"), F.lit(True).alias("in_old"))
    n = new.select("tile", F.col(by).alias("new_spots"), F.lit(True).alias("in_new"))
    change = (
        F.when(F.col("in_old").isNull(), "added")
        .when(F.col("in_new").isNull(), "removed")
        .when(F.col("old_spots").eqNullSafe(F.col("new_spots")), "same")
        .otherwise("modified")
    )
    return o.join(n, "tile", "full_outer").select("tile", change.alias("change"))


def _no_version(what: Column) -> Column:
    return F.raise_error(F.concat(F.lit("the published tiles have no valid version: "), F.coalesce(what, F.lit("none")))).cast("string")


def new_version(old: DataFrame, new: DataFrame, year: int, lexicographic: bool = False, by: str = "spots") -> DataFrame:
    """One row (version, changed) of the release that replaces ``old`` by ``new``.

    No old release: ``year.1``. Nothing changed: the old version, also in a new year. Otherwise ``year.1`` in a
    new year, else the next minor number. One join on the tile answers all of it. An old release whose newest
    version cannot be read fails the query: publishing over it would restart the numbering unseen.
    With ``by="digest"`` the join carries one digest per tile instead of its spots.
    """
    o = old.select("tile", F.col(by).alias("old_spots"), F.col("version").alias("old_version"), F.lit(1).alias("in_old"))
    n = new.select("tile", F.col(by).alias("new_spots"), F.lit(1).alias("in_new"))
    differs = F.col("in_old").isNull() | F.col("in_new").isNull() | ~F.col("old_spots").eqNullSafe(F.col("new_spots"))
    facts = o.join(n, "tile", "full_outer").agg(
        F.count("in_old").alias("n_old"),
        F.coalesce(F.bool_or(differs), F.lit(False)).alias("differs"),
        _latest(F.col("old_version"), lexicographic).alias("latest"),
    )
    parts = version_parts(F.col("latest"))
    fresh = F.lit(f"{year}.1")
    version = (
        F.when(F.col("n_old") == 0, fresh)
        .when(parts["year"].isNull() | parts["minor"].isNull(), _no_version(F.col("latest")))
        .when(~F.col("differs"), F.col("latest"))
        .when(parts["year"] != year, fresh)
        .otherwise(F.concat(F.lit(f"{year}."), (parts["minor"] + 1).cast("string")))
    )
    return facts.select(version.alias("version"), ((F.col("n_old") == 0) | F.col("differs")).alias("changed"))


def spot_diff(old: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """One row (changed, added, removed, modified) of two spot tables matched by ``id``.

    When an id occurs twice on one side the row with the highest ``order`` counts; without ``order`` it is an error.
    """
    cols = [c for c in old.columns if c != order]

    def by_id(df: DataFrame, name: str) -> DataFrame:
        row = F.struct(*cols)
        if order is None:
            twice = F.raise_error(F.concat(F.lit("spot id occurs twice: "), F.first(F.col("id").cast("string"))))
            one = F.when(F.count(F.lit(1)) > 1, twice.cast(df.select(row).schema[0].dataType)).otherwise(F.first(row))
            return df.groupBy("id").agg(one.alias(name))
        return df.groupBy("id").agg(F.max_by(row, F.col(order)).alias(name))

    o, n = F.col("old_spot"), F.col("new_spot")
    counts = (
        by_id(old, "old_spot")
        .join(by_id(new, "new_spot"), "id", "full_outer")
        .agg(
            F.count_if(o.isNull()).alias("added"),
            F.count_if(n.isNull()).alias("removed"),
            F.count_if(o.isNotNull() & n.isNotNull() & ~o.eqNullSafe(n)).alias("modified"),
        )
    )
    changed = (F.col("added") + F.col("removed") + F.col("modified")) > 0
    return counts.select(changed.alias("changed"), "added", "removed", "modified")
