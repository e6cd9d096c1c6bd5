"""Published documents: one ``<tile>.json`` per envelope row.

Tasks write each document as a file of its own through Spark's own text writer, in a staging folder under the target;
the documents are then renamed into place, so readers never see a half-written one and a retried task leaves nothing
behind. With ``replace_all`` documents of other tiles are removed after the new ones are in place. Renames and deletes
run side by side. All of it goes through the session's Hadoop file system, as Spark's own readers and writers do, so
any store that they reach will do, and no other process opens a path. A set has at most one document per degree.

``publish_tiles`` replaces a published set at once: the documents go to a release folder that nobody reads, then
the pointer to the current release is switched in one rename. ``publish_changes`` does so too and writes changed tiles only.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from noctule.operators.release import with_digest
from noctule.runtime import in_scratch, materialize, qualified
from noctule.sources.releases import INDEX, INDEX_SCHEMA, new_release, read_index, remove_superseded, rename_over, store, switch_release

KEYS = ("version", "source", "generated", "tile", "spots")
# File operations at the same time, which wait for the store and not for the processor.
COMMIT_THREADS = 32
# Documents made into text at once.
TEXTS = 64


def shared_path(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; outside local mode a path without scheme must not be one machine's disk.

    The folder in ``spark.checkpoint.dir`` is shared, so paths in it are taken however it is written.
    """
    whole = qualified(spark, path)
    bare = whole.startswith("file:") and not path.startswith("file:")
    if bare and not spark.sparkContext.master.startswith("local") and not in_scratch(spark, path):
        raise ValueError(f"{path} is a folder of each executor's own disk; name a file system that all can reach")
    return whole


def _documents(envelopes: DataFrame) -> DataFrame:
    """(document, value): name and text of each document."""
    keys, texts = KEYS, TEXTS

    def text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, texts):
                rows = batch.slice(at, texts).to_pylist()
                names = [f"{row['tile']}.json" for row in rows]
                values = [json.dumps({k: row[k] for k in keys}, indent=4, ensure_ascii=False) for row in rows]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], names=["document", "value"])

    return envelopes.select(*KEYS).mapInArrow(text, "document string, value string")


def write_tiles(envelopes: DataFrame, path: str, replace_all: bool = True) -> None:
    """Write ``<path>/<tile>.json``; with ``replace_all`` the folder then holds exactly these tiles."""
    spark: SparkSession = envelopes.sparkSession
    target = shared_path(spark, path).rstrip("/")
    staging = f"{target}/_staging-{uuid.uuid4().hex}"
    fs, at = store(spark, target), spark._jvm.org.apache.hadoop.fs.Path
    try:
        # one record a file: a document is never joined with another
        _documents(envelopes).write.partitionBy("document").option("maxRecordsPerFile", 1).text(staging)
        folders = [s.getPath() for s in fs.listStatus(at(staging)) if s.isDirectory()]
        names = [unquote(f.getName().partition("=")[2]) for f in folders]
        if wrong := [n for n in names if "/" in n]:
            raise ValueError(f"{wrong[0]} is no name of a document")

        def place(folder, name: str) -> None:
            for status in fs.listStatus(folder):
                if status.getPath().getName().startswith("part-"):
                    rename_over(spark, fs, status.getPath(), at(f"{target}/{name}"))

        with ThreadPoolExecutor(COMMIT_THREADS) as pool:
            list(pool.map(place, folders, names))
            if replace_all:
                placed = set(names)
                old = [s.getPath() for s in fs.listStatus(at(target)) if s.getPath().getName().endswith(".json") and s.getPath().getName() not in placed]
                list(pool.map(lambda p: fs.delete(p, False), old))
    finally:
        fs.delete(at(staging), True)


def publish_tiles(envelopes: DataFrame, path: str) -> None:
    """Replace the set published at ``path`` by these tiles, whole or not at all.

    ``read_snapshot`` gives the old set until the very last step. What was published before is deleted afterwards.
    """
    spark = envelopes.sparkSession
    release = new_release(path)
    write_tiles(envelopes, release)
    switch_release(spark, path, release)
    remove_superseded(spark, path)


def publish_changes(envelopes: DataFrame, path: str) -> dict[str, int]:
    """Replace the set published at ``path`` like ``publish_tiles``, but write the documents of changed tiles only.

    An unchanged tile keeps its document as it is, with the version and the time stamp it was published with. Tiles
    are compared by the digests in the index of the old release; where it has none (the first time) all are written.
    Equal sets leave the published one untouched. Returns the numbers of tiles ``written``, ``kept`` and ``removed``.
    """
    spark = envelopes.sparkSession
    index = read_index(spark, path)
    first = index is None
    old = spark.createDataFrame([], INDEX_SCHEMA) if first else index
    old = old.select("tile", F.col("digest").alias("old_digest"), F.col("version").alias("old_version"), F.col("file").alias("old_file"))
    new = with_digest(envelopes).select("tile", "digest", "version", F.lit(True).alias("in_new"))
    state = F.when(F.col("in_new").isNull(), "removed").when(F.col("digest").eqNullSafe(F.col("old_digest")), "kept").otherwise("written")
    compared = materialize(new.join(old, "tile", "full_outer").withColumn("state", state), "compared")
    counts = {"written": 0, "kept": 0, "removed": 0} | {r.state: r["count"] for r in compared.groupBy("state").count().collect()}
    if not first and not counts["written"] and not counts["removed"]:
        return counts
    release = new_release(path)
    changed = compared.filter("state = 'written'").select("tile")
    write_tiles(envelopes.join(changed, "tile"), release)
    kept = F.col("state") == "kept"
    rows = compared.filter("state <> 'removed'").select(
        "tile",
        "digest",
        F.when(kept, F.col("old_version")).otherwise(F.col("version")).alias("version"),
        F.when(kept, F.col("old_file")).otherwise(F.concat(F.lit(release.rsplit("/", 1)[1] + "/"), "tile", F.lit(".json"))).alias("file"),
        F.col("version").alias("release_version"),
    )
    rows.write.parquet(f"{release}/{INDEX}")
    switch_release(spark, path, release)
    remove_superseded(spark, path)
    return counts


def write_missing_tiles(envelopes: DataFrame, path: str) -> None:
    """Write only tiles that have no document yet."""
    from noctule.sources.snapshots import read_tiles

    present = read_tiles(envelopes.sparkSession, path).select("tile")
    write_tiles(envelopes.join(present, "tile", "left_anti"), path, replace_all=False)
