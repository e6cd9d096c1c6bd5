"""Published releases: a folder of one JSON document per tile, see :mod:`noctule.sources.releases`."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from noctule.model import ENVELOPE
from noctule.operators.release import with_digest
from noctule.sources.releases import current_release, index_folders, read_index

CORRUPT = "_corrupt_record"


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes of a release, keyed by their ``tile`` field; an absent folder is an empty release.

    Two documents for one tile make the release ambiguous and fail the read, and so does a document that cannot be
    parsed or names no tile: skipped, its tile would count as new and be overwritten unseen.
    """
    read = _documents(spark, path)
    if read is None:
        return spark.createDataFrame([], ENVELOPE)
    broken = read.filter(F.col(CORRUPT).isNotNull() | F.col("tile").isNull()).select("file", "tile", CORRUPT).first()
    if broken:
        raise ValueError(f"{broken.file} is not a tile document")
    df = read.select(*ENVELOPE.fieldNames())
    index = read_index(spark, path)
    if index is not None:
        lost = index.join(read.select(_name_in_set().alias("found")), F.col("file") == F.col("found"), "left_anti").first()
        if lost:
            raise ValueError(f"{lost.file} is named by the index of {path} and is not there")
    twice = df.groupBy("tile").count().filter("count > 1").agg(F.first("tile").alias("tile")).first()
    if twice and twice.tile:
        raise ValueError(f"tile {twice.tile} occurs more than once in {path}")
    return df


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(tile, digest, version) of a release: from its index without opening a document, else from its documents."""
    index = read_index(spark, path)
    if index is None:
        return with_digest(read_snapshot(spark, path)).select("tile", "digest", "version")
    return index.select("tile", "digest", F.col("release_version").alias("version"))


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Like ``read_snapshot`` for any JSON path, dropping documents that do not parse; absent gives no rows."""
    read = _documents(spark, path)
    if read is None:
        return spark.createDataFrame([], ENVELOPE)
    return read.filter(F.col(CORRUPT).isNull() & F.col("tile").isNotNull()).select(*ENVELOPE.fieldNames())


def _documents(spark: SparkSession, path: str) -> DataFrame | None:
    """All documents with what did not parse, None if there is no such folder."""
    index = read_index(spark, path)
    folders = [current_release(spark, path)] if index is None else [f"{path.rstrip('/')}/{name}" for name in index_folders(index)]
    if not folders:
        return None
    schema = T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        read = (
            spark.read.schema(schema)
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", "*.json")
            .json(folders)
            .select("*", F.col("_metadata.file_path").alias("file"))
        )
    except AnalysisException as e:
        if index is not None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return read if index is None else read.join(index.select(F.col("file").alias("named")), _name_in_set() == F.col("named"), "left_semi")


def _name_in_set() -> Column:
    """A document's release folder and name, as an index writes them."""
    return F.substring_index("file", "/", -2)
