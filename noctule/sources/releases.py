"""Published sets: every release in a folder of its own, and a pointer that names the current one.

Releases are never changed once they are named. The pointer ``_current`` is replaced by one rename, so a reader sees
the whole old release or the whole new one, whenever a job that publishes dies: the plain rename of the file system that
Spark uses where that replaces, else the replacing one of Hadoop's file contexts, which not every store has. A folder without a pointer is
itself the release.

A release written by :func:`noctule.sinks.tile_json.publish_changes` holds the documents of changed tiles only, and an
index ``_index`` with one row per tile of the whole set: its digest, its version and the document, which may lie in
an earlier release folder.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

CURRENT = "_current"
PREFIX = "release-"
INDEX = "_index"
INDEX_SCHEMA = "tile string, digest string, version string, file string, release_version string"


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def store(spark: SparkSession, path: str):
    """File system of ``path``; without its layer of checksum files, which would lie beside the documents."""
    _, fs = _hadoop(spark, path)
    checked = is_instance_of(spark._sc._gateway, fs, "org.apache.hadoop.fs.ChecksumFileSystem")
    return fs.getRawFileSystem() if checked else fs


def new_release(path: str) -> str:
    """Folder for a release that nobody reads yet."""
    return f"{path.rstrip('/')}/{PREFIX}{uuid.uuid4().hex}"


def current_release(spark: SparkSession, path: str) -> str:
    """Folder of the release that is published at ``path``."""
    pointer, _ = _hadoop(spark, f"{path.rstrip('/')}/{CURRENT}")
    fs = store(spark, path)
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{path.rstrip('/')}/{name}"


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """Index of the release published at ``path``, None if it holds all its documents itself."""
    folder = f"{current_release(spark, path).rstrip('/')}/{INDEX}"
    target, fs = _hadoop(spark, folder)
    return spark.read.schema(INDEX_SCHEMA).parquet(folder) if fs.exists(target) else None


def index_folders(index: DataFrame) -> list[str]:
    """Names of the release folders that an index has documents in."""
    return [row.folder for row in index.select(F.split("file", "/")[0].alias("folder")).distinct().collect()]


def _replace(spark: SparkSession, fs, source, target) -> None:
    """Rename that replaces what is at ``target``, whatever the store's plain rename does then."""
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("OVERWRITE")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(source), fs.makeQualified(target), options)


def rename_over(spark: SparkSession, fs, source, target) -> None:
    """Plain rename, which some stores refuse where ``target`` is there; then the replacing one."""
    try:
        done = fs.rename(source, target)
    except Py4JJavaError:
        done = False
    if not done:
        _replace(spark, fs, source, target)


def switch_release(spark: SparkSession, path: str, release: str) -> None:
    """Make ``release``, a folder of :func:`new_release`, the published one."""
    root = path.rstrip("/")
    fs, at = store(spark, root), spark._jvm.org.apache.hadoop.fs.Path
    draft = at(f"{root}/{CURRENT}.{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray(release.rsplit("/", 1)[1].encode()))
    finally:
        out.close()
    # earlier pointers had a checksum file, which a second rename replaced
    fs.delete(at(f"{root}/.{CURRENT}.crc"), False)
    rename_over(spark, fs, draft, at(f"{root}/{CURRENT}"))


def remove_superseded(spark: SparkSession, path: str) -> None:
    """Delete what the current release does not need: earlier ones, those left by jobs that died, and loose documents.

    An earlier release folder stays whole as long as the index names one of its documents.
    """
    needed = {current_release(spark, path).rsplit("/", 1)[1]}
    index = read_index(spark, path)
    if index is not None:
        needed |= set(index_folders(index))
    root, fs = _hadoop(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        old = status.isDirectory() and name.startswith(PREFIX) and name not in needed
        if old or name.endswith(".json") or name.startswith(f"{CURRENT}."):
            fs.delete(status.getPath(), True)
