"""Session helpers: lineage cuts and the size limits operators check before they broadcast."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# A side is broadcast only after its rows were counted and found at or below this bound.
BROADCAST_MAX_ROWS = 200_000

_LOCAL_FALLBACK: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is made only in
    local mode, where the driver and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="noctule-")
    return _LOCAL_FALLBACK[app]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the session's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def in_scratch(spark: SparkSession, path: str) -> bool:
    """``path`` lies in the shared folder that the cluster names, with or without a scheme."""
    try:
        shared = scratch_dir(spark)
    except ValueError:
        return False
    return ".." not in path.split("/") and qualified(spark, path).startswith(qualified(spark, shared).rstrip("/") + "/")


# Paths written inside the open scratch scopes, the innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are removed at the end, but for those materialized with ``keep``.

    What leaves the scope must not be lazy over a removed table: materialize it with ``keep`` first.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str = "step", counts: dict[str, int] | None = None, keep: bool = False, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, in partitions of column ``by`` if given, and read it back.

    Later plans start from files, so a lost executor costs a re-read and not a recomputation,
    and the optimizer sees real sizes. The rows written are put in ``counts`` under ``label``; they are
    observed while writing and cost no job of their own.
    """
    spark = df.sparkSession
    if counts is not None:
        seen = Observation()
        out = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), label, keep=keep, by=by)
        counts[label] = seen.get["rows"]
        return out
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scopes = _SCOPES[:-1] if keep else _SCOPES
    if scopes:
        scopes[-1].append(path)
    df.write.mode("errorifexists").parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast for a side whose counted ``rows`` are within ``limit``, else leave it to shuffle."""
    return F.broadcast(df) if rows <= limit else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application.

    Workers only find what is installed, in their working directory or shipped; jobs submitted with
    ``--py-files`` have it already and lose nothing here.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="noctule-ship-")) / "noctule.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    # Spark itself copies the archive from the driver to every executor
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
