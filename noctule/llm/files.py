"""Files that tasks write themselves: temporary names, a manifest, then final names.

A task writes under a name of its own attempt and reports it as a manifest row. The manifest is a table
that Spark commits, so rows of lost or repeated attempts are not in it. A second step gives the listed
files their final names, each task its own share, and may run again: what has its name already is left.
Readers take the file names from the committed manifest, never from a listing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ..runtime import materialize, scratch_dir


def shared_folder(spark: SparkSession, name: str, where: str | None = None) -> str:
    """A new folder under ``where`` (default: the shared scratch folder), with the scheme of the session's file system."""
    base = where or scratch_dir(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    if whole.startswith("file:") and where and "://" not in where and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{where} is a folder of one machine; name its file system")
    return whole


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; ``file:/x`` as Hadoop writes it is understood, ``s3a`` is ``s3``."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a:", "s3:", 1))


# Renames in one task.
NAMES_PER_TASK = 64


class Attempt:
    """One file being written under a temporary name."""

    def __init__(self, folder: str, name: str) -> None:
        self.name, self.temp = name, f"_{name}.{uuid.uuid4().hex}.tmp"
        where, path = opened(folder)
        where.create_dir(path, recursive=True)
        self.out = where.open_output_stream(f"{path}/{self.temp}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()


def _renamed(folder: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = opened(folder)
        for batch in batches:
            for temp, name, size in zip(*[batch.column(c).to_pylist() for c in ("temp", "name", "bytes")], strict=True):
                source, target = f"{path}/{temp}", f"{path}/{name}"
                have = where.get_file_info([source, target])
                if have[0].type == fs.FileType.File:
                    where.move(source, target)
                    have = [None, where.get_file_info(target)]
                if have[1].type != fs.FileType.File or have[1].size != size:
                    raise FileNotFoundError(f"{target} of {size} bytes")
            yield batch

    return step


def commit(written: DataFrame, folder: str) -> DataFrame:
    """Run the writing tasks of ``written`` (rows with ``temp``, ``name``, ``bytes``) and give the files their names.

    Returns the committed manifest.
    """
    counts: dict[str, int] = {}
    listed = materialize(written, "listed", counts)
    spread = listed.repartition(max(1, counts["listed"] // NAMES_PER_TASK))
    return materialize(spread.mapInArrow(_renamed(folder), listed.schema), "manifest", keep=True)


def one_task_each(manifest: DataFrame) -> DataFrame:
    """``manifest`` with every file in a task of its own; the rows are few and small, so Spark would join them."""
    return manifest.repartition(max(1, manifest.count()))


def read_file(folder: str, name: str) -> pa.NativeFile:
    where, path = opened(folder)
    return where.open_input_stream(f"{path}/{name}", compression=None)
