"""Row handling shared by the operators: carried columns, row keys, Arrow output."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..runtime import ship_package

__all__ = ["LAST_ID", "arrow_schema", "batch_of", "drop_held", "held", "row_key", "row_struct", "ship", "unpacked", "with_row"]

# Stands for a null id where ids are compared: such rows come after all others.
LAST_ID = (1 << 63) - 1

# Bytes of a batch that goes to a worker: 10,000 whole texts at once are held several times on both sides.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make the package known to the workers, and batches small unless the session names a size itself."""
    ship_package(spark)
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def row_struct(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``row``, so that no name clashes with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns], F.lit(0).alias("__pad")).alias("row")


def unpacked(df: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """The ``columns`` held in ``row`` and the added ones; an added column takes the place of one of its name."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns if c not in added], *added)


def row_key(id_col: str, text: str) -> tuple[Column, Column]:
    """Id (null last) and a hash of the text: rows that agree in both are copies and get the same result."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def with_row(df: DataFrame, fields: str) -> T.StructType:
    """The schema of ``row`` as ``df`` has it and of further ``fields``."""
    return T.StructType([T.StructField("row", df.schema["row"].dataType, True), *T.StructType.fromDDL(fields).fields])


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch of arrays, lists or numpy arrays."""
    return pa.RecordBatch.from_arrays([x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema)


# How to drop what this worker process holds between tasks, by name.
_HELD: dict[str, Callable[[], None]] = {}


def held(name: str, drop: Callable[[], None]) -> None:
    """Tell that this worker process holds something large for its next tasks of one kind."""
    _HELD[name] = drop


def drop_held() -> None:
    """Called by tasks of other kinds: a worker process serves all stages of an application."""
    while _HELD:
        _HELD.popitem()[1]()
