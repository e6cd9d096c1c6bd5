"""Packing of token sequences: large items are matched in pairs, small ones best-fit the gaps.

A document's ids and an end id are cut into pieces of at most ``capacity`` ids (only longer documents; the
first piece takes the remainder). Above a third of the capacity at most two pieces share a sequence, so
large pieces are matched greedily, the longest first with the longest partner that still fits. Smaller
pieces, longest first, go where the least room is left over, or open a sequence.

Lengths are whole numbers up to the capacity, so this plan needs only the number of pieces per length. It is
made on the driver from that histogram, for runs of equal sequences at a time, and its size does not depend
on the number of documents. Pieces get their place by their rank among pieces of their length: tasks count
as they write pieces, one small row per task and length gives where each task's ranks begin.

Null texts are empty: one piece with the end id alone. Rows with equal or null ids are packed each for itself.
No rows give no pieces. Extra columns are not carried.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import materialize
from .bpe import default_path, encoder
from .frames import ship

# A run of equal sequences: how many, and the lengths in each, in order.
Run = tuple[int, list[int]]


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """Sequences for ``counts`` pieces per length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must be 1 to {capacity}")
    large = sorted(n for n in left if 3 * n > capacity)
    # open sequences by the room they have left
    rooms: dict[int, list[Run]] = defaultdict(list)
    order: list[int] = []

    def put(room: int, n: int, lengths: list[int]) -> None:
        if n:
            if not rooms[room]:
                insort(order, room)
            rooms[room].append((n, lengths))

    for a in reversed(large):
        at = bisect_left(large, min(a, capacity - a) + 1) - 1
        while left[a] and at >= 0:
            b = large[at]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            left[a] -= n
            left[b] -= n
            put(capacity - a - b, n, [a, b])
            at -= 1
        put(capacity - a, left[a], [a])
        left[a] = 0
    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        n = left[s]
        while n:
            at = bisect_left(order, s)
            if at == len(order):
                # nothing has room: as many as fit into each new sequence
                each = capacity // s
                put(capacity - each * s, n // each, [s] * each)
                if n % each:
                    put(capacity - n % each * s, 1, [s] * (n % each))
                break
            room = order[at]
            have, lengths = rooms[room].pop()
            if not rooms[room]:
                order.pop(at)
            each = room // s
            full = min(have, n // each)
            put(room - each * s, full, lengths + [s] * each)
            n -= full * each
            have -= full
            if have and n:
                # fewer than one sequence takes
                put(room - n * s, 1, lengths + [s] * n)
                have -= 1
                n = 0
            put(room, have, lengths)
    return [run for runs in rooms.values() for run in runs]


class Places:
    """Sequence and offset of the piece of each rank within its length."""

    def __init__(self, runs: list[Run]) -> None:
        slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        base = 0
        for n, lengths in runs:
            offset = 0
            for length in lengths:
                slots[length].append((n, base, offset))
                offset += length
            base += n
        self.sequences = base
        self.table = {}
        for length, rows in slots.items():
            n, first, offset = np.array(rows, np.int64).T
            self.table[length] = (np.concatenate([[0], np.cumsum(n)]), first, offset)

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            mine = lengths == length
            ends, first, offsets = self.table[length]
            slot = np.searchsorted(ends, ranks[mine], "right") - 1
            sequence[mine] = first[slot] + ranks[mine] - ends[slot]
            offset[mine] = offsets[slot]
        return sequence, offset


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int64()), ("nth", pa.int64())])
PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
PACKED_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, tokenizer: str | None = None, end_id: int = 2, plain_names: bool = False) -> DataFrame:
    """Pieces of all documents; ``nth`` counts a task's pieces of each length. ``plain_names``: see :mod:`noctule.llm.bpe`."""
    ship(df.sparkSession)
    path = tokenizer or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encode_arrays = encoder(path, plain_names).encode_arrays
        for batch in batches:
            doc_ids = batch.column("id").to_pylist()
            for at, ids, places in encode_arrays(batch.column("text"), end_id):
                raw, rows = memoryview(ids.tobytes()), []
                for doc_id, begin, end in zip(doc_ids[at : at + len(places) - 1], places[:-1].tolist(), places[1:].tolist(), strict=True):
                    n = end - begin
                    first = n % capacity or capacity
                    edges = [0, *range(first, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                        rows.append((doc_id, k, a, b - a, zlib.crc32(raw[4 * (begin + a) : 4 * (begin + b)]), part, int(seen[b - a])))
                        seen[b - a] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)

    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(cut, PIECES_SQL)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Pieces (of :func:`cut_pieces`) with ``sequence_id`` and ``offset``."""
    pieces = materialize(pieces, "pieces")
    per_task = materialize(pieces.groupBy("part", "length").count(), "piece_counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    places = Places(plan(counts, capacity))
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = materialize(per_task.select("part", "length", F.coalesce(before, F.lit(0)).alias("base")), "piece_bases")
    ranked = pieces.join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    out = pa.schema([f for f in PIECES if f.name not in ("part", "nth")] + [("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], schema=out)

    return ranked.mapInArrow(place, PACKED_SQL)


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, **options) -> DataFrame:
    """All documents of ``df`` in sequences of at most ``capacity`` ids: one row per piece."""
    return pack(cut_pieces(df, id_col, text_col, capacity, **options), capacity)
