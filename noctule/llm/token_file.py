"""Token ids in Simple-8b files: 64-bit words of a 4-bit selector and equally wide values.

A file holds whole documents in ascending id order. Ids are coded in blocks of ``BLOCK`` that do not
share words, and the word offset of each block is stored, so any block, and all blocks side by side, can
be decoded without what is before. A value that needs more than 60 bits is coded as 0 and listed with
its place among the file's escapes.

Encoding and decoding go over all blocks of a buffer at once: for every place the widest selector that
fits is found from counts of too wide values, then one step per word follows the choices in all blocks
together. Little-endian throughout:

    magic 8 bytes | n_docs, n_ids, n_blocks, n_words, n_escapes as u64
    doc ids i64[n_docs] | doc id present u8[n_docs] | doc starts u64[n_docs + 1]
    block offsets u64[n_blocks + 1] | escape places u64 | escape values u64 | words u64[n_words]

Tasks write one range of document ids each, in files of at most ``file_ids`` ids (one document at least),
and :mod:`files` commits them. Null texts are empty and have the end id alone; null document ids come last.
Rows with equal ids lie next to each other, those with equal texts as well. No rows give no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import scratch_scope
from .bpe import default_path, encoder
from .files import Attempt, commit, one_task_each, read_file, shared_folder
from .frames import ship

# Fixed values of the format: values per word and bits per value, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 2048
# Blocks decoded together, few enough for the processor's caches.
BLOCKS = 128
MAGIC = b"NOCTS8B1"
# Ids encoded at once and ids in a file.
BUFFER_IDS = 1 << 21
FILE_IDS = 1 << 26


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, word offset of each block (one more than blocks), places of escaped values."""
    values = values.astype(np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    escaped = np.flatnonzero(values >= np.uint64(1 << 60))
    wide = BLOCK + int(COUNTS[0])
    grid = np.zeros((blocks, wide), np.uint64)
    flat = np.zeros(blocks * BLOCK, np.uint64)
    flat[:n] = values
    flat[escaped] = 0
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    line = grid.ravel()
    bits = np.frexp(np.arange(1 << 16))[1].astype(np.int8)[line] if n and values.max() < 1 << 16 else np.frexp(line.astype(np.float64))[1].astype(np.int8)
    choice = np.full(len(line), len(COUNTS) - 1, np.int8)
    # widest value of the next 1, 2, 3, ... places: the next ``seen`` places and as many from ``more`` on, which overlap or meet
    widest, seen = bits, 1
    for s in range(len(COUNTS) - 2, -1, -1):
        more = int(COUNTS[s]) - seen
        widest = np.concatenate([np.maximum(widest[:-more], widest[more:]), widest[-more:]])
        seen += more
        fits = widest <= np.int8(BITS[s])
        # what fits many values fits fewer in wider fields: beyond the first miss nothing fits
        if not fits.reshape(blocks, wide)[:, :BLOCK].any():
            break
        choice -= fits.view(np.int8)
    if not blocks:
        return np.empty(0, np.uint64), np.zeros(1, np.uint64), escaped
    last = np.minimum(np.arange(1, blocks + 1) * BLOCK, n) - np.arange(blocks) * BLOCK
    # one step per word through all blocks together; a block that is done stands still in its padding
    jump = COUNTS[choice].astype(np.int32)
    jump.reshape(blocks, wide)[:, BLOCK:] = 0
    jump.reshape(blocks, wide)[-1, last[-1] :] = 0
    at = (np.arange(blocks) * wide).astype(np.int32)
    steps = []
    while (step := jump[at]).any():
        steps.append((at, step > 0))
        at = at + step
    taken = np.stack([going for _, going in steps], axis=1)
    at = np.stack([place for place, _ in steps], axis=1)[taken].astype(np.intp)
    chosen = choice[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.flatnonzero(np.bincount(chosen)):
        if BITS[s]:
            mine = np.flatnonzero(chosen == s)
            place, packed = at[mine], words[mine]
            for k in range(COUNTS[s]):
                packed |= line[place] << np.uint64(k * BITS[s])
                place += 1
            words[mine] = packed
    return words, np.concatenate([[0], np.cumsum(taken.sum(axis=1))]).astype(np.uint64), escaped


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of these blocks; every block but the last is full."""
    out = np.empty(n, np.uint64)
    offsets = offsets.astype(np.int64)
    for block in range(0, len(offsets) - 1, BLOCKS):
        some = offsets[block : block + BLOCKS + 1]
        part = _decoded(words[some[0] : some[-1]], some - some[0])
        out[block * BLOCK :][: len(part)] = part[: n - block * BLOCK]
    return out


def _decoded(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """All places of these blocks, the last one's padding too."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = COUNTS[selector]
    start = np.cumsum(counts) - counts
    # a block's last word may run over its end, so each block has room for that
    wide = BLOCK + int(COUNTS[0])
    blocks = len(offsets) - 1
    start += np.repeat(np.arange(blocks) * wide - start[offsets[:-1]], np.diff(offsets))
    out = np.zeros(blocks * wide, np.uint64)
    for s in np.flatnonzero(np.bincount(selector)):
        if BITS[s]:
            mine = np.flatnonzero(selector == s)
            mask, place, word = np.uint64((1 << int(BITS[s])) - 1), start[mine], words[mine]
            for k in range(COUNTS[s]):
                out[place] = (word >> np.uint64(k * BITS[s])) & mask
                place += 1
    return out.reshape(blocks, wide)[:, :BLOCK].ravel()


class _Writer:
    """Documents of one file, encoded buffer by buffer; whole blocks only until the end."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.rest: list[np.ndarray] = []
        self.waiting = self.total = 0
        self.words: list[np.ndarray] = []
        self.offsets = [np.zeros(1, np.uint64)]
        self.escapes: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.rest.append(ids)
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= BUFFER_IDS:
            self._encode(self.waiting // BLOCK * BLOCK)

    def _encode(self, n: int) -> None:
        values = np.concatenate(self.rest) if self.rest else np.empty(0, np.uint32)
        words, offsets, escaped = encode(values[:n])
        self.escapes.append((escaped + (self.total - self.waiting), values[:n][escaped]))
        self.words.append(words)
        self.offsets.append(offsets[1:] + self.offsets[-1][-1])
        self.rest = [values[n:]]
        self.waiting -= n

    def save(self, folder: str, name: str) -> Attempt:
        self._encode(self.waiting)
        words, offsets = np.concatenate(self.words), np.concatenate(self.offsets)
        places, values = (np.concatenate(x).astype("<u8") for x in zip(*self.escapes, strict=True))
        out = Attempt(folder, name)
        out.write(MAGIC + np.array([len(self.ids), self.total, len(offsets) - 1, len(words), len(places)], "<u8").tobytes())
        out.write(np.array([x or 0 for x in self.ids], "<i8").tobytes())
        out.write(np.array([x is not None for x in self.ids], np.uint8).tobytes())
        out.write(np.concatenate([[0], np.cumsum(self.sizes)]).astype("<u8").tobytes())
        for part in (offsets, places, values, words):
            out.write(part.astype("<u8").tobytes())
        out.close()
        return out


def load(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, which of them are not null, document starts (one more than documents), all ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks, n_words, n_escapes = (int(x) for x in np.frombuffer(data, "<u8", 5, 8))
    at = 48

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    doc_ids, present, starts = take("<i8", n_docs), take("u1", n_docs), take("<u8", n_docs + 1)
    offsets, places, values = take("<u8", n_blocks + 1), take("<u8", n_escapes), take("<u8", n_escapes)
    ids = decode(take("<u8", n_words), offsets, n_ids)
    ids[places.astype(np.int64)] = values
    return doc_ids, present.astype(bool), starts.astype(np.int64), ids


MANIFEST = pa.schema([("part", pa.int64()), ("piece", pa.int64()), ("temp", pa.string()), ("name", pa.string()), ("bytes", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
MANIFEST_SQL = "part long, piece long, temp string, name string, bytes long, n_docs long, n_ids long"


def write_tokens(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, file_ids: int = FILE_IDS, plain_names: bool = False) -> DataFrame:
    """Write all documents to ``folder`` and return the committed manifest, one row per file. ``plain_names``: see :mod:`noctule.llm.bpe`."""
    ship(df.sparkSession)
    path = tokenizer or default_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece = TaskContext.get().partitionId(), 0
        writer, encode_arrays = _Writer(), encoder(path, plain_names).encode_arrays

        def done() -> pa.RecordBatch:
            out = writer.save(folder, f"tokens-{part:06d}-{piece:04d}.s8b")
            return pa.RecordBatch.from_pylist([{"part": part, "piece": piece, "temp": out.temp, "name": out.name, "bytes": out.size, "n_docs": len(writer.ids), "n_ids": writer.total}], MANIFEST)

        for batch in batches:
            doc_ids = batch.column("id").to_pylist()
            for at, ids, edges in encode_arrays(batch.column("text"), end_id):
                for doc_id, a, b in zip(doc_ids[at : at + len(edges) - 1], edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if writer.total and writer.total + b - a > file_ids:
                        yield done()
                        writer, piece = _Writer(), piece + 1
                    writer.add(doc_id, ids[a:b])
        if writer.ids:
            yield done()

    id_, text = F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    order = [F.col("id").asc_nulls_last(), F.col("th")]
    ranged = df.select(id_, text, F.xxhash64(text).alias("th")).repartitionByRange(*order).sortWithinPartitions(*order)
    with scratch_scope(df.sparkSession):
        return commit(ranged.drop("th").mapInArrow(write, MANIFEST_SQL), folder)


READ_SQL = "id long, local_start long, n_tokens long, ids_crc32 long, part long, piece long"


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` among all ids, ``n_tokens`` and ``ids_crc32``."""
    out = pa.schema([(n, pa.int64()) for n in ("id", "local_start", "n_tokens", "ids_crc32", "part", "piece")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with read_file(folder, row["name"]) as source:
                    doc_ids, present, starts, ids = load(source.read())
                raw = memoryview(ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=~present), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64()), pa.array(np.full(n, row["part"])), pa.array(np.full(n, row["piece"]))],
                    schema=out,
                )

    # one row per file: where each file starts among all ids
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    docs = one_task_each(manifest).mapInArrow(read, READ_SQL)
    return docs.join(F.broadcast(files.select("part", "piece", "base")), ["part", "piece"]).select(
        F.col("id").alias("doc_id"), (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def roundtrip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write ``df``'s documents to a new shared folder and read the files back."""
    folder = shared_folder(df.sparkSession, "tokens")
    return read_tokens(write_tokens(df, folder, id_col, text_col, **options), folder)
