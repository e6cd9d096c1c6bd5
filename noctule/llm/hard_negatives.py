"""Hard negatives of anchors, by exact integer scores from subset-sum tables ("Four Russians", Arlazarov et al. 1970).

Vectors become whole numbers, floor(``scale`` * x), and a score is their inner product. A candidate's components are kept as
bit planes in two's complement, packed for each group of eight dimensions into one byte per plane. For an anchor and a group
there is a table of the sums of its eight components over all 256 subsets. A plane's byte is the place in that table, so
a candidate's score is the sum of its planes, doubled from plane to plane, of one table entry per group: no product is
formed, and no score is approximate.

Anchors are handled in blocks of at most ``BLOCK_BYTES`` of tables' source rows, which is the bound of what is sent to the tasks
and passes through the driver at once; every block meets all rows:

1. Rows of the anchor's label are scored, and every task keeps the best ``positives`` of each anchor; merged over tasks they are
   the anchor's positives.
2. Rows of other labels are scored, and every task keeps, per anchor and positive, the best ``negatives`` whose score is between
   ``lower`` and ``upper`` percent of the positive's. What a task holds is bounded by the block; what is shuffled is the kept rows.

Higher scores come first, of equal ones the smaller id, a null id last. Rows with a null label, a null vector or any null
or non-finite component take no part. Shorter vectors count as filled up with zeros. An id stands for one item: rows with the
anchor's id are never its positives or negatives, rows of equal id and score count once, and of several anchors with one id the
least by label and bits is used. Labels are whole numbers. Anchors without positives and positives without negatives give no rows.
Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import materialize, scratch_scope
from .frames import LAST_ID, ship

GROUP = 8
# Bytes of the anchors' packed rows in one block.
BLOCK_BYTES = 4 << 20
# Anchors whose tables are held at once, and candidates scored against them at once.
ANCHORS, CANDIDATES = 256, 1024
# Rows of a task where there are enough of them.
TASK_ROWS = 1 << 20
LEAST_TASK_ROWS = 1 << 12
PACKED = "id long, label long, planes binary, anchor boolean"


def packed_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Bytes (rows x planes x groups) of whole numbers (rows x dimensions) that fit ``bits`` bits in two's complement."""
    rows, dims = values.shape
    groups = -(-dims // GROUP)
    wide = np.zeros((rows, groups * GROUP), np.int64)
    wide[:, :dims] = values
    out = np.empty((rows, bits, groups), np.uint8)
    for b in range(bits):
        out[:, b] = np.packbits((wide >> b & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def unpacked_values(planes: np.ndarray) -> np.ndarray:
    """The whole numbers of :func:`packed_planes`, dimensions filled up to full groups."""
    bits = planes.shape[1]
    flags = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weight = np.array([1 << b for b in range(bits - 1)] + [-1 << bits - 1], np.int64)
    return np.einsum("nbd,b->nd", flags, weight)


def _whole(bound: int) -> type:
    return np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64


class SubsetSums:
    """Tables of some anchors (rows x dimensions): ``tables[g][mask, anchor]`` is the sum of a group's components in ``mask``."""

    def __init__(self, anchors: np.ndarray, bits: int) -> None:
        n, dims = anchors.shape
        # no sum over components is greater, and no score than this times the planes' weight
        reach = int(np.abs(anchors).sum(axis=1).max(initial=0))
        self.bits, self.plane, self.score = bits, _whole(reach), _whole(reach << bits)
        self.tables = []
        for g in range(dims // GROUP):
            table = np.zeros((1 << GROUP, n), self.plane)
            for j in range(GROUP):
                table[1 << j : 2 << j] = table[: 1 << j] + anchors[:, g * GROUP + j].astype(self.plane)
            self.tables.append(table)
        self.n = n

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """Inner products (candidates x anchors) of the candidates' packed planes."""
        total = np.zeros((len(planes), self.n), self.score)
        one, entry = np.empty((2, len(planes), self.n), self.plane)
        for b in range(self.bits - 1, -1, -1):
            one[:] = 0
            for g, table in enumerate(self.tables):
                np.take(table, planes[:, b, g], axis=0, out=entry, mode="clip")
                one += entry
            total += total
            # the sign's plane is the first, with a negative weight
            if b == self.bits - 1:
                total -= one
            else:
                total += one
        return total


class Best:
    """The first ``keep`` of (score, id) in every group, higher scores first, then smaller ids; equal ones count once."""

    def __init__(self, groups: int, keep: int) -> None:
        self.groups, self.keep = groups, keep
        self.held = [np.empty(0, np.int64)] * 3
        self.waiting: list[list[np.ndarray]] = []
        self.n_waiting = 0
        # scores below cannot come in
        self.least = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(group):
            self.waiting.append([group, score.astype(np.int64), ids])
            self.n_waiting += len(group)
            if self.n_waiting > len(self.held[0]) + 4096:
                self.settle()

    def settle(self) -> list[np.ndarray]:
        if self.waiting:
            group, score, ids = (np.concatenate(x) for x in zip(self.held, *self.waiting))
            order = np.lexsort((ids, -score, group))
            group, score, ids = group[order], score[order], ids[order]
            new = np.ones(len(group), bool)
            new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
            group, score, ids = group[new], score[new], ids[new]
            first = np.searchsorted(group, np.arange(self.groups))
            stays = np.arange(len(group)) - first[group] < self.keep
            self.held = [group[stays], score[stays], ids[stays]]
            full = first + self.keep - 1
            fits = full < len(group)
            fits[fits] = group[full[fits]] == np.flatnonzero(fits)
            self.least[fits] = score[full[fits]]
            self.waiting, self.n_waiting = [], 0
        return self.held


class Block:
    """A bounded number of anchors by label, as sent to the tasks."""

    def __init__(self, rows: pa.Table, bits: int, groups: int) -> None:
        order = np.argsort(rows["label"].to_numpy(), kind="stable")
        self.ids, self.labels = rows["id"].to_numpy()[order], rows["label"].to_numpy()[order]
        self.planes = _planes(rows["planes"].combine_chunks(), bits, groups)[order]
        self.bits, self.groups = bits, groups

    def parts(self, by_label: bool) -> Iterator[tuple[slice, SubsetSums]]:
        """At most ``ANCHORS`` anchors each; with ``by_label`` new labels begin a part once there are a quarter as many."""
        values, cuts = unpacked_values(self.planes), [0]
        for start in np.flatnonzero(np.diff(self.labels)) + 1 if by_label else []:
            if start - cuts[-1] >= ANCHORS // 4:
                cuts.append(int(start))
        for first, end in zip(cuts, [*cuts[1:], len(self.ids)], strict=True):
            for at in range(first, end, ANCHORS):
                part = slice(at, min(at + ANCHORS, end))
                yield part, SubsetSums(values[part], self.bits)


def _planes(column: pa.Array, bits: int, groups: int) -> np.ndarray:
    if bits * groups == 0 or not len(column):
        return np.zeros((len(column), bits, groups), np.uint8)
    width = bits * groups
    offset = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8)[offset : offset + width * len(column)].reshape(-1, bits, groups)


def _candidates(batches: Iterator[pa.RecordBatch], bits: int, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        yield batch.column("id").to_numpy(), batch.column("label").to_numpy(), _planes(batch.column("planes"), bits, groups)


def _positives(block: Block, keep: int):
    """Per task the best rows of each anchor's own label."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(block.parts(by_label=True))
        best = [Best(sums.n, keep) for _, sums in parts]
        for ids, labels, planes in _candidates(batches, block.bits, block.groups):
            by_label = np.argsort(labels, kind="stable")
            low, high = (np.searchsorted(labels[by_label], block.labels, side) for side in ("left", "right"))
            for (part, sums), b in zip(parts, best):
                # the rows of all labels of these anchors, one stretch since both are in the order of labels
                mine = by_label[low[part][0] : high[part][-1]]
                for at in range(0, len(mine), CANDIDATES):
                    some = mine[at : at + CANDIDATES]
                    score = sums.scores(planes[some])
                    fits = (score >= b.least) & (labels[some][:, None] == block.labels[part]) & (ids[some][:, None] != block.ids[part])
                    row, anchor = np.nonzero(fits)
                    b.add(anchor, score[row, anchor], ids[some][row])
        for (part, _), b in zip(parts, best):
            anchor, score, ids = b.settle()
            yield pa.RecordBatch.from_arrays([pa.array(block.ids[part][anchor]), pa.array(ids), pa.array(score)], names=["anchor_id", "positive_id", "positive_score"])

    return scan


def _negatives(block: Block, positive_ids: np.ndarray, positive_scores: np.ndarray, known: np.ndarray, keep: int, lower: int, upper: int):
    """Per task the best rows of other labels in the band under each positive (anchors x positives)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(block.parts(by_label=False))
        many = positive_ids.shape[1]
        floor = np.where(known, -((-lower * positive_scores) // 100), 0)
        top = np.where(known, upper * positive_scores // 100, -1)
        # anchors x positives lie flat in the groups of a part
        best = [Best(sums.n * many, keep) for _, sums in parts]
        for b, (part, _) in zip(best, parts):
            b.least = floor[part].ravel().copy()
        for ids, labels, planes in _candidates(batches, block.bits, block.groups):
            for at in range(0, len(ids), CANDIDATES):
                some = slice(at, at + CANDIDATES)
                for (part, sums), b in zip(parts, best):
                    score = sums.scores(planes[some])
                    other = (labels[some][:, None] != block.labels[part]) & (ids[some][:, None] != block.ids[part])
                    for k in range(many):
                        fits = other & (score >= b.least[k::many]) & (score <= top[part, k])
                        row, anchor = np.nonzero(fits)
                        b.add(anchor * many + k, score[row, anchor], ids[some][row])
        for (part, _), b in zip(parts, best):
            group, score, ids = b.settle()
            anchor, k = group // many, group % many
            columns = [block.ids[part][anchor], positive_ids[part][anchor, k], ids, positive_scores[part][anchor, k], score]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    return scan


def _pack(bits: int, dims: int, scale: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            values = np.zeros((len(sizes), dims), np.int64)
            values[row, place] = np.floor(scale * vectors.flatten().to_numpy().astype(np.float64))
            planes = packed_planes(values, bits)
            width = planes.shape[1] * planes.shape[2]
            column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((np.arange(len(sizes) + 1) * width).astype(np.int32)), pa.py_buffer(planes.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), column, batch.column("anchor")], names=["id", "label", "planes", "anchor"])

    return scan


def first_of(rows: DataFrame, by: list[str], score: str, id_: str, keep: int) -> DataFrame:
    """The first ``keep`` of each group of what the tasks kept, with ``rank`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(id_))
    return rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def hard_negatives(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    lower: int = 30,
    upper: int = 90,
    scale: float = 256.0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``.

    ``anchor`` says which rows are anchors (default: ids divisible by 100). ``lower`` and ``upper`` are whole percents.
    """
    spark = df.sparkSession
    ship(spark)
    id_, label, vector = (F.col(f"`{c}`") for c in (id_col, label_col, vector_col))
    given = F.col(f"`{id_col}`") % 100 == 0 if anchor is None else anchor
    rows = df.select(
        F.coalesce(id_.cast("long"), F.lit(LAST_ID)).alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("vector"), F.coalesce(given, F.lit(False)).alias("anchor")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    size, low, high = rows.agg(F.max(F.size("vector")), F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    dims = size or 0
    ends = [math.floor(scale * x) for x in (low or 0.0, high or 0.0)]
    bits = max((x if x >= 0 else ~x).bit_length() for x in ends) + 1
    if dims << 2 * bits >= 1 << 62:
        raise ValueError(f"{dims} components of {bits} bits do not fit a score")
    groups = -(-dims // GROUP)

    with scratch_scope(spark):
        counts: dict[str, int] = {}
        packed = materialize(rows.mapInArrow(_pack(bits, dims, scale), PACKED), "packed", counts)
        tasks = max(1, min(-(-counts["packed"] // LEAST_TASK_ROWS), max(spark.sparkContext.defaultParallelism, -(-counts["packed"] // TASK_ROWS))))
        packed = materialize(packed.repartition(tasks), "dealt")
        least = packed.where("anchor").groupBy("id").agg(F.min(F.struct("label", "planes")).alias("a"))
        anchors = materialize(least.select("id", "a.label", "a.planes"), "anchors", counts)
        per_block = max(1, block_bytes // max(1, bits * groups + 16))
        n_blocks = -(-counts["anchors"] // per_block)
        # dealt in turn from each file, so a block has at most a row per file beyond its share
        numbered = materialize(anchors.repartition(max(1, n_blocks)).select("*", F.spark_partition_id().alias("block")), "blocks")
        done = []
        for number in range(n_blocks):
            block = Block(numbered.where(F.col("block") == number).drop("block").toArrow(), bits, groups)
            done.append(materialize(_of_block(packed, block, positives, negatives, lower, upper), "mined", keep=True))
    if not done:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    named = [F.when(F.col(c) != LAST_ID, F.col(c)).alias(c) if c.endswith("_id") else F.col(c) for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    return out.select(*named)


def _of_block(packed: DataFrame, block: Block, positives: int, negatives: int, lower: int, upper: int) -> DataFrame:
    found = packed.mapInArrow(_positives(block, positives), "anchor_id long, positive_id long, positive_score long")
    # at most ``positives`` rows for each anchor of the block
    mine = first_of(found, ["anchor_id"], "positive_score", "positive_id", positives).toArrow()
    place = {a: k for k, a in enumerate(block.ids.tolist())}
    shape = (len(block.ids), positives)
    ids, scores, known = np.zeros(shape, np.int64), np.zeros(shape, np.int64), np.zeros(shape, bool)
    at = np.array([place[a] for a in mine["anchor_id"].to_pylist()], np.int64), mine["rank"].to_numpy() - 1
    ids[at], scores[at], known[at] = mine["positive_id"].to_numpy(), mine["positive_score"].to_numpy(), True
    fields = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = packed.mapInArrow(_negatives(block, ids, scores, known, negatives, lower, upper), fields)
    return first_of(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
