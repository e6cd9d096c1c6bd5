"""Near-duplicates: weighted min-hashes of TF-IDF shingles, banded and verified.

A text is the multiset of its five-word shingles (the whole text if it is shorter). A shingle's weight is its count
times the mean IDF of its words, 1 + ln(documents / documents with the word). Words in less than ``FREQUENT`` of the
documents share the IDF of that share. Counts are summed in Spark, and only those of frequent words come to the driver.

1. Rows with equal texts fold to one node, the smallest id.
2. Signatures are weighted min-hashes over whole texts (Christiani 2020, "DartMinHash"). A shingle throws darts in time, as a
   Poisson process over its weight, and every dart falls on one of the ``SAMPLES`` samples; a sample is its text's earliest dart.
   Darts come from the hash of shingle, layer of its count and number, so two texts agree in each sample with the probability of
   their weighted Jaccard similarity, independently, however uneven the weights. A text throws about 1,500 darts in all
   and not every shingle 200; darts are thrown on until no sample is empty.
3. Samples are banded. In every band bucket all nodes are compared with one hub only, the node with the most company over
   all its buckets: the text that others were copied from is in nearly all buckets of its copies. Pairs are verified by
   the weighted Jaccard similarity of the whole texts; verified pairs give components. A bucket of one component is done.
4. Other buckets are refined, without losing a link. Two texts u, v can share no more than the lesser of their overlaps
   with the hub and what both have beyond the hub: sum min(u, v) <= min(sum min(u, h), sum min(v, h)) + sum min(u - h, v - h).
   So a link the hub has not shown either fits the first term, which few pairs do and which are compared, or the texts
   share a shingle that the hub lacks. Nodes with the same such shingle make the buckets of the next round, in
   which the hub is not; the rounds end when every bucket is one component, or when the open buckets hold no more than a
   few pairs per text of the corpus, which are then compared. A bucket larger than that is never paired all with all.

A similarity of ``threshold`` is missed by banding with probability (1 - s^5)^40, about 1e-7 at 0.8.

Null texts are empty. Texts without words are grouped with equal texts only. Rows with equal ids count as one document, so
their groups are joined. Null ids are grouped like others; a class of null ids alone has a null class id. No rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import broadcast_if_small, materialize, scratch_scope
from .components import components
from .frames import ship
from .words import Texts, Words, alnum_words, blocks, lower_ascii, mix, signed, span_hashes, split_words, texts_of, window_hashes, window_starts, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
SAMPLES, ROWS = 200, 5
BANDS = SAMPLES // ROWS
# Darts a text throws at first: all samples have one then in seven of eight texts, the others throw more.
FIRST_DARTS = math.ceil(SAMPLES * (math.log(SAMPLES) + 2))
# Shingles and darts whose arrays are held at once.
AT_ONCE = 1 << 17
FREQUENT = 0.01
HASH_BITS = 48
# Open buckets are finished pair by pair once they hold no more pairs than so many per text of the corpus.
PAIRS_PER_TEXT = 4


class Idf(NamedTuple):
    """IDF of the frequent words (sorted hashes); all others have ``rest``."""

    hashes: np.ndarray
    values: np.ndarray
    rest: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.rest)
        if len(self.hashes):
            low = np.zeros(1 << 16, bool)
            low[self.hashes & 0xFFFF] = True
            some = np.flatnonzero(low[hashes & 0xFFFF])
            at = np.searchsorted(self.hashes, hashes[some])
            at[at == len(self.hashes)] = 0
            fits = self.hashes[at] == hashes[some]
            out[some[fits]] = self.values[at[fits]]
        return out


def lowered_words(texts: Texts) -> tuple[np.ndarray, Words]:
    data = lower_ascii()[texts.data]
    words = split_words(texts._replace(data=data), alnum_words())
    return word_hashes(data, words), words


def document_frequencies(docs: DataFrame, share: float = FREQUENT) -> Idf:
    """Exact document counts of all words in at least ``share`` of the rows of ``docs`` (column ``text``)."""
    total = docs.count()

    def different(block: Texts) -> np.ndarray:
        hashes, words = lowered_words(block)
        key = words.row_of().astype(np.uint64) << np.uint64(HASH_BITS) | hashes >> np.uint64(64 - HASH_BITS)
        _, first = np.unique(key, return_index=True)
        return signed(hashes)[first]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0

        def counted() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([np.empty(0, np.int64), *parts]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])

        for batch in batches:
            for _, block in blocks(batch, "text"):
                parts.append(different(block))
                waiting += len(parts[-1])
                if waiting > 1 << 19:
                    yield counted()
                    parts, waiting = [], 0
        yield counted()

    rest = 1 + math.log(1 / share)
    sums = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    # at most (different words of a text) / share of them
    found = sums.where(F.col("n") >= share * total).toLocalIterator()
    table = sorted((r["h"], r["n"]) for r in found)
    h, n = (np.array(x) for x in zip(*table, strict=True)) if table else (np.empty(0, np.int64), np.empty(0))
    return Idf(h.astype(np.int64), 1 + np.log(total / np.maximum(n, 1)), rest)


def sums_by(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(group, values, n).astype(np.float64)


def shingles(texts: Texts, idf: Idf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (row << 48 | shingle), weights and counts of the texts' shingles."""
    hashes, words = lowered_words(texts)
    value = np.concatenate([[0.0], np.cumsum(idf.of(signed(hashes)))])
    starts = window_starts(words, SHINGLE)
    h = window_hashes(hashes, starts, SHINGLE)
    weight = (value[starts + SHINGLE] - value[starts]) / SHINGLE
    row = np.searchsorted(words.rows, starts, "right") - 1
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    for n in range(1, SHINGLE):
        mine = short[words.counts[short] == n]
        first = words.rows[mine]
        h = np.concatenate([h, window_hashes(hashes, first, n) ^ np.uint64(n)])
        weight = np.concatenate([weight, (value[first + n] - value[first]) / n])
        row = np.concatenate([row, mine])
    key = row.astype(np.uint64) << np.uint64(HASH_BITS) | h >> np.uint64(64 - HASH_BITS)
    key, back, count = np.unique(key, return_inverse=True, return_counts=True)
    return key, sums_by(back, weight, len(key)), count


def _uniform(h: np.ndarray, nth: int) -> np.ndarray:
    return ((mix(h + np.uint64(0x9E3779B97F4A7C15 * (nth + 1) & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def least_darts(row: np.ndarray, shingle: np.ndarray, unit: np.ndarray, count: np.ndarray, rows: int) -> np.ndarray:
    """The samples (rows x ``SAMPLES``) of shingles with ``count`` times the weight ``unit``; each row has a shingle.

    Counts are cut into the layers 0..1, 1..2, 2..4, 4..8 and so on; a layer of a shingle throws the same darts in all texts.
    """
    depth = np.frexp(count - 1.0)[1].astype(np.int64) + 1
    of = np.repeat(np.arange(len(count)), depth)
    layer = np.arange(len(of)) - np.repeat(np.cumsum(depth) - depth, depth)
    span = np.exp2(np.maximum(layer - 1, 0))
    low = np.where(layer > 0, span, 0.0)
    rate, seed, row, count = unit[of] * span, mix(shingle[of] + (layer.astype(np.uint64) << np.uint64(HASH_BITS))), row[of], count[of]
    # darts of an element before ``until`` of its row are thrown; ``at`` is the last one's time in units of the mean gap
    until = FIRST_DARTS / sums_by(row, rate * np.minimum(count - low, span) / span, rows)
    at, thrown = np.zeros(len(of)), np.zeros(len(of), np.int64)
    least, sample = np.full(rows * SAMPLES, np.inf), np.zeros(rows * SAMPLES, np.uint64)
    live = np.arange(len(of))
    while len(live):
        while len(live):
            ahead = np.maximum(until[row[live]] * rate[live] - at[live], 0.0)
            n = (ahead + np.sqrt(ahead)).astype(np.int64) + 1
            first = np.cumsum(n) - n
            e = np.repeat(live, n)
            h = mix(seed[e] + mix((thrown[e] + np.arange(len(e)) - np.repeat(first, n)).astype(np.uint64)))
            gap = -np.log(_uniform(h, 0))
            steps = np.cumsum(gap)
            when = steps + np.repeat(at[live] - steps[first] + gap[first], n)
            before = when < until[row[e]] * rate[e]
            kept = np.add.reduceat(before.astype(np.int64), first)
            some = kept > 0
            at[live[some]] = when[(first + kept - 1)[some]]
            thrown[live] += kept
            live = live[kept == n]
            # darts above a text's count are not the text's
            hit = np.flatnonzero(before)
            e, h, when = e[hit], h[hit], when[hit]
            hit = np.flatnonzero((low[e] + span[e] <= count[e]) | (low[e] + span[e] * _uniform(h, 1) < count[e]))
            e, h, when = e[hit], h[hit], when[hit] / rate[e[hit]]
            cell = row[e] * SAMPLES + (h % np.uint64(SAMPLES)).astype(np.int64)
            np.minimum.at(least, cell, when)
            won = least[cell] == when
            sample[cell[won]] = h[won]
        short = np.isinf(least).reshape(rows, SAMPLES).any(axis=1)
        until[short] *= 1.25
        live = np.flatnonzero(short[row])
    return sample.reshape(rows, SAMPLES)


def signatures(key: np.ndarray, weight: np.ndarray, count: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys per row (rows x bands), and which rows have any shingle."""
    row = (key >> np.uint64(HASH_BITS)).astype(np.int64)
    shingle = key & np.uint64((1 << HASH_BITS) - 1)
    size = np.bincount(row, minlength=rows)
    filled = np.flatnonzero(size)
    ends = np.concatenate([[0], np.cumsum(size[filled])])
    work = ends + FIRST_DARTS * np.arange(len(ends))
    bands = np.zeros((rows, BANDS), np.uint64)
    at = 0
    # few enough rows at once that their darts are about ``AT_ONCE``
    while at < len(filled):
        to = max(at + 1, int(np.searchsorted(work, work[at] + AT_ONCE, "right")) - 1)
        mine = slice(ends[at], ends[to])
        own = np.repeat(np.arange(to - at), size[filled[at:to]])
        grid = least_darts(own, shingle[mine], weight[mine] / count[mine], count[mine], to - at)
        # a band takes samples from all parts of the grid
        some = np.zeros((to - at, BANDS), np.uint64)
        for k in range(ROWS):
            some = mix(some * np.uint64(0xD6E8FEB86659FD93) + grid[:, k * BANDS : (k + 1) * BANDS])
        bands[filled[at:to]] = mix(some ^ np.arange(BANDS, dtype=np.uint64))
        at = to
    return bands, size > 0


def _sign(idf: Idf):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                key, weight, count = shingles(texts, idf)
                bands, has = signatures(key, weight, count, part.num_rows)
                ends = np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(bands[has].ravel())))
                total = sums_by((key >> np.uint64(HASH_BITS)).astype(np.int64), weight, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("digest"), pa.array(total), lists], names=["id", "digest", "total", "bands"])

    return scan


def _similar(idf: Idf):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, left in blocks(batch, "text_hub"):
                n = part.num_rows
                (ka, wa, _), (kb, wb, _) = shingles(left, idf), shingles(texts_of(part.column("text_node")), idf)
                at = np.searchsorted(ka, kb)
                at[at == len(ka)] = 0
                same = ka[at] == kb if len(ka) else np.zeros(len(kb), bool)
                hub_has = np.zeros(len(kb))
                hub_has[same] = wa[at[same]]
                row = [(k >> np.uint64(HASH_BITS)).astype(np.int64) for k in (ka, kb)]
                both = sums_by(row[1], np.minimum(hub_has, wb), n)
                either = sums_by(row[0], wa, n) + sums_by(row[1], wb, n) - both
                # shingles, or counts of them, that the hub does not have
                beyond = wb > hub_has * (1 + 1e-9)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row[1][beyond], minlength=n))]).astype(np.int32)
                extra = pa.StructArray.from_arrays(
                    [pa.array((kb[beyond] & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64)), pa.array((wb - np.minimum(hub_has, wb))[beyond])], ["s", "w"]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends), extra)
                yield pa.RecordBatch.from_arrays(
                    [part.column("hub"), part.column("node"), pa.array(both / np.maximum(either, 1e-12)), pa.array(both), lists],
                    names=["hub", "node", "similarity", "overlap", "beyond"],
                )

    return scan


def verified(pairs: DataFrame, texts: DataFrame, idf: Idf) -> DataFrame:
    """Weighted Jaccard similarity of the pairs ``(hub, node)`` from both whole texts, and the shingles beyond the hub's."""
    counts: dict[str, int] = {}
    used = materialize(pairs.select(F.explode(F.array("hub", "node")).alias("node")).distinct(), "used", counts)
    # few enough nodes go to where the texts are read
    held = materialize(texts.join(broadcast_if_small(used, counts["used"]), "node", "left_semi"), "pair_texts")
    joined = pairs.join(held.select("node", F.col("text").alias("text_node")), "node")
    joined = joined.join(held.select(F.col("node").alias("hub"), F.col("text").alias("text_hub")), "hub")
    fields = "hub long, node long, similarity double, overlap double, beyond array<struct<s long, w double>>"
    return materialize(joined.select("hub", "node", "text_hub", "text_node").mapInArrow(_similar(idf), fields), "verified")


def several_components(members: DataFrame) -> DataFrame:
    """Rows of ``members`` (``key``, ``node``, ``label``, ...) whose key has more than one label, with the key's ``size``."""
    keys = members.groupBy("key").agg(F.min("label").alias("l1"), F.max("label").alias("l2"), F.count(F.lit(1)).alias("size")).where("l1 < l2")
    return members.join(materialize(keys.select("key", "size"), "open_keys"), "key")


def labelled(rows: DataFrame, label: DataFrame | None) -> DataFrame:
    if label is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))


def linked_components(seen: DataFrame, threshold: float) -> DataFrame:
    edges = seen.where(F.col("similarity") >= threshold).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    return materialize(components(edges), "components")


def link(members: DataFrame, texts: DataFrame, idf: Idf, threshold: float, at_once: int) -> DataFrame | None:
    """Component label of every node with a link, from buckets ``(key, node, total)``; None if no two nodes share one.

    Open buckets that hold at most ``at_once`` pairs in all are compared pair by pair instead of by further rounds.
    """
    seen: DataFrame | None = None
    label: DataFrame | None = None
    need = threshold / (1 + threshold)
    while True:
        counts: dict[str, int] = {}
        open_ = materialize(several_components(labelled(members, label)), "open", counts)
        if not counts["open"]:
            return label
        if open_.agg(F.sum((F.col("size") - 1) / 2)).first()[0] <= at_once:
            x, y = open_.alias("x"), open_.alias("y")
            weights = F.least("x.total", "y.total") >= F.lit(threshold - 1e-9) * F.greatest("x.total", "y.total")
            last = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & weights)
            last = last.select(F.col("x.node").alias("hub"), F.col("y.node").alias("node")).distinct()
            known = verified(last if seen is None else last.join(seen, ["hub", "node"], "left_anti"), texts, idf)
            seen = known if seen is None else seen.unionByName(known)
            return linked_components(seen, threshold)
        rank = materialize(open_.groupBy("node").agg(F.sum("size").alias("rank")), "ranks")
        top = open_.join(rank, "node").groupBy("key").agg(F.max(F.struct("rank", (-F.col("node")).alias("minus"))).alias("top"))
        hubs = materialize(top.select("key", (-F.col("top.minus")).alias("hub")), "hubs")
        buckets = materialize(open_.join(hubs, "key").select("key", "hub", "node", "total"), "buckets")
        pairs = buckets.where("hub <> node").select("hub", "node").distinct()
        if seen is not None:
            pairs = pairs.join(seen, ["hub", "node"], "left_anti")
        known = verified(materialize(pairs, "pairs"), texts, idf)
        seen = known if seen is None else seen.unionByName(known)
        label = linked_components(seen, threshold)

        rest = materialize(several_components(labelled(buckets, label)), "unsettled", counts)
        if not counts["unsettled"]:
            return label
        facts = rest.join(seen.select("hub", "node", "similarity", "overlap"), ["hub", "node"])
        # of two nodes with different labels one at least has another than the bucket's commonest: a large family
        # is met by the others of its bucket and not by itself
        families = rest.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        main = families.groupBy("key").agg(F.max(F.struct("n", "label")).alias("m")).select("key", F.col("m.label").alias("main"))
        facts = materialize(facts.join(materialize(main, "main"), "key"), "facts")
        x, y = facts.where("label <> main").alias("x"), facts.alias("y")
        # pairs that can be linked without anything in common beyond the hub
        fits = x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & ((F.col("x.node") < F.col("y.node")) | (F.col("y.label") == F.col("y.main")))
            & (F.col("x.label") != F.col("y.label"))
            & (F.least("x.overlap", "y.overlap") >= F.lit(need - 1e-9) * (F.col("x.total") + F.col("y.total")))
            & (F.abs(F.col("x.similarity") - F.col("y.similarity")) <= 1 - threshold + 1e-9),
        ).select(F.least("x.node", "y.node").alias("hub"), F.greatest("x.node", "y.node").alias("node"))
        fits = materialize(fits.distinct().join(seen, ["hub", "node"], "left_anti"), "fits", counts)
        if counts["fits"]:
            seen = seen.unionByName(verified(fits, texts, idf))
            label = linked_components(seen, threshold)
        members = materialize(refined(rest, seen, threshold), "refined")


def refined(rest: DataFrame, seen: DataFrame, threshold: float) -> DataFrame:
    """The next buckets: nodes of a hub by the shingles beyond it, the rarest of each node first.

    A linked pair that :func:`link` has not compared has at least ``t`` in common beyond the hub, where t is what a link
    with the lightest node at hand needs in all, less the overlap with the hub. A node whose shingles beyond the hub
    are its own but for less than t has no such partner. For others the rarest shingles that make up all but t of
    their weight hold one that the partner has among its own, so the rest need not be looked at.
    """
    need = threshold / (1 + threshold)
    nodes = rest.where("hub <> node").select("hub", "node", "total").distinct().join(seen, ["hub", "node"])
    counts: dict[str, int] = {}
    lightest = materialize(nodes.groupBy("hub").agg(F.min("total").alias("lightest")), "lightest", counts)
    nodes = nodes.join(broadcast_if_small(lightest, counts["lightest"]), "hub")
    t = F.lit(need) * (F.col("total") + F.greatest(F.lit(threshold) * F.col("total"), F.col("lightest"))) - F.col("overlap") - 1e-6
    each = materialize(nodes.withColumn("t", t).select("hub", "node", "total", "overlap", "t", F.inline("beyond")), "beyond")
    often = materialize(each.groupBy("hub", "s").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    shared = each.join(often, ["hub", "s"])
    # shingles of one node only come first; their weight is what is beyond the hub less what is shared
    of_node = Window.partitionBy("hub", "node")
    order = of_node.orderBy("n", "s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = shared.withColumns({"common": F.sum("w").over(of_node), "ahead": F.coalesce(F.sum("w").over(order), F.lit(0.0))})
    extra = F.col("total") - F.col("overlap")
    prefix = ranked.where((F.col("common") >= F.col("t")) & (extra - F.col("common") + F.col("ahead") <= extra - F.col("t") + 1e-6))
    return prefix.select(F.xxhash64("hub", "s").alias("key"), "node", "total")


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: ``id``, ``digest`` of the text, ``class_key`` and ``class_id``, the smallest id of the class."""
    ship(df.sparkSession)
    id_, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(id_.alias("id"), text.alias("text"), text_digest(text).alias("digest"))
    idf = document_frequencies(docs)
    signed_ = materialize(docs.select("id", "digest", "text").mapInArrow(_sign(idf), "id long, digest binary, total double, bands array<long>"), "signatures")

    counts: dict[str, int] = {}
    # negative keys stand for texts that only rows without an id have
    nameless = -F.shiftrightunsigned(F.xxhash64("digest"), 1) - 1
    folded = signed_.groupBy("digest").agg(F.min("id").alias("least"), F.any_value("total").alias("total"))
    folded = materialize(folded.select("digest", F.coalesce("least", nameless).alias("node"), "total"), "nodes", counts)
    nodes = signed_.select("id", "digest", "bands").join(folded, "digest").where("id <=> node OR node < 0").select("node", "total", "bands")
    # texts that only rows without an id have are rare: the others are not joined for them
    unnamed = materialize(folded.where("node < 0").select("digest", "node"), "nameless", counts)
    texts = docs.where("id IS NOT NULL").select(F.col("id").alias("node"), "text")
    if counts["nameless"]:
        texts = texts.unionByName(docs.where("id IS NULL").join(broadcast_if_small(unnamed, counts["nameless"]), "digest").select("node", "text"))
    with scratch_scope(df.sparkSession):
        members = nodes.select("node", "total", F.explode("bands").alias("key"))
        shared = materialize(members.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key"), "shared")
        members = materialize(members.join(shared, "key").distinct(), "members")
        label = link(members, texts, idf, threshold, PAIRS_PER_TEXT * counts["nodes"])
        label = None if label is None else materialize(label, "labels", keep=True)

    named = signed_.select("id", "digest").join(folded.select("digest", "node"), "digest")
    named = labelled(named, label)
    key = F.coalesce("label", "node")
    return named.select("id", "digest", key.alias("class_key"), key.alias("class_id"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Id and class of every row of ``df``: ``id_col`` and ``class_id``."""
    found = classes(df, id_col, text_col, threshold)
    return found.select(F.col("id").alias(id_col), F.when(F.col("class_id") >= 0, F.col("class_id")).alias("class_id"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that stand for their class: the smallest id (null last), one row of several alike."""
    with scratch_scope(df.sparkSession):
        found = classes(df, id_col, text_col, threshold)
        stays = found.groupBy("class_key").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "digest")).alias("s"))
        stays = materialize(stays.select(F.col("s.id").alias("__id"), F.col("s.digest").alias("__digest")), "stays", keep=True)
        # equal rows can only be among those with an id and text that stand twice
        twice = found.groupBy("id", "digest").count().where("count > 1").limit(1).count()
    keyed = df.withColumn("__digest", text_digest(F.col(f"`{text_col}`")))
    kept = keyed.join(stays, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")) & (keyed["__digest"] == stays["__digest"]), "left_semi").drop("__digest")
    return kept.dropDuplicates([id_col, text_col]) if twice else kept
