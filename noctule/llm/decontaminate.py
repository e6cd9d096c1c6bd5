"""Benchmark decontamination with a distributed positional inverted index.

The corpus is cut into segments of documents. A task tokenizes a segment and stores, for every term that
occurs in the benchmark, the sorted places of that term in the segment. Terms that no test item has can
take part in no match and are not stored. The index is a table in the shared folder, one row per segment:
terms, list ends, places, and for each document its row id, its first place and its number of words.

A phrase is looked up segment by segment: its lists are ordered from the rarest term by the corpus counts
of the index, a phrase of which a term is missing in the segment is dropped at once, and the lists are
intersected with their offsets taken off, the rarest first, so lists shrink before a common term is
touched. What remains are exact phrase matches. :func:`proximity` takes the same lists for matches of all
terms within a number of words. Segments are independent, so nothing is shuffled but the matches.

The driver holds the term numbers of the test items, which are few beside the corpus, and sends them to the
tasks in blocks of bounded size; a larger benchmark takes more passes over the index. Terms are 64-bit hashes of the lower-cased words; a match has all the
hashes of its phrase in order.

Null texts have no words. An item without words is never found; items with equal ids count once. Items without an
id are searched like others: their hits count, together they are one item more, and they have no name in
``items_sha256``. Only :func:`contamination` leaves them out unless ``nameless`` is set, as the queries do. Rows with
equal document ids are judged each for itself, and null ids stay null. Empty tables give no rows, an empty
benchmark contaminates nothing. Added columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialize
from .frames import arrow_schema, batch_of, ship, with_row
from .words import alnum_words, blocks, covered, lower_ascii, signed, split_words, texts_of, word_hashes

WINDOW = 13
# Words of a block of test items that is sent to every task.
ITEM_WORDS = 500_000

INDEX_SQL = "segment long, terms array<long>, ends array<int>, places array<int>, docs array<int>, first array<int>"
MATCHES_SQL = "segment long, doc int, item string, first int, end int"


def term_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of all texts one after the other, and where each text starts."""
    texts = texts_of(column)
    data = lower_ascii()[texts.data]
    words = split_words(texts._replace(data=data), alnum_words())
    return signed(word_hashes(data, words)), words.rows


class Phrases:
    """Windows of a block of test items, as rows of term numbers."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        hashes, rows = term_lists(pa.array([t for _, t in items], pa.string()))
        self.items = [i for i, _ in items]
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes)
        # by length: the windows' term numbers and the item of each
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for k, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
            n = min(window, b - a)
            if n:
                w = np.lib.stride_tricks.sliding_window_view(numbers[a:b], n)
                found.setdefault(n, []).append((w, np.full(len(w), k)))
        for n, parts in found.items():
            self.by_length[n] = tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def weigh(self, counts: np.ndarray) -> None:
        """Order each window's terms from the rarest on."""
        self.order = {n: np.argsort(counts[w], axis=1, kind="stable") for n, (w, _) in self.by_length.items()}


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, nameless: bool = True) -> list[Phrases]:
    """Test items in blocks of at most ``ITEM_WORDS`` words (one item at least), read block by block."""
    out, block, size = [], [], 0
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string"), F.col(f"`{text_col}`")).distinct()
    for item, text in rows.toLocalIterator():
        if text is None or (item is None and not nameless):
            continue
        n = len(text) // 2 + 1
        if block and size + n > ITEM_WORDS * 8:
            out.append(Phrases(block, window))
            block, size = [], 0
        block.append((item, text))
        size += n
    return [*out, Phrases(block, window)] if block else out


def build_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """The index of ``docs`` (struct ``row`` and ``text``) for the terms of ``vocabulary`` (sorted hashes).

    One table holds a row per segment with the lists, and a row per document with ``segment``, ``doc``, ``row``
    and ``n_words``.
    """
    schema = with_row(docs, f"{INDEX_SQL}, doc int, n_words long")
    out = arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, lower = alnum_words(), lower_ascii()
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece, texts in blocks(batch, "text"):
                data = lower[texts.data]
                words = split_words(texts._replace(data=data), inside)
                hashes = signed(word_hashes(data, words))
                # a gap after each document keeps phrases from running over its end
                row = words.row_of()
                place = np.arange(len(hashes)) + row
                number = np.searchsorted(vocabulary, hashes)
                number[number == len(vocabulary)] = 0
                known = np.flatnonzero(vocabulary[number] == hashes) if len(vocabulary) else np.empty(0, np.int64)
                order = known[np.argsort(number[known], kind="stable")]
                terms, counts = np.unique(number[order], return_counts=True)
                n, segment = piece.num_rows, part << 32 | nth
                nth += 1
                first = words.rows[:-1] + np.arange(n)
                lists = {
                    "terms": pa.array([signed(vocabulary[terms].view(np.uint64)) if len(terms) else []], pa.list_(pa.int64())),
                    "ends": pa.array([np.cumsum(counts).astype(np.int32)], pa.list_(pa.int32())),
                    "places": pa.array([place[order].astype(np.int32)], pa.list_(pa.int32())),
                    "docs": pa.array([np.arange(n, dtype=np.int32)], pa.list_(pa.int32())),
                    "first": pa.array([first.astype(np.int32)], pa.list_(pa.int32())),
                }
                yield batch_of(out, segment=[segment], row=pa.nulls(1, out.field("row").type), doc=[None], n_words=[None], **lists)
                none = {k: pa.nulls(n, v.type) for k, v in lists.items()}
                yield batch_of(out, segment=np.full(n, segment), row=piece.column("row"), doc=np.arange(n, dtype=np.int32), n_words=words.counts, **none)

    return docs.mapInArrow(scan, schema)


def _lists(row: dict, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each vocabulary term's list in ``places``."""
    start, end = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    number = np.searchsorted(vocabulary, row["terms"])
    number[number == len(vocabulary)] = 0
    ours = vocabulary[number] == row["terms"] if len(vocabulary) else np.zeros(len(number), bool)
    ends = row["ends"].astype(np.int64)
    start[number[ours]] = np.concatenate([[0], ends[:-1]])[: len(ends)][ours]
    end[number[ours]] = ends[ours]
    return start, end, row["places"].astype(np.int64)


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def phrase_matches(row: dict, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, int]]:
    """Item, first places and length of every phrase found in a segment."""
    start, end, places = _lists(row, phrases.vocabulary)
    size = end - start
    for n, (windows, items) in phrases.by_length.items():
        order = phrases.order[n]
        for k in np.flatnonzero((size[windows] > 0).all(axis=1)).tolist():
            found = None
            for offset in order[k].tolist():
                term = windows[k, offset]
                shifted = places[start[term] : end[term]] - offset
                found = shifted if found is None else found[_within(found, shifted)]
                if not len(found):
                    break
            else:
                yield int(items[k]), found, n


def proximity_matches(row: dict, phrases: Phrases, within: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Item and places of the rarest term with every other term of the window at most ``within`` places away."""
    start, end, places = _lists(row, phrases.vocabulary)
    size = end - start
    for n, (windows, items) in phrases.by_length.items():
        for k in np.flatnonzero((size[windows] > 0).all(axis=1)).tolist():
            terms = windows[k, phrases.order[n][k]]
            near = places[start[terms[0]] : end[terms[0]]]
            for term in terms[1:]:
                other = places[start[term] : end[term]]
                at = np.searchsorted(other, near - within)
                near = near[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= near + within)]
                if not len(near):
                    break
            else:
                yield int(items[k]), near, 1


def _search(phrases: Phrases, within: int | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("terms", "ends", "places", "first")}
                segment, first = batch.column("segment")[i].as_py(), row["first"].astype(np.int64)
                found = phrase_matches(row, phrases) if within is None else proximity_matches(row, phrases, within)
                for item, at, n in found:
                    doc = np.searchsorted(first, at, "right") - 1
                    # places of a document are its word numbers, shifted
                    begin = at - first[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), segment)), pa.array(doc, pa.int32()), pa.array([phrases.items[item]] * len(at), pa.string()), pa.array(begin, pa.int32()), pa.array(begin + n, pa.int32())],
                        names=["segment", "doc", "item", "first", "end"],
                    )

    return scan


def search(index: DataFrame, blocks_: list[Phrases], within: int | None = None) -> DataFrame:
    """Matches in the index: ``segment``, ``doc``, ``item`` and the words first..end-1. Exact phrases, or ``within`` a distance."""
    segments = index.where("doc IS NULL").select("segment", "terms", "ends", "places", "first")
    sizes = F.transform(F.sequence(F.lit(0), F.size("ends") - 1), lambda k: F.element_at("ends", k + 1) - F.when(k > 0, F.get("ends", k - 1)).otherwise(0))
    pairs = segments.where(F.size("terms") > 0).select(F.explode(F.arrays_zip(F.col("terms").alias("term"), sizes.alias("n"))).alias("t"))
    # at most one row per term of the benchmark
    counts = {r["term"]: r["n"] for r in pairs.groupBy("t.term").agg(F.sum("t.n").alias("n")).toLocalIterator()}
    out = None
    for phrases in blocks_:
        phrases.weigh(np.array([counts.get(t, 0) for t in phrases.vocabulary.tolist()], np.int64))
        found = segments.mapInArrow(_search(phrases, within), MATCHES_SQL)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else index.sparkSession.createDataFrame([], MATCHES_SQL)


def indexed(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, texts: bool = False, nameless: bool = True) -> tuple[DataFrame, list[Phrases]]:
    """The stored index of ``docs``, with their texts if asked, and the benchmark's blocks."""
    ship(docs.sparkSession)
    phrases = item_blocks(benchmark, item_col, "text", window, nameless)
    vocabulary = np.unique(np.concatenate([p.vocabulary for p in phrases])) if phrases else np.empty(0, np.int64)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if texts or c != text_col], F.lit(0).alias("__pad")).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return materialize(build_index(rows, vocabulary), "index"), phrases


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans, items, nameless in zip(*(batch.column(c).to_pylist() for c in ("spans", "items", "nameless")), strict=True):
            first, end = (np.array([s[k] for s in spans], np.int64) for k in ("first", "end"))
            names = ",".join(sorted(set(items)))
            out.append((int(covered(int(end.max()), first, end).sum()), len(set(items)) + nameless, hashlib.sha256(names.encode()).hexdigest()))
        n_hit, n_items, digest = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("segment"), batch.column("doc"), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digest, pa.string())], names=["segment", "doc", "n_hit", "n_items", "items_sha256"])


def hits_of(matches: DataFrame) -> DataFrame:
    """Hit words and items per document with a match."""
    spans = matches.groupBy("segment", "doc").agg(F.collect_set(F.struct("first", "end")).alias("spans"), F.collect_set("item").alias("items"), F.max(F.col("item").isNull().cast("int")).alias("nameless"))
    return spans.mapInArrow(_hits, "segment long, doc int, n_hit long, n_items long, items_sha256 string")


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, nameless: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A word is hit if it lies in an occurrence of a window of ``window`` item words (or of a shorter item); a
    document with at least one hit word in twenty is contaminated. Items without an id take part if ``nameless``.
    """
    index, phrases = indexed(docs, benchmark, text_col, item_col, window, nameless=nameless)
    hits = hits_of(search(index, phrases))
    joined = index.where("doc IS NOT NULL").select("segment", "doc", "row", "n_words").join(hits, ["segment", "doc"], "left")
    none = hashlib.sha256(b"").hexdigest()
    added = {
        "n_words": F.col("n_words"),
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
        "n_items": F.coalesce("n_items", F.lit(0).cast("long")),
        "items_sha256": F.coalesce("items_sha256", F.lit(none)),
    }
    added["contaminated"] = (added["n_hit"] > 0) & (20 * added["n_hit"] >= added["n_words"])
    columns = [c for c in docs.columns if c != text_col and c not in added]
    return joined.select(*[F.col("row").getField(c).alias(c) for c in columns], *[v.alias(k) for k, v in added.items()])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    index, phrases = indexed(docs, benchmark, text_col, item_col, window, texts=True)
    hits = hits_of(search(index, phrases))
    rows = index.where("doc IS NOT NULL").select("segment", "doc", "row", "n_words")
    bad = hits.join(rows.select("segment", "doc", "n_words"), ["segment", "doc"]).where("20 * n_hit >= n_words").select("segment", "doc")
    kept = rows.join(bad, ["segment", "doc"], "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
