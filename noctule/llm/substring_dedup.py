"""Removal of passages that an earlier document holds, by level-wise doubling.

A window of ``length`` words is removed where the same words also start in a document with a
smaller id. Windows are found at a quarter of the length first, and only what repeats there is
looked at at greater lengths:

1. Every window of ``length`` words picks one of its short windows, the one of least hash, so two
   equal windows pick equal short ones. Only picked short windows (about one word in twenty) become
   rows, and a short window that stands in one document alone is dropped with all windows around it.
2. A surviving short window is extended to its whole surroundings, that is all windows that can
   have picked it. Where a smaller id has the same surroundings, everything in them goes. Of each
   surroundings only the copy of the smallest id is carried further, so large groups of copies fold
   here to one row before anything is enumerated.
3. What is left are borders of passages. The short windows there are extended to twice their length,
   to the left and to the right. What repeats at that length is extended to the full windows that
   hold it, and their 128-bit hashes decide.

The work ends at the level where no candidates survive. All steps are equi-joins and aggregates with
partial results per task; no group is ever gathered. A word is ``[^\\x20\\x09-\\x0D]+``.

Null texts have no words. Null ids count as later than all others and never remove from each other.
Rows with equal id do not remove from each other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialize, scratch_scope
from .frames import arrow_schema, batch_of, row_key, row_struct, ship, unpacked, with_row
from .words import BASES, Words, blocks, covered, mix, prefix_sums, signed, space_words, span_hashes, split_words, window_starts, word_hashes

Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

ANCHORS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("hi", pa.int32()), ("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("l", pa.int32()), ("r", pa.int32())])
ANCHORS_SQL = "id long, th long, at int, hi int, h long, c1 long, c2 long, l int, r int"
WINDOWS = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("at", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])
WINDOWS_SQL = "id long, th long, at int, w1 long, w2 long"


def levels(length: int) -> tuple[int, int]:
    """The two shorter lengths: a quarter of ``length``, and twice that."""
    short = max(1, -(-length // 4))
    return short, min(2 * short, length)


def picked(hashes: np.ndarray, starts: np.ndarray, reach: int) -> np.ndarray:
    """Per window start, the place of the least of the ``reach`` hashes from there on (the first of ties)."""
    # doubling: least of 1, 2, 4, ... places, then two overlapping runs
    place = np.arange(len(hashes))
    width = 1
    while width * 2 <= reach:
        left, right = place[: len(place) - width], place[width:]
        place = np.where(hashes[right] < hashes[left], right, left)
        width *= 2
    left, right = place[starts], place[starts + reach - width]
    return np.unique(np.where(hashes[right] < hashes[left], right, left))


class _Sums:
    """Both word polynomials of a block, for hashes of any word span."""

    def __init__(self, data: np.ndarray, words: Words, wide: bool = True) -> None:
        self.sums = [prefix_sums(word_hashes(data, words, k), BASES[k][1]) for k in range(1 + wide)]

    def of(self, first: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        return span_hashes(self.sums[k], first, end, BASES[k][1])


def _anchors(length: int) -> Scan:
    short, double = levels(length)
    before = length - short

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = space_words()
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                words = split_words(texts, inside)
                starts = window_starts(words, length)
                if not len(starts):
                    continue
                sums = _Sums(texts.data, words)
                every = np.arange(words.rows[-1] - short + 1)
                at = picked(sums.of(every, every + short, 0), starts, before + 1)
                row = np.searchsorted(words.rows, at, "right") - 1
                base, stop = words.rows[row], words.rows[row + 1]
                lo, hi = np.maximum(base, at - before), np.minimum(stop, at + length)
                # where the short window lies in its surroundings is part of their key
                place = mix(((at - lo) << 32 | (hi - at)).astype(np.uint64))
                left, right = at + short - double, at + double
                sides = []
                for first, end in ((left, at + short), (at, right)):
                    fits = (first >= base) & (end <= stop)
                    h = sums.of(np.where(fits, first, at), np.where(fits, end, at), 0)
                    sides.append(pa.array(h.astype(np.uint32).view(np.int32), mask=~fits))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(row)),
                        part.column("th").take(pa.array(row)),
                        pa.array(at - base, pa.int32()),
                        pa.array(hi - base, pa.int32()),
                        pa.array(signed(sums.of(at, at + short, 0))),
                        pa.array(signed(sums.of(lo, hi, 0) ^ place)),
                        pa.array(signed(sums.of(lo, hi, 1) ^ place)),
                        *sides,
                    ],
                    schema=ANCHORS,
                )

    return scan


def _windows(length: int) -> Scan:
    """Full windows around short ones of which the left (0) or the right (1) extension repeats."""
    short, double = levels(length)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = space_words()
        shift = np.arange(length - short + 1)
        allowed = (shift >= double - short, shift <= length - double)
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                words = split_words(texts, inside)
                places = part.column("places")
                row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                coded = places.flatten().to_numpy().astype(np.int64)
                # per short window which of its extensions repeat
                key, back = np.unique(row << 40 | coded >> 1, return_inverse=True)
                alive = np.zeros((len(key), 2), bool)
                alive[back, coded & 1] = True
                row, at = key >> 40, key & ((1 << 40) - 1)
                base, stop = words.rows[row], words.rows[row + 1]
                # a window that holds an extension which does not repeat cannot repeat
                good = np.ones((len(key), len(shift)), bool)
                for side in (0, 1):
                    good &= alive[:, side, None] | ~allowed[side]
                first = (base + at)[:, None] - shift
                good &= (first >= base[:, None]) & (first + length <= stop[:, None])
                first = np.unique(first[good])
                if not len(first):
                    continue
                sums = _Sums(texts.data, words)
                row = np.searchsorted(words.rows, first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(row)),
                        part.column("th").take(pa.array(row)),
                        pa.array(first - words.rows[row], pa.int32()),
                        pa.array(signed(sums.of(first, first + length, 0))),
                        pa.array(signed(sums.of(first, first + length, 1))),
                    ],
                    schema=WINDOWS,
                )

    return scan


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """Spans of words (first, end) to remove per document ``(id, th)``; ``docs`` has ``id``, ``th`` and ``text``."""
    with scratch_scope(docs.sparkSession):
        return materialize(_spans(docs, length), "spans", keep=True)


def _spans(docs: DataFrame, length: int) -> DataFrame:
    spark = docs.sparkSession
    short, double = levels(length)
    texts = docs.select("id", "th", "text")
    counts: dict[str, int] = {}
    anchors = materialize(texts.mapInArrow(_anchors(length), ANCHORS_SQL), "anchors")
    repeated = anchors.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h", "least")
    # sides of joins on possibly hot keys are written first: a join of two plain exchanges can be split anew
    repeated = materialize(repeated, "repeated")
    alive = materialize(anchors.join(repeated, "h"), "alive", counts)
    none = spark.createDataFrame([], "id long, th long, first int, end int")
    if not counts["alive"]:
        return none.groupBy("id", "th").agg(F.collect_list(F.struct("first", "end")).alias("spans"))

    around = materialize(alive.groupBy("c1", "c2").agg(F.min("id").alias("first_id")), "first_around")
    alive = materialize(alive.join(around, ["c1", "c2"]), "around")
    whole = alive.where("id > first_id").select("id", "th", F.greatest(F.lit(0), F.col("at") - (length - short)).alias("first"), F.col("hi").alias("end"))

    # one copy of each surroundings goes on, where an id after the first still has a question open
    border = alive.where("id = first_id")
    open_ = materialize(border.where("id > least").select("h").distinct(), "open")
    sides = (
        border.join(open_, "h", "left_semi")
        .select("id", "th", "at", "h", F.posexplode(F.array("l", "r")).alias("side", "ext"))
        .where("ext IS NOT NULL")
    )
    doubled = sides.groupBy("h", "side", "ext").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("h", "side", "ext")
    doubled = materialize(doubled, "doubled")
    borders = materialize(
        sides.join(doubled, ["h", "side", "ext"], "left_semi").groupBy("id", "th").agg(F.collect_list(F.col("at").cast("long") * 2 + F.col("side")).alias("places")),
        "borders",
        counts,
    )
    spans = whole
    if counts["borders"]:
        windows = materialize(texts.join(borders, ["id", "th"]).mapInArrow(_windows(length), WINDOWS_SQL), "windows")
        least = windows.groupBy("w1", "w2").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
        again = windows.join(materialize(least, "least"), ["w1", "w2"]).where("id > least")
        spans = spans.unionByName(again.select("id", "th", F.col("at").alias("first"), (F.col("at") + length).alias("end")))
    return spans.groupBy("id", "th").agg(F.collect_set(F.struct("first", "end")).alias("spans"))


def _cut(out: pa.Schema, texts_too: bool) -> Scan:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = space_words()
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                words = split_words(texts, inside)
                spans = part.column("spans")
                filled = spans.is_valid().to_numpy(zero_copy_only=False)
                sizes = np.where(filled, np.diff(spans.offsets.to_numpy()), 0)
                flat = spans.flatten()
                shift = words.rows[np.repeat(np.arange(part.num_rows), sizes)]
                first, end = (flat.field(k).to_numpy().astype(np.int64) + shift for k in ("first", "end"))
                gone = covered(int(words.rows[-1]), first, end)
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.rows[:-1]) * (words.counts > 0) if part.num_rows else gone
                raw, kept_texts, digests = texts.data.tobytes(), [], []
                for k in range(part.num_rows):
                    text = raw[texts.starts[k] : texts.starts[k + 1]]
                    lo, hi = words.rows[k], words.rows[k + 1]
                    if removed[k]:
                        stay = np.flatnonzero(~gone[lo:hi]) + lo
                        # runs of kept words, with the white space between them
                        breaks = np.flatnonzero(np.diff(stay) > 1) + 1
                        runs = [raw[words.first[r[0]] : words.end[r[-1]]] for r in np.split(stay, breaks) if len(r)]
                        text = b" ".join(runs)
                    digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                    kept_texts.append(text.decode() if texts_too else None)
                yield batch_of(out, row=part.column("row"), n_words=words.counts, n_removed=removed, kept_sha256=digests, kept_text=kept_texts)

    return scan


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, texts: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed``, ``kept_sha256`` and, if ``texts``, ``kept_text``.

    ``kept_text`` is the text without the removed words; what stays keeps its white space, and a gap is one
    space. ``kept_sha256`` is taken of the kept words joined by single spaces. Added columns take the place
    of columns of the same name.
    """
    ship(df.sparkSession)
    columns = [c for c in df.columns if texts or c != text_col]
    key, digest = row_key(id_col, text_col)
    docs = df.select(row_struct(df.select(*[F.col(f"`{c}`") for c in columns])), key.alias("id"), digest.alias("th"), F.col(f"`{text_col}`").alias("text"))
    joined = docs.join(repeated_spans(docs, length), ["id", "th"], "left").select("row", "text", "spans")
    added = ["n_words", "n_removed", "kept_sha256", *["kept_text"] * texts]
    schema = with_row(joined, "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts)
    cut = joined.mapInArrow(_cut(arrow_schema(schema), texts), schema)
    return unpacked(cut, columns, *added)
