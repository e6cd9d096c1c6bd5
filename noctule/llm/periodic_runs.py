"""Periodic runs of words in texts, by suffix trees and Lyndon roots.

A run is a stretch of consecutive words with a smallest period q, at least ``min_length`` words and ``min_exponent`` periods
long, that no neighbouring word extends. All runs of a text come from its Lyndon roots (Bannai et al. 2017, "The runs
theorem"): for an order of the words and its reverse, the longest Lyndon word from each place on is a candidate root of
period p; the longest common extensions of the places p apart to the right and to the left give the stretch, which is a
run if it has two roots at least. Every run has a root among the candidates of one of both orders.

* The longest Lyndon word from i ends before the next suffix that is less than suffix i; the tree's leaves in order rank them.
* Extensions to the right come from Ukkonen's tree of the text, those to the left from the tree of its reversal, each as a
  constant-time lowest common ancestor on the Euler tour, see :mod:`noctule.llm.suffix_tree`.

Only words that can lie in a run enter the trees. With k = ``window`` words, every word of a run lies in a window of k words
which stands again within the run, one period away. So stretches are cut down to words in windows that repeat in
the same stretch, until nothing changes; between stretches stands a symbol of its own, which no run can hold. Where
hashes of different windows agree, words stay in that the trees then refuse.

A text is worked on alone and as a whole; memory grows with the longest text's repeating stretches (about 1 kB a word), never
with the number of texts. Nothing is shuffled. Null and empty texts have no words and no runs. Repeated rows and ids get the
same result each. Empty tables give no rows. Added columns take the place of columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import arrow_schema, batch_of, row_struct, ship, unpacked, with_row
from .suffix_tree import SuffixTree
from .words import Texts, Words, blocks, covered, mix, space_words, split_words, window_hashes, word_hashes

MIN_LENGTH, MIN_EXPONENT = 6, 4
# Symbols from here on stand between stretches.
GAP = 1 << 40
RUN = "struct<start: long, length: long, period: long>"


def window(min_length: int, min_exponent: int) -> int:
    """Words of the longest window that has an equal one a period away in every run, wherever in the run it is.

    A window of k words at place t of a run of n words fails only if t + period + k > n and t < period, which
    cannot be if n >= 2 * period + k - 1.
    """
    return min(max(min_length, min_exponent * q) - 2 * q + 1 for q in range(1, max(2, min_length) + 1))


def repeating(hashes: np.ndarray, rows: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """First and end word (n x 2) of the stretches that can hold runs; ``rows`` has the first word of each text and the end."""
    size = window(min_length, min_exponent)
    first, end = rows[:-1], rows[1:]
    long = end - first >= min_length
    spans = np.stack([first[long], end[long]], axis=1)
    if not len(spans):
        return spans
    keys = mix(window_hashes(hashes, np.arange(len(hashes) - size + 1), size))
    while len(spans):
        room = spans[:, 1] - spans[:, 0] - size + 1
        of = np.repeat(np.arange(len(spans)), room)
        at = np.arange(len(of)) - np.repeat(np.cumsum(room) - room, room) + np.repeat(spans[:, 0], room)
        key = keys[at] + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        # windows of one stretch that overlap or touch make one stretch
        at, of = at[again], of[again]
        if not len(at):
            return spans[:0]
        cut = np.flatnonzero((np.diff(at) > size) | (np.diff(of) > 0)) + 1
        left = np.stack([at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])] + size], axis=1)
        left = left[left[:, 1] - left[:, 0] >= min_length]
        if len(left) == len(spans) and (left == spans).all():
            break
        spans = left
    return spans


def next_less(values: list[int]) -> list[int]:
    """For every place the next place with a lesser value; the number of places if there is none."""
    out, stack = [len(values)] * len(values), []
    for i, v in enumerate(values):
        while stack and values[stack[-1]] > v:
            out[stack.pop()] = i
        stack.append(i)
    return out


def runs_of(symbols: list[int], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Runs (start, length, period) of a sequence of whole numbers, in that order."""
    n = len(symbols)
    if n < 2:
        return np.empty((0, 3), np.int64)
    tree, mirror = SuffixTree(symbols), SuffixTree(symbols[::-1])
    ranks, found = tree.ranks(), []
    # the end is the least suffix in one order and the greatest in the other, its reverse; there it bounds no root, and
    # runs up to the end have their roots in the first order
    for order, last in ((ranks, n), (len(ranks) - 1 - ranks, n - 1)):
        after = np.array(next_less(order.tolist())[:n])
        place = np.flatnonzero(after <= last)
        period = after[place] - place
        ahead = tree.common(place, place + period)
        behind = mirror.common(n - place, n - place - period)
        found.append(np.stack([place - behind, behind + period + ahead, period], axis=1))
    both = np.concatenate(found)
    start, length, period = both.T
    both = both[(length >= 2 * period) & (length >= min_length) & (length >= min_exponent * period)]
    return np.unique(both, axis=0)


def text_runs(texts: Texts, words: Words, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> dict[int, np.ndarray]:
    """Runs by text of a block, in word numbers of the text; texts without runs are left out."""
    spans = repeating(word_hashes(texts.data, words), words.rows, min_length, min_exponent)
    text_of = np.searchsorted(words.rows, spans[:, 0], "right") - 1
    raw, first, end = texts.data.tobytes(), words.first, words.end
    out: dict[int, np.ndarray] = {}
    for text in np.unique(text_of):
        ids: dict[bytes, int] = {}
        symbols, numbers = [], []
        for lo, hi in spans[text_of == text].tolist():
            for w in range(lo, hi):
                symbols.append(ids.setdefault(raw[first[w] : end[w]], len(ids)))
            # each gap is a symbol of its own
            symbols.append(GAP + len(numbers))
            numbers.append(np.arange(lo, hi + 1))
        symbols.pop()
        at = np.concatenate(numbers)
        runs = runs_of(symbols, min_length, min_exponent)
        if len(runs):
            runs[:, 0] = at[runs[:, 0]] - words.rows[text]
            out[int(text)] = runs
    return out


def _scan(out: pa.Schema, min_length: int, min_exponent: int, texts_too: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = space_words()
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                words = split_words(texts, inside)
                found = text_runs(texts, words, min_length, min_exponent)
                raw, kept, digests = texts.data.tobytes(), [], []
                for k in range(part.num_rows):
                    own = raw[texts.starts[k] : texts.starts[k + 1]].split()
                    if k in found:
                        start, length, period = found[k].T
                        gone = covered(len(own), start + period, start + length)
                        own = [own[i] for i in np.flatnonzero(~gone)]
                    text = b" ".join(own)
                    digests.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode() if texts_too else None)
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found[k].tolist()] if k in found else [] for k in range(part.num_rows)]
                yield batch_of(out, row=part.column("row"), n_words=words.counts, runs=runs, collapsed=kept, collapsed_sha256=digests)

    return scan


def periodic_runs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, texts: bool = True
) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (by start, then period), ``collapsed`` and ``collapsed_sha256``.

    ``collapsed`` is the words left, joined by one space, after every run was cut down to its first period; it is null unless
    ``texts``, and then the text column is left out as well. Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.
    """
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has two periods at least")
    ship(df.sparkSession)
    columns = [c for c in df.columns if texts or c != text_col]
    rows = df.select(row_struct(df.select(*[F.col(f"`{c}`") for c in columns])), F.col(f"`{text_col}`").cast("string").alias("text"))
    added = ["n_words", "runs", "collapsed", "collapsed_sha256"]
    schema = with_row(rows, f"n_words long, runs array<{RUN}>, collapsed string, collapsed_sha256 string")
    return unpacked(rows.mapInArrow(_scan(arrow_schema(schema), min_length, min_exponent, texts), schema), columns, *added)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of ties that of the smallest start, then of the smallest period. Null without runs."""
    key = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    top = F.array_max(key)
    return F.when(top.isNotNull(), F.struct((-top["s"]).alias("start"), top["length"].alias("length"), (-top["p"]).alias("period")))


def runs_text(runs: Column) -> Column:
    """Every run as a line ``start,length,period``."""
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    return F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
