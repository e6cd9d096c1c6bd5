"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Patterns (leftmost, non-overlapping per kind; a match that is too short is dropped) are ``assign`` (a keyword, ``:`` or ``=`` and a
value of 12 or more characters), ``access`` (AKIA and more capitals and digits, 18 or more) and ``hex`` (16 or more).

The method looks at every other string of ``LEAST`` or more characters ``[A-Za-z0-9+/_.=-]``, marks at its ends left off. Two first-order
Markov chains over characters, with a start and an end, say how likely a random string and an ordinary identifier are to
read so; a string is reported (kind ``markov``) if the log-likelihood ratio is ``THRESHOLD`` or more. Such spans never overlap
those of the patterns, which stay as they are.

The chains are trained from labelled samples, by default from the texts themselves: values that a pattern finds are random,
the other strings are ordinary. Samples are taken from all rows, and each different string counts once, however many copies
of its document there are; a string that is ever labelled random is. Different strings are counted by a hash aggregate, and only
the sums by pairs of characters come to the driver (at most 2 x 67 x 67 rows). Each chain is mixed with classes of characters
and the uniform distribution (``SHARES``), so that characters unseen in one context have a probability.

Null and empty texts have no spans. Repeated rows and ids get the same result each. Without any random (or ordinary) samples
the chain is the uniform one. Empty tables give no rows. Added columns take the place of columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import arrow_schema, batch_of, row_struct, ship, unpacked, with_row
from .words import Texts, blocks, split_words

LEAST = 12
THRESHOLD = 12.0
# Shares of pairs of characters, of character classes and of the uniform distribution in a chain.
SHARES = (0.8, 0.15, 0.05)
KINDS = ("assign", "access", "hex", "markov")
SPAN = "struct<kind: string, start: long, end: long, value: string, score: double>"

# The patterns, for lower-cased bytes where letters may stand in either case.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 12
# runs are taken whole, so dropping shorter matches is the same as asking for the length
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")

LETTERS = b"abcdefghijklmnopqrstuvwxyz"
CLASSES = (LETTERS, LETTERS.upper(), b"0123456789", b"+/_.=-")
START = END = sum(map(len, CLASSES))
SIZE = END + 1


def _codes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per byte whether it is a string's and its number; per number its class (the edge is one of its own)."""
    alphabet = np.frombuffer(b"".join(CLASSES), np.uint8)
    inside, code = np.zeros(256, bool), np.zeros(256, np.int64)
    inside[alphabet], code[alphabet] = True, np.arange(len(alphabet))
    return inside, code, np.repeat(np.arange(len(CLASSES) + 1), [*map(len, CLASSES), 1])


INSIDE, CODE, CLASS = _codes()
MARK = np.isin(np.arange(256), list(CLASSES[3]))
OUTSIDE = bytes(np.flatnonzero(~INSIDE).astype(np.uint8))


class Found(NamedTuple):
    """A pattern's match in one text: kind, bytes of the span and of its value."""

    kind: int
    start: int
    end: int
    value: int


def patterns(text: bytes) -> list[Found]:
    """Matches of all patterns by start, then kind."""
    found = [Found(0, m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text.lower()) if m.end(1) - m.start(1) >= ASSIGN_VALUE]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        found += [Found(kind, *m.span(), m.start()) for m in pattern.finditer(text)]
    return sorted(found, key=lambda f: (f.start, f.kind))


def strings(texts: Texts, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of the strings of a block, without marks at their ends."""
    words = split_words(texts, INSIDE)
    long = words.end - words.first >= least
    first, end = words.first[long], words.end[long]
    while (at := MARK[texts.data[first]] & (first < end - 1)).any():
        first = first + at
    while (at := MARK[texts.data[end - 1]] & (first < end - 1)).any():
        end = end - at
    long = end - first >= least
    return first[long], end[long]


class Block(NamedTuple):
    """Matches of the patterns (text, match) and the strings that touch none."""

    raw: bytes
    matches: list[tuple[int, Found]]
    first: np.ndarray
    end: np.ndarray


def searched(texts: Texts) -> Block:
    raw, starts = texts.data.tobytes(), texts.starts.tolist()
    matches = [(k, f) for k in range(len(starts) - 1) for f in patterns(raw[starts[k] : starts[k + 1]])]
    first, end = strings(texts)
    if matches:
        taken = np.zeros(len(texts.data) + 1, np.int64)
        low = np.array([starts[k] + f.start for k, f in matches])
        high = np.array([starts[k] + f.end for k, f in matches])
        np.add.at(taken, low, 1)
        np.add.at(taken, high, -1)
        # bytes before a place that a match holds
        held = np.concatenate([[0], np.cumsum(np.cumsum(taken[:-1]) > 0)])
        free = held[first] == held[end]
        first, end = first[free], end[free]
    return Block(raw, matches, first, end)


def labelled_strings(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Samples ``string`` and ``random`` (0 or 1) from the texts, each different string once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in blocks(batch, "text"):
                block = searched(texts)
                raw = block.raw
                seen = dict.fromkeys([raw[a:b] for a, b in zip(block.first.tolist(), block.end.tolist(), strict=True)], 0)
                for k, f in block.matches:
                    at = int(texts.starts[k])
                    seen[raw[at + f.value : at + f.end]] = 1
                yield pa.RecordBatch.from_arrays([pa.array([s.decode() for s in seen], pa.string()), pa.array(list(seen.values()), pa.int32())], names=["string", "random"])

    rows = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(scan, "string string, random int")
    return rows.groupBy("string").agg(F.max("random").alias("random"))


class Chains(NamedTuple):
    """Log-likelihood ratio (random over ordinary) of every step from one character to the next."""

    ratio: np.ndarray

    def scores(self, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        code = CODE[data]
        steps = np.zeros(len(data) + 1)
        np.cumsum(self.ratio[code[:-1], code[1:]], out=steps[2:]) if len(data) > 1 else None
        return steps[end] - steps[first + 1] + self.ratio[START, code[first]] + self.ratio[code[end - 1], END]


def chain(counts: np.ndarray) -> np.ndarray:
    """Step probabilities of one chain from the counts of pairs."""
    pairs, by_class, uniform = SHARES
    member = CLASS[:, None] == np.arange(CLASS.max() + 1)
    groups = member.T @ counts @ member
    inside = groups / np.maximum(groups.sum(axis=1, keepdims=True), 1)
    smooth = by_class * inside[CLASS][:, CLASS] / member.sum(axis=0)[CLASS] + uniform / SIZE
    exact = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out = pairs * exact + smooth
    # what a context without samples lacks is spread evenly
    return out + (1 - out.sum(axis=1, keepdims=True)) / SIZE


def train(samples: DataFrame) -> Chains:
    """The chains of ``samples`` (``string``, ``random``); characters outside the alphabet are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * SIZE * SIZE, np.int64)
        for batch in batches:
            texts = [s.encode().translate(None, OUTSIDE) for s in batch.column("string").to_pylist()]
            label = np.repeat(batch.column("random").to_numpy(), [len(t) + 1 for t in texts])
            if len(label):
                # every string with an edge before it; the edge after it is that before the next
                code = np.concatenate([np.append(START, CODE[np.frombuffer(t, np.uint8)]) for t in texts] + [[END]])
                total += np.bincount((label * SIZE + code[:-1]) * SIZE + code[1:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    clean = samples.select("string", "random").where("string IS NOT NULL AND random IS NOT NULL")
    sums = clean.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(2 * SIZE * SIZE)
    total[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    ordinary, random = (chain(c) for c in total.reshape(2, SIZE, SIZE))
    return Chains(np.log(random) - np.log(ordinary))


def _scan(out: pa.Schema, chains: Chains, threshold: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                block = searched(texts)
                score = chains.scores(texts.data, block.first, block.end)
                hit = score >= threshold
                first, end, score = block.first[hit], block.end[hit], score[hit]
                of = np.searchsorted(texts.starts, first, "right") - 1
                point = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
                spans: list[list[tuple]] = [[] for _ in range(part.num_rows)]
                for k, f in block.matches:
                    at = int(texts.starts[k])
                    spans[k].append((at + f.start, f.kind, at + f.end, at + f.value, None))
                for k, a, b, s in zip(of.tolist(), first.tolist(), end.tolist(), score.tolist(), strict=True):
                    spans[k].append((a, 3, b, a, s))
                rows = []
                for k, own in enumerate(spans):
                    base = int(point[texts.starts[k]])
                    rows.append([
                        {"kind": KINDS[kind], "start": int(point[a]) - base, "end": int(point[b]) - base, "value": block.raw[v:b].decode(), "score": s}
                        for a, kind, b, v, s in sorted(own, key=lambda x: x[:2])
                    ])
                yield batch_of(out, row=part.column("row"), spans=rows)

    return scan


def scan_secrets(df: DataFrame, chains: Chains | None = None, text_col: str = "text", threshold: float = THRESHOLD, texts: bool = True) -> DataFrame:
    """``df`` with ``spans`` by start, then kind: ``kind``, ``start`` and ``end`` in code points, ``value`` and ``score``.

    ``chains`` are those of :func:`train`, by default trained on ``df`` itself. ``score`` is the log-likelihood ratio, null for patterns.
    Unless ``texts``, the text column is left out.
    """
    ship(df.sparkSession)
    chains = chains or train(labelled_strings(df, text_col))
    columns = [c for c in df.columns if texts or c != text_col]
    rows = df.select(row_struct(df.select(*[F.col(f"`{c}`") for c in columns])), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = with_row(rows, f"spans array<{SPAN}>")
    return unpacked(rows.mapInArrow(_scan(arrow_schema(schema), chains, threshold), schema), columns, "spans")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
