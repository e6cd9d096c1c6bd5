"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram is its three letter
vectors, rotated by two, one and no places, multiplied; texts and languages are sums of their trigrams.
A text's language is the prototype of greatest cosine.

A text is reduced to counts of its trigrams first, so vectors are formed once per different trigram of a batch
and texts are one matrix product. Prototypes are sums over all training documents: each task adds up trigram
counts per language and emits one vector per language it has seen; Spark adds these. What reaches the driver is one
vector per language. Before comparison the mean of the prototypes is taken off them: what all
languages share says nothing about any. A text's own vector enters as it is.

Letters are Unicode letters after lower-casing; every run of other characters is one boundary. Texts that are null
or have no letter are ``und`` with score 0. Of languages with equal cosine the first by name wins. With no training
rows every text is ``und``. Repeated rows count as often as they stand; an empty table gives no rows. Added columns replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import arrow_schema, batch_of, drop_held, row_struct, ship, unpacked, with_row

DIMENSIONS = 1024
UNKNOWN = "und"
# Characters handled at once.
BLOCK_CHARS = 1 << 19
# Different trigrams and texts whose vectors are in memory together, and letters kept.
SLICE, ROWS, KEPT_LETTERS = 4096, 256, 50_000
# Code points below 2^21, so three fit in one 64-bit number.
SHIFT = 21


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """+1/-1 vectors; each depends on its code point alone."""
    out = np.empty((len(codes), dimensions), np.int8)
    for k, code in enumerate(codes.tolist()):
        out[k] = np.random.Generator(np.random.PCG64(code + 1)).integers(0, 2, dimensions, dtype=np.int8)
    return out * 2 - 1


class Profiles:
    """Trigram vectors, letter vectors kept per worker."""

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions
        self.known: dict[int, np.ndarray] = {}

    def trigrams(self, keys: np.ndarray) -> np.ndarray:
        mask = (1 << SHIFT) - 1
        parts = [(keys >> (SHIFT * k)) & mask for k in (2, 1, 0)]
        codes = np.unique(np.concatenate(parts))
        if len(self.known) > KEPT_LETTERS:
            self.known.clear()
        new = [c for c in codes.tolist() if c not in self.known]
        for code, vector in zip(new, letter_vectors(np.array(new), self.dimensions), strict=True):
            self.known[code] = vector
        table = np.stack([self.known[c] for c in codes.tolist()])
        first, second, third = (np.searchsorted(codes, p) for p in parts)
        return np.roll(table, 2, axis=1)[first] * np.roll(table, 1, axis=1)[second] * table[third]

    def bundle(self, rows: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Sums of trigram vectors per row, a bounded number of different trigrams at a time."""
        out = np.zeros((n, self.dimensions), np.float32)
        different, number = np.unique(keys, return_inverse=True)
        for lo in range(0, len(different), SLICE):
            mine = (number >= lo) & (number < lo + SLICE)
            some = different[lo : lo + SLICE]
            grid = np.zeros((n, len(some)), np.float32)
            np.add.at(grid, (rows[mine], number[mine] - lo), counts[mine])
            out += grid @ self.trigrams(some).astype(np.float32)
        return out


@lru_cache(maxsize=2)
def profiles(dimensions: int) -> Profiles:
    return Profiles(dimensions)


def trigram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, trigram and count of each different trigram of each text, and which texts have a letter."""
    lowered = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in lowered])
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes + 1)
    letter = _letters()[codes]
    has = np.bincount(rows[letter], minlength=len(texts)) > 0
    codes[~letter] = 0
    # one boundary for each run of other characters
    stay = letter | np.concatenate([[True], letter[:-1]])
    codes, rows = codes[stay], rows[stay]
    before = np.concatenate([[0], codes[:-1]])
    before[np.concatenate([[True], rows[1:] != rows[:-1]])[: len(rows)]] = 0
    after = np.concatenate([codes[1:], [0]])
    middle = codes > 0
    keys = (before[middle] << (2 * SHIFT)) | (codes[middle] << SHIFT) | after[middle]
    rows = rows[middle]
    different, number = np.unique(keys, return_inverse=True)
    pair, counts = np.unique(rows * max(len(different), 1) + number, return_counts=True)
    return pair // max(len(different), 1), different[pair % max(len(different), 1)] if len(pair) else different, counts, has


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of rows of bounded text size."""
    drop_held()
    texts, at, size = batch.column("text").to_pylist(), 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield at, texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def train(df: DataFrame, lang: Column, text: Column, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """One prototype per language over all rows with a language."""
    ship(df.sparkSession)

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for at, texts in _groups(batch):
                rows, keys, counts, _ = trigram_counts(texts)
                # counts per language before vectors: few products, whatever the number of texts
                names, of_row = np.unique(langs[at : at + len(texts)].astype(str), return_inverse=True)
                vectors = profiles(dimensions).bundle(of_row[rows], keys, counts, len(names))
                for name, vector in zip(names.tolist(), vectors, strict=True):
                    sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    partial = df.where(lang.isNotNull() & text.isNotNull()).select(lang.cast("string").alias("lang"), text.alias("text"))
    partial = partial.mapInArrow(bundle, "lang string, vector array<double>")
    added = partial.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    whole = added.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("vector"))
    return {r["lang"]: np.array(r["vector"]) for r in whole.toLocalIterator()}


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the cosine mapped to 0 to 1."""
    ship(df.sparkSession)
    names = sorted(prototypes)
    table = np.zeros((0, dimensions))
    if names:
        table = np.stack([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-12) for n in names])
        if len(names) > 1:
            table = table - table.mean(axis=0)
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
    table = table.astype(np.float32).T
    packed = df.select(row_struct(df), F.col(f"`{text_col}`").alias("text"))
    schema = with_row(packed, "lang_pred string, score double")
    out = arrow_schema(schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _groups(batch):
                rows, keys, counts, has = trigram_counts(texts)
                found, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                for lo in range(0, len(texts), ROWS) if names else ():
                    mine = slice(*np.searchsorted(rows, [lo, lo + ROWS]))
                    text_vectors = profiles(dimensions).bundle(rows[mine] - lo, keys[mine], counts[mine], min(ROWS, len(texts) - lo))
                    norm = np.maximum(np.linalg.norm(text_vectors, axis=1), 1e-12)
                    cosine = (text_vectors @ table) / norm[:, None]
                    best = cosine.argmax(axis=1)
                    some = has[lo : lo + ROWS]
                    found[lo : lo + ROWS][some] = np.array(names, object)[best[some]]
                    scores[lo : lo + ROWS][some] = (np.clip(cosine.max(axis=1), -1, 1)[some] + 1) / 2
                part = batch.slice(at, len(texts))
                yield batch_of(out, row=part.column("row"), lang_pred=found.tolist(), score=scores.astype(float))

    return unpacked(packed.mapInArrow(judge, schema), df.columns, "lang_pred", "score")


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows a model must not learn from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``df`` with ``held_out``, ``lang_pred`` and ``score``; learned from the rows that are not held out."""
    prototypes = train(df.where(~held_out(id_col)), F.col(f"`{lang_col}`"), F.col(f"`{text_col}`"))
    return predict(df.withColumn("held_out", held_out(id_col)), prototypes, text_col)
