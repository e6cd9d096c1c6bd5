"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's score is a logistic function of the words in it and of their beginnings (four to six bytes, so
compounds and inflections of a known stem count). A document is toxic if any sentence is: its score is the
noisy-or of its sentences. The weights are fitted to document labels through the noisy-or, which settles by
itself which sentences carry a label; the same sentence scores then say where the offence is.

1. A bounded sample of labelled rows is taken per label, in order of a hash of the id (``sample``).
2. Features are counted over the sample in tasks, and those kept that stand clearly more often in toxic documents.
3. The sample is reduced to the kept features of each sentence, fitted on the driver (its size is bounded by the
   sample), and the weights, one per kept feature, are sent to the tasks that score every whole document.

A sentence ends at ``.``, ``!``, ``?`` or a newline. Words are runs of ASCII letters, lower-cased, and of
non-ASCII bytes. A sentence without a kept feature has score 0, and so have empty and null texts and every text
if no labels of both kinds exist. Labels that are null or not 0 or 1 are not learned from; several labels of one
id are each learned from. Ties and repeated rows get equal scores. Null ids are never learned from. Added columns replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import materialize, scratch_scope
from .frames import arrow_schema, batch_of, row_struct, ship, unpacked, with_row
from .words import BASES, Texts, blocks, byte_sums, lower_ascii, signed, span_hashes, split_words

# Labelled documents to learn from, per label.
SAMPLE = 4000
PREFIXES = (4, 5, 6)
# A feature is kept if at least so many toxic sample documents have it, and so many times the share of clean ones.
LEAST_DOCUMENTS, LEAST_RATIO = 4, 4.0
MAX_FEATURES = 20_000
ENDS = b".!?\n"


class Features(NamedTuple):
    """One entry per feature: text row, sentence number (rising over the block), hash."""

    row: np.ndarray
    sentence: np.ndarray
    hash: np.ndarray


def features(texts: Texts, kept: np.ndarray | None = None) -> Features:
    """All features of a block of texts, or those in ``kept`` (sorted)."""
    inside = np.zeros(256, bool)
    inside[0x61:0x7B] = inside[0x80:] = True
    data = lower_ascii()[texts.data]
    words = split_words(texts._replace(data=data), inside)
    stop = np.isin(texts.data, list(ENDS))
    row = words.row_of()
    sentence = np.concatenate([[0], np.cumsum(stop)])[words.first] + row
    sums = byte_sums(data)
    size = words.end - words.first
    found = []
    for n in (0, *PREFIXES):
        mine = np.flatnonzero(size > n if n else size > 1)
        first = words.first[mine]
        h = span_hashes(sums, first, first + n if n else words.end[mine], BASES[0][0])
        h = signed(h ^ np.uint64(n))
        if kept is not None:
            # a table of low bits first: nearly all words leave here
            low = np.zeros(1 << 20, bool)
            low[kept & 0xFFFFF] = True
            some = np.flatnonzero(low[h & 0xFFFFF])
            at = np.searchsorted(kept, h[some])
            at[at == len(kept)] = 0
            some = some[kept[at] == h[some]] if len(kept) else some[:0]
            mine, h = mine[some], h[some]
        found.append((row[mine], sentence[mine], h))
    return Features(*(np.concatenate(x) for x in zip(*found, strict=True)))


class Model(NamedTuple):
    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def sentences(self, f: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text row, number and score of each sentence with a kept feature."""
        # a feature counts once per sentence
        key = np.unique(np.stack([f.row, f.sentence, np.searchsorted(self.hashes, f.hash)], axis=1), axis=0)
        sentence, first, back = np.unique(key[:, 1], return_index=True, return_inverse=True)
        z = self.bias + np.bincount(back, self.weights[key[:, 2]], len(sentence)) if len(key) else np.empty(0)
        return key[first, 0], sentence, 1 / (1 + np.exp(-z))


def fit(doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, label: np.ndarray, n_features: int, rounds: int = 300, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that make the noisy-or of sentence scores likeliest, by Adam over the whole sample.

    One entry per feature of a sentence, sentences numbered from 0 in order of their documents; ``label`` is per document.
    """
    n = int(sentence.max()) + 1 if len(sentence) else 0
    doc_of = np.zeros(n, np.int64)
    doc_of[sentence] = doc
    toxic = label[doc_of] == 1
    each = 1 / max(len(label), 1)
    w = np.zeros(n_features + 1)
    w[-1] = -2.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        z = w[-1] + np.bincount(sentence, w[feature], n)
        p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-9)
        clean = np.bincount(doc_of, np.log1p(-p), len(label))
        none = np.exp(clean)[doc_of]
        slope = np.where(toxic, -p * none / np.maximum(1 - none, 1e-9), p) * each
        g = np.append(np.bincount(feature, slope[sentence], n_features), slope.sum()) + decay * each * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w[:-1], float(w[-1])


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit to ``sample`` documents of each label at most, all if there are fewer."""
    ship(docs.sparkSession)
    with scratch_scope(docs.sparkSession):
        return _train(docs, labels, id_col, text_col, label_col, sample)


def _train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> Model:
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = materialize(chosen, "labelled")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    # at most 2 * sample ids
    rows = materialize(texts.join(F.broadcast(chosen), "id").select("label", "text"), "sample")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "text"):
                f = features(block)
                label = part.column("label").to_numpy()
                pairs = np.unique(np.stack([f.hash, f.row], axis=1), axis=0)
                h, back = np.unique(pairs[:, 0], return_inverse=True)
                toxic = np.bincount(back, label[pairs[:, 1]], len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(toxic), pa.array(np.bincount(back, minlength=len(h)) - toxic)], names=["h", "toxic", "clean"])

    counts = rows.mapInArrow(count, "h long, toxic long, clean long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = F.col("toxic") / F.lit(max(totals.get(1, 0), 1)), F.col("clean") / F.lit(max(totals.get(0, 0), 1))
    strong = counts.where((F.col("toxic") >= LEAST_DOCUMENTS) & (share[0] >= LEAST_RATIO * share[1])).orderBy((share[0] - share[1]).desc(), "h").limit(MAX_FEATURES)
    kept = np.sort(np.array([r["h"] for r in strong.select("h").collect()], np.int64))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "text"):
                f = features(block, kept)
                out = []
                for k, label in enumerate(part.column("label").to_pylist()):
                    mine = f.row == k
                    pairs = np.unique(np.stack([f.sentence[mine], np.searchsorted(kept, f.hash[mine])], axis=1), axis=0)
                    out.append((label, np.unique(pairs[:, 0], return_inverse=True)[1].tolist(), pairs[:, 1].tolist()))
                label, sentence, feature = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(sentence, pa.list_(pa.int32())), pa.array(feature, pa.list_(pa.int32()))], names=["label", "sentence", "feature"])

    small = rows.mapInArrow(reduce, "label int, sentence array<int>, feature array<int>").collect()
    doc, sentence, feature, base = [], [], [], 0
    for k, r in enumerate(small):
        doc.append(np.full(len(r["sentence"]), k))
        sentence.append(np.array(r["sentence"], np.int64) + base)
        feature.append(np.array(r["feature"], np.int64))
        base += max(r["sentence"], default=-1) + 1
    if not len(kept) or not base:
        return Model(np.empty(0, np.int64), np.empty(0), 0.0)
    weights, bias = fit(np.concatenate(doc), np.concatenate(sentence), np.concatenate(feature), np.array([r["label"] for r in small]), len(kept))
    return Model(kept, weights, bias)


def score(df: DataFrame, model: Model, text_col: str = "text", offending: float = 0.5) -> DataFrame:
    """``df`` with ``score`` and ``sentences``: number, score and text of those scored ``offending`` or more."""
    ship(df.sparkSession)
    packed = df.select(row_struct(df), F.col(f"`{text_col}`").alias("text"))
    schema = with_row(packed, "score double, sentences array<struct<number int, score double, text string>>")
    out = arrow_schema(schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "text"):
                row, sentence, p = model.sentences(features(block, model.hashes))
                clean = np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), part.num_rows) if len(row) else np.zeros(part.num_rows)
                located: list[list[dict]] = [[] for _ in range(part.num_rows)]
                ends = np.flatnonzero(np.isin(block.data, list(ENDS)))
                for k in np.flatnonzero(p >= offending).tolist():
                    r = int(row[k])
                    first, last = int(block.starts[r]), int(block.starts[r + 1])
                    before = int(np.searchsorted(ends, first))
                    nth = int(sentence[k]) - r - before
                    begin = first if nth == 0 else int(ends[before + nth - 1]) + 1
                    end = min(last, int(ends[before + nth]) + 1) if before + nth < len(ends) else last
                    located[r].append({"number": nth, "score": float(p[k]), "text": block.data[begin:end].tobytes().decode().strip()})
                yield batch_of(out, row=part.column("row"), score=np.abs(np.expm1(clean)), sentences=located)

    return unpacked(packed.mapInArrow(judge, schema), df.columns, "score", "sentences")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out``, ``score``, ``predicted`` and the offending ``sentences``; held-out labels are not used."""
    model = train(docs, labels.where(~held_out(id_col)), id_col, text_col, label_col)
    return score(docs.withColumn("held_out", held_out(id_col)), model, text_col).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
