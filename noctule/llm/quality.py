"""Weak supervision of text quality: rules vote or abstain, EM weighs them, a posterior decides.

Each rule of ``RULES`` looks at statistics of one document and votes good (1), bad (-1) or abstains (0).
Rules are taken as independent given the true quality. Expectation-maximisation estimates the share of
good documents and for each rule how often it votes good, bad or abstains on good and on bad documents.
A document is kept if the posterior probability that it is good reaches ``threshold``; no single rule
decides, and a document on which all abstain has the prior.

The likelihood depends on the votes alone, so EM runs on the counts of the vote patterns: one small row
per pattern (3 to the power of the number of rules at most), counted over all documents. Votes are
computed one document at a time within Arrow batches; nothing about documents is gathered.

Null and empty texts have no words and fail the base test. Ties and repeated rows are counted as often
as they stand. On an empty table nothing is estimated and no rows come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frames import arrow_schema, batch_of, row_struct, ship, unpacked, with_row
from .words import BASES, Texts, Words, blocks, byte_sums, covered, signed, space_words, span_hashes, split_words, window_hashes, window_starts, word_hashes

SYMBOLS = b"#*$%&|<>"
STAT_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_stop", "n_ended"]
STATS = ", ".join(f"{c} long" for c in STAT_COLUMNS)


def text_stats(texts: Texts, words: Words) -> dict[str, np.ndarray]:
    """Counts per text of a block; all of them whole numbers over the whole text."""
    data, rows = texts.data, len(texts.starts) - 1
    of_word = words.row_of()

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[texts.starts[1:]] - sums[texts.starts[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.first, 1)
    np.add.at(inside, words.end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    upper = (data >= 0x41) & (data <= 0x5A)
    lower = (data >= 0x61) & (data <= 0x7A)
    out = {
        "n_words": words.counts,
        "word_chars": per_text(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": per_text(symbol[data]),
        "n_upper": per_text(upper),
        "n_letters": per_text(upper | lower | (data >= 0xC3)),
    }

    # words in three-word windows that stand twice or more in their text
    hashes = word_hashes(data, words)
    starts = window_starts(words, 3)
    key = signed(window_hashes(hashes, starts, 3)) * 31 + of_word[starts]
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    twice = starts[n[back] > 1]
    repeat = covered(int(words.rows[-1]), twice, twice + 3)
    out["n_repeat_words"] = np.bincount(of_word[repeat], minlength=rows)

    # lines: from each text start and each newline on; a line counts if a word starts in it
    newline = np.flatnonzero(data == 0x0A)
    first = np.unique(np.concatenate([texts.starts[:-1], newline + 1]))
    first = first[first < len(data)]
    end = np.append(first[1:], len(data))
    of_line = np.searchsorted(texts.starts, first, "right") - 1
    if not len(first):
        return out | {c: np.zeros(rows, np.int64) for c in ("n_lines", "n_dup_lines", "n_ended", "n_stop")}
    end = np.where(data[end - 1] == 0x0A, end - 1, end)
    full = np.searchsorted(words.first, first) < np.searchsorted(words.first, end)
    first, end, of_line = first[full], end[full], of_line[full]
    sums = [byte_sums(data, k) for k in (0, 1)]
    keys = np.stack([of_line.astype(np.uint64), *[span_hashes(s, first, end, BASES[k][0]) for k, s in enumerate(sums)]], axis=1)
    out["n_lines"] = np.bincount(of_line, minlength=rows)
    different = np.unique(keys, axis=0)[:, 0].astype(np.int64) if len(keys) else np.empty(0, np.int64)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(different, minlength=rows)
    stop = np.isin(data[end - 1], list(b".!?:;\"'"))
    out["n_ended"] = np.bincount(of_line[stop], minlength=rows)
    # words of one to three bytes stand for function words, whatever the language
    short = (words.end - words.first) <= 3
    out["n_stop"] = np.bincount(of_word[short], minlength=rows)
    return out


def _share(part: str, whole: str) -> str:
    return f"{part} / greatest({whole}, 1)"


# What is measured, and where the votes "bad" and "good" begin; without a bound the rule never casts that vote.
RULES: dict[str, tuple[str, str | None, str | None]] = {
    "symbols": (_share("n_symbols", "n_words"), ">= 0.1", None),
    "duplicate_lines": (_share("n_dup_lines", "n_lines"), ">= 0.3", None),
    "repeated_words": (_share("n_repeat_words", "n_words"), ">= 0.3", None),
    "capitals": (_share("n_upper", "n_letters"), ">= 0.3", None),
    "long_words": (_share("word_chars", "n_words"), ">= 12", None),
    "short_words": (_share("word_chars", "n_words"), "< 3", None),
    "function_words": (_share("n_stop", "n_words"), "< 0.05", ">= 0.15"),
    "sentence_ends": (_share("n_ended", "n_lines"), "< 0.3", ">= 0.7"),
}


def vote(rule: str) -> Column:
    what, bad, good = RULES[rule]
    out = F.lit(0)
    for bound, value in ((good, 1), (bad, -1)):
        if bound:
            out = F.when(F.expr(f"{what} {bound}"), value).otherwise(out)
    return out


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100, tolerance: float = 1e-9) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: posterior of "good" per pattern, accuracy per rule, share of good documents.

    ``votes`` is patterns x rules with -1, 0, 1; ``counts`` says how many documents have each pattern. The
    start takes every rule as right more often than not, which fixes what the two classes mean; one
    document's worth of pseudo-counts per outcome keeps probabilities off zero.
    """
    shown = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    abstains = shown[:, :, 1].T @ counts / max(counts.sum(), 1)
    right, wrong = 0.8 * (1 - abstains), 0.2 * (1 - abstains)
    table = np.log(np.maximum([np.stack([wrong, abstains, right], 1), np.stack([right, abstains, wrong], 1)], 1e-6))
    share, last = 0.8, -np.inf
    for _ in range(rounds):
        joint = np.einsum("prv,crv->pc", shown, table) + np.log([share, 1 - share])
        whole = np.logaddexp(joint[:, 0], joint[:, 1])
        posterior = np.exp(joint[:, 0] - whole)
        weights = np.stack([posterior, 1 - posterior]) * counts
        seen = np.einsum("cp,prv->crv", weights, shown) + 1
        table = np.log(seen / seen.sum(axis=2, keepdims=True))
        share = float((weights[0].sum() + 1) / (counts.sum() + 2))
        now = float(whole @ counts)
        if abs(now - last) <= tolerance * max(1.0, abs(now)):
            break
        last = now
    told = seen[0, :, 0] + seen[0, :, 2] + seen[1, :, 0] + seen[1, :, 2]
    return posterior, (seen[0, :, 2] + seen[1, :, 0]) / told, share


def document_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts of :func:`text_stats`; they replace columns of the same names."""
    ship(df.sparkSession)
    packed = df.select(row_struct(df), F.col(f"`{text_col}`").alias("text"))
    schema = with_row(packed, STATS)
    out = arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = space_words()
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                yield batch_of(out, row=part.column("row"), **text_stats(texts, split_words(texts, inside)))

    return unpacked(packed.mapInArrow(scan, schema), df.columns, *STAT_COLUMNS)


def judge_quality(stats: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``stats`` (of :func:`document_stats`) with ``base_failed``, ``votes``, ``quality`` and ``kept``."""
    votes = F.array(*[vote(rule).cast("tinyint") for rule in RULES])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    columns = [c for c in stats.columns if c not in ("base_failed", "votes", "quality", "kept")]
    voted = stats.select(*[F.col(f"`{c}`") for c in columns], failed.alias("base_failed"), votes.alias("votes"))
    # one row per vote pattern, whatever the number of documents
    patterns = voted.groupBy("votes").count().collect()
    spark = stats.sparkSession
    schema = "votes array<tinyint>, quality double"
    if patterns:
        posterior, _, _ = estimate(np.array([list(p["votes"]) for p in patterns]), np.array([float(p["count"]) for p in patterns]))
        table = spark.createDataFrame([(list(p["votes"]), float(q)) for p, q in zip(patterns, posterior, strict=True)], schema)
    else:
        table = spark.createDataFrame([], schema)
    judged = voted.join(F.broadcast(table), "votes", "left")
    return judged.select(*[F.col(f"`{c}`") for c in columns], "base_failed", "votes", "quality", (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"))
