"""Runs of words: against a sequential version, and on texts of every kind."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from noctule.llm.periodic_runs import longest_run, periodic_runs, runs_of, runs_text, text_runs, window
from noctule.llm.suffix_tree import SuffixTree
from noctule.llm.words import space_words, split_words, texts_of


def slow_runs(words, least, exponent):
    """Every maximal stretch for every period; of stretches alike the smallest period."""
    best = {}
    for q in range(len(words) // 2, 0, -1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q, 2 * q):
                best[i, j - i + q] = q
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in best.items())


sequences = st.lists(st.integers(0, 3), max_size=40)
repeated = st.tuples(sequences, st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 8), sequences).map(lambda t: t[0] + t[1] * t[2] + t[3])


@settings(max_examples=300, deadline=None)
@given(st.one_of(sequences, repeated))
def test_runs_equal_slow_runs(symbols):
    for limits in ((2, 2), (6, 4), (3, 3)):
        assert [tuple(r) for r in runs_of(symbols, *limits).tolist()] == slow_runs(symbols, *limits)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(sequences, repeated), min_size=1, max_size=4))
def test_stretches_lose_no_run(texts):
    block = texts_of(pa.array([" ".join(f"w{x}" for x in t) for t in texts]))
    for limits in ((2, 2), (6, 4), (9, 3)):
        found = text_runs(block, split_words(block, space_words()), *limits)
        for k, t in enumerate(texts):
            assert [tuple(r) for r in found.get(k, np.empty((0, 3), int)).tolist()] == slow_runs(t, *limits)


@settings(max_examples=100, deadline=None)
@given(sequences)
def test_tree_orders_suffixes_and_extends(symbols):
    tree, n = SuffixTree(symbols), len(symbols)
    assert tree.order.tolist() == sorted(range(n + 1), key=lambda i: symbols[i:])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
    i, j = i[i != j], j[i != j]
    want = [next((k for k in range(n) if a + k >= n or b + k >= n or symbols[a + k] != symbols[b + k]), n) for a, b in zip(i, j)]
    assert tree.common(i, j).tolist() == want


def test_window():
    assert window(6, 4) == 5 and window(2, 2) == 1


LONG = " ".join(["one two three four"] * 10_000)
ROWS = [(1, "a b a b a b a b c", "r"), (2, None, "r"), (3, "", "r"), (4, " \n\t ", "r"), (5, LONG, "r"), (5, LONG, "r"), (None, "x\n\nx x x x\tx", "r"), (7, "a b c d e f g", "r")]


def test_texts_of_every_kind(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, runs string")
    rows = periodic_runs(docs).withColumn("lines", runs_text(F.col("runs"))).withColumn("top", longest_run(F.col("runs"))).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert (by[1]["lines"], by[1]["collapsed"], by[1]["top"]["period"]) == ("0,8,2\n", "a b c", 2)
    assert all((by[k]["n_words"], by[k]["runs"], by[k]["top"], by[k]["collapsed"]) == (0, [], None, "") for k in (2, 3, 4))
    assert (by[5]["lines"], by[5]["collapsed"], by[5]["n_words"]) == ("0,40000,4\n", "one two three four", 40_000)
    assert (by[None]["lines"], by[None]["collapsed"]) == ("0,6,1\n", "x")
    assert by[7]["collapsed_sha256"] == hashlib.sha256(b"a b c d e f g").hexdigest()
    slim = periodic_runs(docs, texts=False)
    assert "text" not in slim.columns and {r["collapsed"] for r in slim.collect()} == {None}
    assert periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, min_exponent=1)


def test_ties_take_the_first_run(spark):
    docs = spark.createDataFrame([(1, "a a a a a a b c c c c c c")], "doc_id long, text string")
    top = periodic_runs(docs).select(longest_run(F.col("runs")).alias("t")).first()["t"]
    assert (top["start"], top["length"], top["period"]) == (0, 6, 1)
