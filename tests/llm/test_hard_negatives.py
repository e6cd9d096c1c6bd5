"""Scores from subset sums, and hard negatives against all pairs."""

from __future__ import annotations

import math

import numpy as np
from hypothesis import given, settings, strategies as st
from hypothesis.extra.numpy import arrays
from pyspark.sql import functions as F

from noctule.llm.hard_negatives import Best, SubsetSums, hard_negatives, packed_planes, unpacked_values


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 20), st.sampled_from([3, 9, 20]), st.data())
def test_scores_are_inner_products(dims, bits, data):
    whole = arrays(np.int64, st.tuples(st.integers(1, 6), st.just(dims)), elements=st.integers(-(1 << bits - 1), (1 << bits - 1) - 1))
    a, c = data.draw(whole), data.draw(whole)
    wide = unpacked_values(packed_planes(a, bits))
    assert (wide[:, :dims] == a).all() and not wide[:, dims:].any()
    assert (SubsetSums(wide, bits).scores(packed_planes(c, bits)) == c @ a.T).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.integers(0, 9)), max_size=30), max_size=6), st.integers(1, 4))
def test_best_keeps_the_first(parts, keep):
    best = Best(4, keep)
    for part in parts:
        group, score, ids = (np.array([r[k] for r in part], np.int64) for k in range(3))
        fits = score >= best.least[group]
        best.add(group[fits], score[fits], ids[fits])
        best.settle()
    got = list(zip(*(x.tolist() for x in best.settle()), strict=True))
    every = {r for part in parts for r in part}
    assert got == [r for g in range(4) for r in sorted((r for r in every if r[0] == g), key=lambda r: (-r[1], r[2]))[:keep]]


def mined(rows, lower, upper, scale=256, n_pos=5, n_neg=10):
    """Every pair, sorted."""
    good = [(i, lab, [math.floor(scale * x) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = 1 << 62
    out = []
    for a, label, v in {r[0]: r for r in sorted((g for g in good if g[0] is not None and g[0] % 100 == 0), reverse=True)}.values():
        scored = {(-sum(x * y for x, y in zip(v, w)), last if i is None else i, lab == label) for i, lab, w in good if i != a}
        same, other = (sorted(s[:2] for s in scored if s[2] is want) for want in (True, False))
        for p, pid in same[:n_pos]:
            fits = [s for s in other if lower * -p <= 100 * -s[0] <= upper * -p][:n_neg]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i) in enumerate(fits)]
    return [tuple(None if x == last else x for x in r) for r in out]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    single = [(i, lab, v and [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    got = sorted((tuple(r) for r in hard_negatives(df, **options).collect()), key=str)
    assert got == sorted(mined(single, options.get("lower", 30), options.get("upper", 90)), key=str)
    return got


def test_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), rng.normal(0, 0.2, 13).tolist()) for i in range(900)]
    # ties: the same vectors again under other ids; a hot label
    rows += [(1000 + i, 1, rows[i % 40][2]) for i in range(400)]
    assert len(check(spark, rows, block_bytes=100)) > 100
    check(spark, rows, lower=0, upper=100)


def test_rows_of_every_kind(spark):
    v = [0.5, -0.25, 1.0]
    rows = [
        (100, 1, v), (100, 1, v), (100, 2, [1.0, 1.0, 1.0]), (1, 1, v), (1, 1, v), (2, 1, [0.5]), (3, 2, [0.4, 0.0, 0.5]), (4, 2, [0.4, 0.0, 0.5]),
        (None, 2, [0.4, 0.0, 0.5]), (None, 1, v), (5, None, v), (6, 2, None), (7, 2, [0.1, None, 0.2]), (8, 2, [float("nan"), 0.0, 0.0]), (9, 2, [float("inf"), 0.0, 0.0]),
        (200, 3, [0.0, 0.0, 0.0]), (300, 4, []), (10, 2, []),
    ]
    got = check(spark, rows)
    assert {r[0] for r in got} == {100} and {r[3] for r in got} >= {3, 4, None}
    named = spark.createDataFrame([r + ("x", 1) for r in rows], "vec_id long, label int, embedding array<float>, score string, planes int")
    assert hard_negatives(named).count() == len(got)
    assert hard_negatives(named.limit(0)).count() == 0
    assert hard_negatives(named, anchor=F.lit(False)).count() == 0
