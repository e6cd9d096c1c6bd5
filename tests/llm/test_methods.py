"""Paths of the operators that the small tables do not reach."""

from __future__ import annotations

import random

import duckdb
import numpy as np

from noctule.llm import decontaminate, near_dup, quality, toxicity
from noctule.llm.queries import ORACLES, QUERIES
from tests.llm.test_queries import similar_classes


def test_refined_buckets_lose_no_link(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    texts = {}
    for group in range(3):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(60):
            copy, edits = list(base), rng.choice([0, 1, 2, 4, 6, 8])
            for at in rng.sample(range(len(copy)), edits):
                copy[at] = rng.choice(words)
            texts[len(texts)] = " ".join(copy)
            # a copy of a copy is nearer to it than to the base
            if edits >= 4:
                copy[rng.randrange(len(copy))] = rng.choice(words)
                texts[len(texts)] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = similar_classes(texts)
    assert 1 < len(set(want.values())) < len(texts)
    for at_once in (0, near_dup.PAIRS_PER_TEXT):
        monkeypatch.setattr(near_dup, "PAIRS_PER_TEXT", at_once)
        assert {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()} == want


def test_heavy_shingles_have_their_share(spark):
    # a line repeated many times is most of a text's weight and few of its shingles
    texts = {}
    for pair in range(48):
        line = " ".join(f"l{pair}x{k}" for k in range(12))
        repeats, own = [(50, 40), (100, 60), (100, 100), (200, 100), (200, 250), (50, 100)][pair % 6]
        for side in range(2):
            tail = " ".join(f"o{pair}x{side}x{k}" for k in range(own))
            texts[len(texts)] = "\n".join([line] * (repeats + side * (pair % 4))) + "\n" + tail
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = similar_classes(texts)
    assert 48 < len(set(want.values())) < 64
    assert {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(df).collect()} == want


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(8)
    n, rows = 60, 400
    agreed, similarity = [], []
    for _ in range(rows):
        unit = rng.uniform(1, 10, n)
        counts = rng.choice([0, 1, 1, 2, 3, 7, 150], (2, n))
        counts[:, 0] = 1
        row, at = np.nonzero(counts)
        shingle = rng.integers(0, 1 << 48, n).astype(np.uint64)
        sample = near_dup.least_darts(row, shingle[at], unit[at], counts[row, at], 2)
        agreed.append((sample[0] == sample[1]).mean())
        similarity.append((unit * counts.min(0)).sum() / (unit * counts.max(0)).sum())
    assert abs(np.mean(np.array(agreed) - similarity)) < 4 * 0.5 / (rows * near_dup.SAMPLES) ** 0.5
    assert np.std(np.array(agreed) - similarity) < 1.2 * np.sqrt(np.mean(np.array(similarity) * (1 - np.array(similarity))) / near_dup.SAMPLES)


def test_only_frequent_words_reach_the_driver(spark, monkeypatch):
    texts = [(k, "all " + ("half " if k % 2 else "") + " ".join(f"own{k}x{j}" for j in range(40))) for k in range(200)]
    docs = spark.createDataFrame(texts, "id long, text string").repartition(50)
    reached, read = [], type(docs).toLocalIterator
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda df, *a, **k: (reached.append(r) or r for r in read(df, *a, **k)))
    idf = near_dup.document_frequencies(docs, share=0.1)
    assert len(reached) == len(idf.hashes) == 2
    assert np.allclose(sorted(idf.values), [1, 1 + np.log(2)]) and idf.rest == 1 + np.log(10)


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "red x x green x blue"), (2, "red x x x x x x x x green blue"), (3, "blue green red")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "red green blue")], "item_id string, text string")
    index, phrases = decontaminate.indexed(docs, items)
    near = decontaminate.search(index, phrases, within=5)
    rows = index.where("doc IS NOT NULL").select("segment", "doc", "row.doc_id")
    assert {r["doc_id"] for r in near.join(rows, ["segment", "doc"]).collect()} == {1, 3}
    assert decontaminate.search(index, phrases).count() == 0


def test_items_without_id_count(spark, tmp_path):
    docs = [(1, "a b c d e f g"), (2, "x y z"), (3, "a b c x y z"), (4, "none of them"), (5, None)]
    items = [(None, "x y z"), (None, "d e"), ("7", "a b c"), (None, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    query = con.execute(ORACLES["op6_decontamination"])
    names = [c[0] for c in query.description]
    got = QUERIES["op6_decontamination"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(query.fetchall())
    kept = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]


def test_em_recovers_rule_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where((rng.random((20_000, 4)) < accuracy) == good[:, None], 1, -1) * (rng.random((20_000, 4)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, found, share = quality.estimate(patterns, counts.astype(float))
    assert np.abs(found - accuracy).max() < 0.03 and abs(share - 0.7) < 0.03


def test_noisy_or_finds_the_guilty_feature():
    # feature 0 makes a document toxic, feature 1 is everywhere
    doc, sentence, feature, label = [], [], [], []
    for k in range(200):
        for s in range(4):
            doc.append(k), sentence.append(4 * k + s), feature.append(1)
        if k % 2:
            doc.append(k), sentence.append(4 * k + k % 4), feature.append(0)
        label.append(k % 2)
    weights, bias = toxicity.fit(np.array(doc), np.array(sentence), np.array(feature), np.array(label), 2)
    score = lambda *f: 1 / (1 + np.exp(-bias - sum(weights[i] for i in f)))
    assert score(0, 1) > 0.9 and score(1) < 0.1
