"""The numbered queries and the pipeline on the smallest tables: against SQL, or against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from noctule.llm.bpe import default_path
from noctule.llm.queries import ORACLES, QUERIES
from tests.compare import compare, connect
from tests.conftest import SF_DIR

WORDS = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


@pytest.fixture(scope="module")
def token_ids(texts):
    tokenizer = Tokenizer.from_file(default_path())
    return {k: e.ids for k, e in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False), strict=True)}


def by_doc(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    same, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert same and "types" not in note, note


def test_token_files(spark, token_ids):
    got, start = by_doc(spark, "op9_token_files"), 0
    for doc, ids in token_ids.items():
        whole = np.array([*ids, 0], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(whole), zlib.crc32(whole.tobytes()))
        start += len(whole)
    assert len(got) == len(token_ids)


def check_packed(rows, token_ids, capacity=1024):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(token_ids)
    for doc, ids in token_ids.items():
        whole, at = np.array([*ids, 2], "<u4"), 0
        assert len(pieces[doc]) == -(-len(whole) // capacity)
        for k, r in enumerate(sorted(pieces[doc], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == capacity)
            assert r["ids_crc32"] == zlib.crc32(whole[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(whole)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity and sum(3 * r["length"] > capacity for r in own) <= 2
    return len(sequences), sum(r["length"] for r in rows) / capacity


def test_packing(spark, token_ids):
    used, least = check_packed(QUERIES["op7_best_fit_packing"](spark, SF_DIR).collect(), token_ids)
    assert used <= 1.02 * least + 1


def similar_classes(texts):
    """Components of all pairs of weighted Jaccard similarity 0.8 or more."""
    words = {k: ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t)) for k, t in texts.items()}
    df, n = Counter(w for ws in words.values() for w in set(ws)), len(words)
    idf = {w: 1 + math.log(n / c if c >= 0.01 * n else 100) for w, c in df.items()}
    sets, where = {}, {}
    for k, ws in words.items():
        size, own = min(5, len(ws)), Counter()
        for i in range(len(ws) - size + 1) if size else ():
            own[tuple(ws[i : i + size])] += sum(idf[w] for w in ws[i : i + size]) / size
        sets[k] = own
        for s in own:
            where.setdefault(s, []).append(k)
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in {(x, y) for ks in where.values() for x in ks for y in ks if x < y}:
        both = sum(min(v, sets[b][s]) for s, v in sets[a].items() if s in sets[b])
        if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in texts}


def test_near_duplicates(spark, texts):
    got = {k: r["class_id"] for k, r in by_doc(spark, "op8_minhash_near_dedup").items()}
    assert got == similar_classes(texts)


def test_quality_counts(spark, texts):
    got = by_doc(spark, "op10_quality_rules")
    assert set(got) == set(texts)
    for doc, text in texts.items():
        words, r = WORDS.findall(text), got[doc]
        three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        counts = Counter(three)
        repeat = {i + k for i, w in enumerate(three) if counts[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeat) > 50 * len(words))
        assert not (r["kept"] and r["base_failed"])


def test_quality_follows_labels(spark, con):
    got = by_doc(spark, "op10_quality_rules")
    good = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    clean = [got[d]["kept"] for d, q in good.items() if q == 1 and not got[d]["base_failed"]]
    assert sum(clean) >= 0.98 * len(clean)


def test_language_held_out(spark, con):
    got = by_doc(spark, "op4_language_id")
    rows = con.execute("SELECT doc_id, lang FROM documents").fetchall()
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _ in rows)
    test = [got[d]["lang_pred"] == lang for d, lang in rows if got[d]["held_out"]]
    assert sum(test) >= 0.97 * len(test)


def test_toxicity_held_out(spark):
    # the smallest tables have nine toxic documents, too few to learn from
    sf_dir = SF_DIR.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in QUERIES["op3_toxicity"](spark, sf_dir).collect()}
    labels = connect(sf_dir).execute("SELECT doc_id, toxic FROM labels").fetchall()
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, _ in labels)
    clean = [got[d]["predicted"] for d, t in labels if t == 0]
    assert sum(clean) <= 0.03 * len(clean)
    toxic = [got[d]["predicted"] for d, t in labels if t == 1 and not got[d]["held_out"]]
    assert sum(toxic) >= 0.5 * len(toxic)
    assert all(got[d]["offending"] for d, _ in labels if got[d]["predicted"])


def test_pipeline(spark, texts, tmp_path):
    docs, kept = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
    assert {r["doc_id"] for r in kept["language_id"]} == {k for k, t in texts.items() if any(c.isalpha() for c in t)}
    classes = similar_classes({r["doc_id"]: r["text"] for r in kept["language_id"]})
    assert {r["doc_id"] for r in kept["near_dedup"]} == set(classes.values())

    seen, want = set(), {}
    for r in sorted(kept["near_dedup"], key=lambda r: r["doc_id"]):
        words = WORDS.findall(r["text"])
        windows = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        gone = {i + k for i, w in enumerate(windows) if w in seen for k in range(50)}
        seen |= set(windows)
        want[r["doc_id"]] = [w for i, w in enumerate(words) if i not in gone]
    got = {r["doc_id"]: WORDS.findall(r["text"]) for r in kept["substring_dedup"]}
    assert got == {k: v for k, v in want.items() if v}
    same = {r["doc_id"]: r["text"] for r in kept["near_dedup"]}
    assert all(r["text"] == same[r["doc_id"]] for r in kept["substring_dedup"] if len(WORDS.findall(same[r["doc_id"]])) == len(got[r["doc_id"]]))

    lower = lambda t: ALNUM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
    phrases = {}
    for (text,) in connect(SF_DIR).execute("SELECT text FROM benchmark").fetchall():
        words = lower(text or "")
        n = min(13, len(words))
        phrases.setdefault(n, set()).update(tuple(words[i : i + n]) for i in range(len(words) - n + 1) if n)
    clean = set()
    for r in kept["substring_dedup"]:
        words = lower(r["text"])
        hit = {i + k for n, ps in phrases.items() if n for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in ps for k in range(n)}
        if not hit or 20 * len(hit) < len(words):
            clean.add(r["doc_id"])
    assert {r["doc_id"] for r in kept["benchmark_decontamination"]} == clean

    tokenizer = Tokenizer.from_file(default_path())
    check_packed(kept["packing"], {r["doc_id"]: tokenizer.encode(r["text"], add_special_tokens=False).ids for r in kept["benchmark_decontamination"]})
