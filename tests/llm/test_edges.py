"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names: every operator."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from noctule.llm import decontaminate, files, language, near_dup, packing, quality, substring_dedup, token_file, toxicity, url_filter, warc

LONG = " ".join(f"word{k}" for k in range(30_000))
DOCS = "doc_id long, text string, row string, id long, h string, score string, lang string, n_words string"
CLASH = ("r", 1, "h", "s", "en", "n")
ROWS = [
    (1, LONG, *CLASH),
    (2, None, *CLASH),
    (3, "", *CLASH),
    (4, " \n\t ", *CLASH),
    (5, "Ünïcode ß 中文 𝔘 end.", *CLASH),
    (5, "Ünïcode ß 中文 𝔘 end.", *CLASH),
    (None, "a text without an id. idiot", *CLASH),
    (7, LONG, *CLASH),
    (8, "?? !! 123", *CLASH),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _labels(spark):
    return spark.createDataFrame([(1, 0), (5, 1), (3, None), (None, 1), (7, 0)], "doc_id long, toxic int")


def test_substring_dedup(docs, nothing):
    rows = substring_dedup.remove_repeats(docs).collect()
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert (by[1]["n_words"], by[1]["n_removed"]) == (30_000, 0)
    assert (by[7]["n_words"], by[7]["n_removed"], by[7]["kept_text"]) == (30_000, 30_000, "")
    assert by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0
    assert by[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[5]["row"] == "r" and by[5]["h"] == "h" and by[5]["kept_text"] == ROWS[4][1]
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_url_filter(spark):
    pages = spark.createDataFrame(
        [(1, None, "x"), (2, "no scheme", "x"), (3, "http://A.Net", "x"), (3, "http://a.net/", "x"), (None, "http://x.example.net/en/a", "x"), (4, "http://net/" + "a/" * 2000 + "?q", "x"), (5, "", "x")],
        "page_id long, url string, rule string",
    )
    rules = url_filter.rules_frame(spark, [("block", "net/"), ("allow", "example.net/en/"), ("allow", "net/")])
    got = {(r["page_id"], r["url"]): r for r in url_filter.judge_urls(pages, rules).collect()}
    assert len(got) == 7
    assert got[1, None]["host"] == "" and got[1, None]["verdict"] == "allow" and got[2, "no scheme"]["rule"] is None
    assert got[3, "http://A.Net"]["host"] == "a.net" and got[3, "http://A.Net"]["rule"] is None
    assert got[3, "http://a.net/"]["verdict"] == "block"
    assert got[None, "http://x.example.net/en/a"]["rule"] == "example.net/en/"
    assert got[4, "http://net/" + "a/" * 2000 + "?q"]["verdict"] == "block"
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_toxicity(spark, docs, nothing):
    rows = toxicity.classify(docs, _labels(spark)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == 0 and r["score"] == 0 for r in rows if not r["text"])
    assert toxicity.classify(nothing, _labels(spark)).count() == 0
    assert {r["score"] for r in toxicity.classify(docs, _labels(spark).limit(0)).collect()} == {0.0}


def test_language(docs, nothing):
    rows = language.identify(docs).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS) and by[1]["lang_pred"] == "en"
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (2, 3, 4, 8))
    assert language.identify(nothing).count() == 0
    untaught = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame(
        [(3, "http://a", "same", 1), (1, None, "same", 1), (2, "u\r\nX: y", None, 1), (4, "u", "", 1), (5, "u", LONG, 1), (5, "u", LONG, 1), (None, "n", "same", 1), (None, "n", "alone", 1)],
        "page_id long, url string, html string, size int",
    )
    folder = files.shared_folder(spark, "warc", str(tmp_path))
    rows = warc.read_warc(warc.write_warc(pages, folder, file_bytes=400), folder).collect()
    got = sorted([(r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows])
    assert got == [(-1, "response", None, 5), (-1, "revisit", 1, 4), (1, "response", None, 4), (2, "response", None, 0), (3, "revisit", 1, 4), (4, "revisit", 2, 0), (5, "response", None, len(LONG)), (5, "response", None, len(LONG))]
    again = warc.write_warc(pages, folder, min_bytes=5, prefix="min")
    assert {r["record_type"] for r in warc.read_warc(again, folder).collect()} == {"response"}
    none = files.shared_folder(spark, "warc", str(tmp_path))
    assert warc.read_warc(warc.write_warc(pages.limit(0), none), none).count() == 0


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame([("a", "word5 word6 word7"), ("a", "word5 word6 word7"), ("b", None), ("c", ""), (None, "word9"), ("d", "End!")], "item_id string, text string")
    rows = decontaminate.contamination(docs, items).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS)
    assert (by[1]["n_hit"], by[1]["n_items"], by[1]["contaminated"]) == (3, 1, False)
    assert (by[5]["n_hit"], by[5]["contaminated"]) == (1, True) and by[2]["n_words"] == 0 and not by[2]["contaminated"]
    assert by[1]["items_sha256"] == hashlib.sha256(b"a").hexdigest() and by[1]["row"] == "r"
    assert decontaminate.contamination(nothing, items).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()} == {0}
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2


def test_packing(docs, nothing):
    rows = packing.pack_documents(docs).collect()
    assert sum(r["piece"] == 0 for r in rows) == len(ROWS)
    filled: dict[int, list] = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(nothing).count() == 0


def test_near_duplicates(docs, nothing):
    rows = near_dup.near_duplicates(docs).collect()
    by = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == len(ROWS)
    assert by[1] == by[7] == 1 and by[2] == by[3] == 2 and by[4] == 4 and by[5] == 5 and by[None] is None
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 8]
    assert near_dup.near_duplicates(nothing).count() == near_dup.drop_near_duplicates(nothing).count() == 0


def test_token_files(spark, docs, nothing):
    rows = token_file.roundtrip(docs).collect()
    assert len(rows) == len(ROWS)
    ends = sorted((r["start"], r["start"] + r["n_tokens"], r["doc_id"]) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:])) and ends[-1][2] is None
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert token_file.roundtrip(nothing).count() == 0


def test_quality(docs, nothing):
    rows = quality.judge_quality(quality.document_stats(docs)).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ROWS) and by[1]["n_words"] == 30_000
    assert all(by[k]["n_words"] == 0 and by[k]["base_failed"] and not by[k]["kept"] for k in (2, 3, 4))
    assert by[5]["word_chars"] == 15 and by[5]["row"] == "r"
    assert quality.judge_quality(quality.document_stats(nothing)).count() == 0


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    import pyarrow as pa

    from noctule.llm.frames import BATCH_BYTES, ship

    def sizes(batches):
        for b in batches:
            yield pa.record_batch({"rows": pa.array([b.num_rows], pa.int64()), "bytes": pa.array([b.nbytes], pa.int64())})

    ship(spark)
    got = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 5000) AS text").mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 3000 and max(r["bytes"] for r in got) < 1.5 * BATCH_BYTES
