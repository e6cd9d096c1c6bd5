"""The numbered queries over the given tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import materialize
from .decontaminate import contamination
from .hard_negatives import hard_negatives
from .language import identify
from .near_dup import near_duplicates
from .packing import pack_documents
from .periodic_runs import longest_run, periodic_runs, runs_text
from .quality import document_stats, judge_quality
from .secret_scan import of_kind, scan_secrets, spans_text
from .substring_dedup import remove_repeats
from .toxicity import classify
from .token_file import roundtrip as token_roundtrip
from .url_filter import judge_urls, rules_frame
from .warc import roundtrip as warc_roundtrip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    "op1_substring_dedup",
    r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
    SELECT doc_id, s, sha256(array_to_string(ws[s : s + 49], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS s FROM w WHERE len(ws) >= 50)
), again AS (
    SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY h) AS least FROM windows) WHERE doc_id > least
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM again
), kept AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS kept
    FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w) ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, length=50, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@_query(
    "op2_url_filter",
    r"""
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut
), rules AS (
    SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) r(verdict, h, p)
), best AS (
    SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (host, path)
""",
)
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules_frame(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


@_query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge_quality(materialize(document_stats(docs).drop("text"), "quality_stats"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality", "votes")


@_query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), capacity=1024, end_id=2)


@_query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_roundtrip(_table(spark, sf_dir, "documents"), end_id=0)


@_query(
    "op6_decontamination",
    r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[s : s + least(len(ws), 13) - 1], ' ') AS w
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS s FROM i WHERE len(ws) > 0)
), dw AS (
    SELECT doc_id, s, n, array_to_string(ws[s : s + n - 1], ' ') AS w
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)
), m AS (
    SELECT doc_id, s, n, item_id FROM dw JOIN iw USING (n, w)
), hit AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM m) GROUP BY doc_id
), its AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM m) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""",
)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(docs, _table(spark, sf_dir, "benchmark"), nameless=True)


@_query(
    "op5_warc",
    r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages
), b AS (
    SELECT *, array_to_string(list_transform(string_split(h, ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), '') AS bits FROM p
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM b
""",
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # files of 8 MB compressed, so that several are rolled and read side by side also here
    archived = warc_roundtrip(_table(spark, sf_dir, "pages"), file_bytes=8 << 20)
    return archived.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")


@_query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = classify(docs, _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted", F.expr("sentences.text").alias("offending"))


@_query("op8_minhash_near_dedup")
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), threshold=0.8)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; of one document in ten (crc32 of the id) the end repeats some of its own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    cut = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = cut.withColumn("words", F.when(F.col("chosen"), words))
    cut = cut.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    left = F.col("n") - F.col("a")
    cut = cut.withColumn("p", (F.floor(left / (3 + F.col("g") % 8)) + 1).cast("int"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@_query(
    "op11_periodic_runs",
    r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
           xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS h
    FROM documents
), cut AS (
    SELECT *, len(ws) AS n, h // 10 AS g, (h // 10) % greatest(len(ws), 1) AS a FROM w
), tailed AS (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(ws[1 : a], list_transform(range(a, n), lambda i: ws[a + (i - a) % p + 1])) ELSE ws END AS ws
    FROM (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM cut)
), words AS (
    SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM tailed
), three AS (
    SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS t, count(*) OVER (PARTITION BY doc_id) AS n
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM three x JOIN three y ON x.doc_id = y.doc_id AND x.t = y.t AND x.i < y.i WHERE 4 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + 2 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs)
    GROUP BY doc_id, q, part HAVING count(*) + 2 + q >= greatest(6, 4 * q)
), runs AS (
    SELECT doc_id, s, l, min(q) AS q FROM stretches GROUP BY doc_id, s, l
), best AS (
    SELECT doc_id, count(*) AS n_runs, arg_min({'start': s, 'length': l, 'period': q}, (-l, s, q)) AS top,
           string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY doc_id
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.start AS BIGINT) AS start, CAST(top.length AS BIGINT) AS length, CAST(top.period AS BIGINT) AS period,
       CAST(1000 * top.length // top.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, texts=False).withColumn("top", longest_run(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


@_query(
    "op12_hard_negatives",
    r"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.v, v.v) AS BIGINT) AS score
    FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER o AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER o <= 10
""",
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), positives=5, negatives=10, lower=30, upper=90, scale=256.0)


@_query("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    spans = F.col("spans")
    counts = [F.size(of_kind(spans, kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base = F.sha2(spans_text(of_kind(spans, "assign", "access", "hex")).cast("binary"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), spans_text(spans).alias("spans"))
