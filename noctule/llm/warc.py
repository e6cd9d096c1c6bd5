"""WARC archives: a deterministic, sharded writer and the reader.

Records are sorted by page id and cut into files by compressed size. Where a file ends depends on the sizes of
the records before it alone, not on how Spark has split the data: a record belongs to the file
``compressed bytes before it // file_bytes``, so any run over the same pages gives the same files, byte for byte.

1. The first page of each payload is found by digest (partial minima per task, so a payload that fills a third
   of the table costs no more); later ones become revisit records.
2. Each record is made anew: ids, block and payload digests, lengths, then one gzip member. A first pass keeps
   the members' sizes only.
3. Sizes are summed along the sorted ids, in ranges and then over range totals; a file's first record is
   known before anything is moved.
4. A second pass makes the members again, deals them by file and sorts within; each task writes one file under a
   temporary name, and a committed manifest gives it its name (:mod:`files`). Making members twice costs processor
   time but no copy of the archive on disk. Dates are a parameter, so nothing depends on the clock.

Null html is an empty payload, a null URL an empty target. Null page ids come first; they refer to each other's
first only if no page with an id has the payload. Rows with equal ids are told apart by URL and payload, and all rows with the
smallest id of a payload are responses. An empty table gives no file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import materialize, scratch_scope
from .files import Attempt, commit, one_task_each, read_file, shared_folder
from .frames import ship

# Compressed bytes after which a file is rolled.
FILE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"

MEMBER_SQL = "page_id long, url string, digest string, size long, member binary"
MANIFEST_SQL = "file long, temp string, name string, bytes long, records long, sha256 string"
RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    """The same page always gets the same id."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest} {url}'.encode()).digest()[:16], version=5)}>"


def make_record(page_id: int | None, url: str | None, html: str | None, first: tuple[int | None, str] | None, date: str = DATE) -> bytes:
    """One uncompressed record; ``first`` is the page a revisit refers to."""
    payload, target = (html or "").encode(), " ".join((url or "").split())
    digest = sha1_base32(payload)
    if first is None:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        block, kind = http + payload, "response"
    else:
        block, kind = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n", "revisit"
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page_id, target, digest),
        "WARC-Date": date,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{sha1_base32(block)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(len(payload)),
    }
    if first is not None:
        head |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(first[0], " ".join(first[1].split()), digest),
            "X-Refers-To-Page-ID": "" if first[0] is None else str(first[0]),
        }
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"not a record: {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().partition(":")
            head[name.strip()] = value.strip()
        block = stream.read(int(head["Content-Length"]))
        if f"sha1:{sha1_base32(block)}" != head["WARC-Block-Digest"]:
            raise ValueError(f"block digest of {head['WARC-Record-ID']}")
        yield head, block


def _members(date: str, level: int, keep: bool = True):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512).to_pylist()
                out = []
                for r in rows:
                    first = (r["first_id"], r["first_url"]) if r["revisit"] else None
                    record = make_record(r["page_id"], r["url"], r["html"], first, date)
                    member = gzip.compress(record, level, mtime=0)
                    out.append((r["page_id"], r["url"], r["digest"], len(member), member if keep else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)], names=["page_id", "url", "digest", "size", "member"])

    return make


def _written(folder: str, prefix: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out, count, sha = None, None, 0, hashlib.sha256()

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([current]), pa.array([out.temp]), pa.array([out.name]), pa.array([out.size]), pa.array([count]), pa.array([sha.hexdigest()])],
                names=["file", "temp", "name", "bytes", "records", "sha256"],
            )

        for batch in batches:
            for file, member in zip(batch.column("file").to_pylist(), batch.column("member"), strict=True):
                if file != current:
                    if out is not None:
                        yield done()
                    current, out, count, sha = file, Attempt(folder, f"{prefix}-{file:08d}.warc.gz"), 0, hashlib.sha256()
                data = member.as_py()
                out.write(data)
                sha.update(data)
                count += 1
        if out is not None:
            yield done()

    return write


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES, date: str = DATE, level: int = 6, prefix: str = "pages") -> DataFrame:
    """Write ``pages`` to ``folder``; returns the committed manifest, one row per file.

    Payloads of fewer than ``min_bytes`` bytes are never revisits.
    """
    ship(pages.sparkSession)
    with scratch_scope(pages.sparkSession):
        return _write(pages, folder, id_col, url_col, html_col, min_bytes, file_bytes, date, level, prefix)


def _write(pages: DataFrame, folder: str, id_col: str, url_col: str, html_col: str, min_bytes: int, file_bytes: int, date: str, level: int, prefix: str) -> DataFrame:
    html = F.col(f"`{html_col}`").cast("string").alias("html")
    pages = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"), html)
    pages = pages.withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    # the page of least id (ids before nulls), with its URL for the record id
    known = pages.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
    firsts = known.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = materialize(firsts.select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")), "first_pages")
    later = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    eligible = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    jobs = pages.join(firsts, "digest", "left").withColumn("revisit", F.coalesce(eligible & F.col("first_url").isNotNull() & later, F.lit(False)))
    jobs = jobs.select("page_id", "url", "digest", "html", "first_id", "first_url", "revisit")

    # sizes along the sorted records: within ranges first, then what is before each range
    order = ["page_id", "url", "digest"]
    sizes = materialize(jobs.mapInArrow(_members(date, level, False), MEMBER_SQL).select(*order, "size"), "sizes")
    light = materialize(sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sorted_sizes")
    totals = light.groupBy("part").agg(F.sum("size").alias("bytes"))
    base = totals.select("part", F.coalesce(F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    placed = light.withColumn("within", F.coalesce(within, F.lit(0))).join(F.broadcast(base), "part")
    placed = placed.select(*order, F.floor((F.col("base") + F.col("within")) / F.lit(file_bytes)).cast("long").alias("file"))
    # one row per file: the first record of each
    starts = placed.groupBy("file").agg(F.min(F.struct(F.col("page_id").isNotNull().alias("known"), *order)).alias("first")).orderBy("file").collect()
    edges = [(r["first"]["known"], r["first"]["page_id"] or 0, r["first"]["url"], r["first"]["digest"]) for r in starts]
    # a file that a large record has run past has no record of its own
    names = [r["file"] for r in starts]

    def file_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in order], strict=True)
            nth = [bisect_right(edges, (p is not None, p or 0, u, d)) - 1 for p, u, d in keys]
            yield pa.RecordBatch.from_arrays([pa.array(nth, pa.int32()), pa.array([names[k] for k in nth], pa.int64()), *[batch.column(c) for c in (*order, "member")]], names=["nth", "file", *order, "member"])

    members = jobs.mapInArrow(_members(date, level), MEMBER_SQL).select(*order, "member")
    filed = members.mapInArrow(file_of, "nth int, file long, page_id long, url string, digest string, member binary")
    sorted_ = filed.repartitionById(max(1, len(names)), F.col("nth")).sortWithinPartitions("file", *order)
    return commit(sorted_.select("file", "member").mapInArrow(_written(folder, prefix), MANIFEST_SQL), folder)


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the files in ``manifest``, its digests checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file"]
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with read_file(folder, name) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for head, block in read_records(io.BufferedReader(stream)):
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if sha1_base32(payload) != digest or len(payload) != int(head["X-Payload-Length"]):
                                raise ValueError(f"payload digest of {head['WARC-Record-ID']}")
                        page, refers = head["X-Page-ID"], head.get("X-Refers-To-Page-ID")
                        rows.append((int(page) if page else None, int(head["X-Payload-Length"]), digest, head["WARC-Type"], int(refers) if refers else None, head["WARC-Target-URI"], name))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), fields, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), fields, strict=True)], names=names)

    return one_task_each(manifest).mapInArrow(read, RECORD_SQL)


def roundtrip(pages: DataFrame, file_bytes: int = FILE_BYTES, **options) -> DataFrame:
    """Write ``pages`` to a new shared folder and read the archives back."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, file_bytes=file_bytes, **options), folder)
