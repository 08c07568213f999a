"""WARC: pages to archives with segmented records, and back, with continuation records put together."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splicedf.llm import warc_records
from splicedf.llm.common import maybe_broadcast, written

#: Bytes of records in a file, by mean; payloads from which equal ones are revisits.
FILE_BYTES, REVISIT_BYTES = 16 << 20, 1000
DATE = "2020-01-01T00:00:00Z"
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, whole boolean"


def page_bytes(batches):
    """mapInArrow: (page_id, url, html, refers_to) to records."""
    for batch in batches:
        out = []
        for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            out += warc_records.page_records(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to, DATE)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = REVISIT_BYTES) -> None:
    """Archives (gzip) of a record a page, longer ones in segments, through Spark's own writer and commit.

    Of equal payloads of min_bytes at least, the largest page_id is the response; rows that repeat that id are responses
    too. Null html is an empty payload; a null page_id refers to its response, or is one if no equal payload has an id.
    What is joined back is one row for each payload that occurs more than once. Pages are not shuffled if that is few.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    p = p.withColumns({"_sha": F.sha1(F.coalesce("html", F.lit("")).cast("binary")), "_n": F.coalesce(F.octet_length("html"), F.lit(0))})
    rows, total = p.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    equal = p.filter(F.col("_n") >= min_bytes).groupBy("_sha", "_n").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("c")).filter("c > 1").select("_sha", "_n", "_last")
    p = p.join(maybe_broadcast(written(equal, "equal-payloads")), ["_sha", "_n"], "left")
    refers = F.when(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    out = p.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(page_bytes, "value binary")
    each = max(1, int(FILE_BYTES / max(1, total / max(1, rows) + 600)))
    out.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", each).text(path)


def number(headers: dict[str, str], name: str) -> int | None:
    return int(headers[name]) if name in headers else None


def described(headers: dict[str, str], block: bytes) -> tuple:
    """A row of PAGE. Lengths and digests of responses are those of what was decoded; whole says if the header agrees."""
    said = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    page = number(headers, "warc-page-id")
    if headers["warc-type"] == "revisit":
        return page, number(headers, "warc-payload-length"), said, "revisit", number(headers, "warc-refers-to-page-id"), True
    try:
        payload = warc_records.payload_of(block)
    except ValueError:
        return page, None, None, headers["warc-type"], None, False
    digest = hashlib.sha1(payload).hexdigest()
    return page, len(payload), digest, headers["warc-type"], None, said in ("", digest)


def table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [x.split()[0] for x in PAGE.split(", ")])


def whole_records(batches):
    """mapInArrow: (content) to a row of PAGE for every record that has no segments."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            yield table([described(h, b) for h, b in warc_records.records(data) if "warc-segment-number" not in h])


def segments(batches):
    """mapInArrow: (content) to (origin, segment, total, headers, block) of the records that are segments."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            rows = [(h.get("warc-segment-origin-id", h["warc-record-id"]), int(h["warc-segment-number"]), number(h, "warc-segment-total-length"), [*h.items()] if h["warc-segment-number"] == "1" else None, b) for h, b in warc_records.records(data) if "warc-segment-number" in h]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()))], ["origin", "segment", "total", "headers", "block"])


def joined_pages(batches):
    """mapInArrow: (headers, blocks in order) to rows of PAGE; blocks is null if a segment is missing or lengths differ."""
    for batch in batches:
        rows = []
        for headers, blocks in zip(*(c.to_pylist() for c in batch.columns)):
            h = dict(headers or {"warc-type": "continuation"})
            rows.append(described(h, b"".join(blocks)) if blocks is not None else (number(h, "warc-page-id"), None, None, h["warc-type"], None, False))
        yield table(rows)


def reassembled(parts: DataFrame) -> DataFrame:
    """(headers, blocks) of each origin, as often as its first segment occurs.

    A group is one record, so as long as a page is. Segments that repeat count once; blocks are null unless the numbers
    run from 1 without a gap and the lengths add up to the total that the last one states.
    """
    own = parts.groupBy("origin", "segment").agg(F.first("block").alias("block"), F.max("total").alias("total"), F.any_value("headers", True).alias("headers"), F.count(F.lit(1)).alias("n"))
    g = own.groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("s"), F.max("total").alias("total"), F.any_value("headers", True).alias("headers"), F.max(F.when(F.col("segment") == 1, F.col("n"))).alias("n"), F.sum(F.octet_length("block")).alias("bytes"), F.max("segment").alias("last"))
    good = (F.size("s") == F.col("last")) & F.col("headers").isNotNull() & (F.col("bytes") == F.col("total"))
    return g.select("headers", F.when(good, F.transform("s", lambda x: x.block)).alias("blocks"), F.explode_outer(F.sequence(F.lit(1).cast("long"), F.coalesce("n", F.lit(1)).cast("long"))).alias("_i")).drop("_i")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row of PAGE for every page of the archives. Only segments are shuffled, by their origin."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("content")
    parts = files.mapInArrow(segments, "origin string, segment long, total long, headers map<string, string>, block binary")
    return files.mapInArrow(whole_records, PAGE).unionAll(reassembled(parts).mapInArrow(joined_pages, PAGE))
