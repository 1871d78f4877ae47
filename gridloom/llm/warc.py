"""WARC archives: writing records in segments, and reading them back whole.

Spark's text sink writes the files (any file system that Spark knows, gzip), one record per line
separator that is the last byte of a record.  A block longer than ``segment_bytes`` becomes a first
record and continuation records.  Reading parses the files by their content lengths, groups segments
by origin identifier, orders them by number, verifies the total length and takes the chunked transfer
framing off the payload.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import small_batches

SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 16 << 10
RECORDS_PER_FILE = 1000
REVISIT_BYTES = 1000
_DATE = "2000-01-01T00:00:00Z"


def plan_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type and refers_to of each page.

    Of pages with equal payloads of at least ``least`` bytes the one with the largest page_id (every
    row with it, if repeated) is a response and the rest revisit it; a null page_id is below all
    others.  A null html is an empty payload; rows of a group with null ids only are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha1("payload"))
    groups = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    again = F.col("_keeper").isNotNull() & ~F.col("_keeper").eqNullSafe(F.col("page_id"))
    joined = rows.join(groups, rows["payload_digest"] == groups["_digest"], "left")
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_keeper")).alias("refers_to"),
    )


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing."""
    parts = []
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The body of a chunked framing; extensions and trailers are dropped, a cut framing is an error."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if at + size > len(framed):
            raise ValueError("a chunk is cut short")
        parts.append(framed[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None] + [f"Content-Length: {len(block)}"]
    return b"".join([b"WARC/1.1\r\n", "\r\n".join(lines).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


def _records_of(row: tuple, segment_bytes: int) -> Iterator[bytes]:
    page_id, url, payload, size, digest, kind, refers_to, number = row
    page = "null" if pd.isna(page_id) else int(page_id)
    name = f"<urn:page:{page}:{number}>"
    target = None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]|")
    common = [
        ("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", _DATE), ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Refers-To", None if pd.isna(refers_to) else f"<urn:page:{int(refers_to)}>"),
    ]
    if kind == "revisit":
        yield _record(common, b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % size)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload.encode("utf-8", "surrogatepass"))
    if len(block) <= segment_bytes:
        yield _record(common, block)
        return
    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _record([*common, ("WARC-Segment-Number", 1)], pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        total = len(block) if n == len(pieces) else None
        yield _record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{page}:{number}:{n}>"), ("WARC-Date", _DATE), ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total),
        ], piece)


def write_archives(planned: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write :func:`plan_records` rows as .gz archives of ``records_per_file`` records at most."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for row in batch.itertuples(index=False, name=None):
                for record in _records_of(row, segment_bytes):
                    out.append(record[:-1])  # the sink's line separator is the last byte
                    held += len(record)
                if held > 8 << 20:
                    yield pd.DataFrame({"record": out})
                    out, held = [], 0
            yield pd.DataFrame({"record": out}, dtype=object)

    rows = planned.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", F.monotonically_increasing_id().alias("number"))
    (
        small_batches(rows).mapInPandas(build, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive's bytes."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
        start = end + 4
        stop = start + int(headers["content-length"])
        if stop > len(content):
            raise ValueError("a record is cut short")
        yield headers, content[start:stop]
        at = stop + 4


_RECORD_SCHEMA = "record_id string, kind string, target string, digest string, refers_to string, number int, origin string, total long, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in a folder, segments apart; none of an empty folder.  A record that is
    written twice is there twice."""

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for h, block in parse(gzip.decompress(content)):
                    number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
                    rows.append((h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h.get("warc-payload-digest"), h.get("warc-refers-to"), number and int(number), h.get("warc-segment-origin-id"), total and int(total), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield pd.DataFrame(rows, columns=names).astype({"number": "Int32", "total": "Int64"})
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=names).astype({"number": "Int32", "total": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInPandas(parsed, _RECORD_SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: segments of an origin in order of their numbers, as one block.

    ``complete`` is false (and ``block`` null) where a number is missing or the blocks' lengths do not
    add up to the total length.  A segment that stands twice counts once; a record
    without segments that stands twice stays twice.  No records give none; other columns are dropped.
    """
    whole = records.where(F.col("number").isNull()).select("record_id", "kind", "target", "digest", "refers_to", "block", F.lit(True).alias("complete"))
    first = F.col("number") == 1
    pieces = records.where(F.col("number").isNotNull()).groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "target", "digest", "refers_to")],
        F.max("total").alias("total"),
        F.sort_array(F.collect_set(F.struct("number", "block"))).alias("pieces"),
    )
    numbers = F.transform("pieces", lambda p: p["number"])
    lengths = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"]))
    complete = (numbers == F.expr("sequence(1, size(pieces))")) & (lengths == F.col("total"))

    @F.pandas_udf(T.BinaryType())
    def joined(blocks: pd.Series) -> pd.Series:
        return blocks.map(lambda b: b"".join(b))

    pieces = pieces.withColumn("complete", F.coalesce(complete, F.lit(False)))
    block = F.when(F.col("complete"), joined(F.transform("pieces", lambda p: p["block"])))
    return whole.unionByName(pieces.select("record_id", "kind", "target", "digest", "refers_to", block.alias("block"), "complete"))


def with_payload(records: DataFrame) -> DataFrame:
    """Add ``payload`` (decoded; null for revisits and incomplete records) and ``stated_bytes``,
    the length that a revisit states.  Repeated records are alike, no records give none; columns of the two
    names are replaced, others stay."""

    @F.pandas_udf(T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("stated_bytes", T.LongType())]))
    def decoded(kinds: pd.Series, blocks: pd.Series) -> pd.DataFrame:
        out = []
        for kind, block in zip(kinds, blocks, strict=True):
            if block is None:
                out.append((None, None))
                continue
            head, _, body = block.partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
            if kind == "revisit":
                out.append((None, int(fields.get(b"content-length", b"0"))))
            else:
                out.append((unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body, None))
        return pd.DataFrame(out, columns=["payload", "stated_bytes"]).astype({"stated_bytes": "Int64"})

    return records.drop("payload", "stated_bytes").withColumn("_http", decoded("kind", "block")).select("*", "_http.payload", "_http.stated_bytes").drop("_http", "block")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Whole records of a folder: record_id, page_id, kind, target, digest, refers_to (a page_id),
    complete, payload, stated_bytes.  An empty folder has none; what stands twice is treated as in
    :func:`reassemble`; an identifier without a page's number has a null page_id."""
    records = with_payload(reassemble(read_records(spark, path)))
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)', 1) AS BIGINT)")
    return records.withColumn("page_id", number("record_id")).withColumn("refers_to", number("refers_to")).withColumn("digest", F.regexp_replace("digest", "^sha1:", ""))
