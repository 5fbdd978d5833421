"""WARC archives: writing with chunked framing and segments, reading back with segment reassembly."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm.session import bound_arrow_batches, fresh_path, materialise

SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 8 << 10
REVISIT_BYTES = 1000
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id bigint, warc_type string, refers_to bigint, digest string, length bigint, origin string, segment int, total bigint, block binary"


def header(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None) + b"\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    """The payload of a chunked body; a broken frame raises ValueError."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        out.append(body[at : at + size])
        at += size + 2
        if len(out[-1]) != size or body[at - 2 : at] != b"\r\n":
            raise ValueError("broken chunk")


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, name: str, segment_bytes: int) -> Iterator[bytes]:
    """The WARC records of one page, without the two line ends that follow each record."""
    target = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        yield header([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("Content-Length", len(block))]) + block
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= segment_bytes:
        yield header([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, ("Content-Length", len(block))]) + block
        return
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    for k, part in enumerate(parts, 1):
        first = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common] if k == 1 else [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Date", DATE)]
        total = len(block) if k == len(parts) else None
        yield header([*first, ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total), ("Content-Length", len(part))]) + part


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as gzipped WARC files under ``path``.

    Of rows with equal payloads of at least 1000 bytes those with the largest page_id are responses, all others revisit
    it; a null html is an empty payload, a null page_id counts as the smallest. Equal payloads are found by SHA-1 and
    length in narrow rows; groups of two or more are the only ones joined back, in a join that AQE can split.
    Each task writes its own rows: Spark's text writer ends every record with the two line ends that WARC asks for.
    """
    bound_arrow_batches(pages.sparkSession)
    payload = F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")
    own = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("length", F.octet_length("payload"))
    groups = own.filter(F.col("length") >= REVISIT_BYTES).groupBy(F.col("digest").alias("same"), F.col("length").alias("same_length")).agg(F.max("page_id").alias("kept_id"), F.count("*").alias("n"))
    groups = materialise(groups.filter("n > 1 and kept_id is not null").drop("n"), "warc-groups")
    marked = own.join(groups, (own["digest"] == groups["same"]) & (own["length"] == groups["same_length"]), "left")
    refers = F.when(F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id")), F.col("kept_id"))
    marked = marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page_id, url, body, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                n += 1  # a page that occurs twice still has a record name of its own
                out += records(page_id, url, body, digest, refers_to, f"urn:page:{'' if page_id is None else page_id}:{part}-{n}", segment_bytes)
            yield pa.record_batch([pa.array(out, pa.binary())], names=["record"])

    built = marked.mapInArrow(build, "record binary")
    built.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


def parse(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record; ``stream`` gives the archive split at blank lines."""
    held = bytearray()
    for piece in stream:
        held += piece
        held += END
        while True:
            at = 0
            while held[at : at + 1] in (b"\r", b"\n"):
                at += 1
            del held[:at]
            end = held.find(END)
            if end < 0:
                break
            if not held.startswith(b"WARC/"):
                raise ValueError("no WARC record where one should begin")
            lines = bytes(held[:end]).decode().split("\r\n")[1:]
            fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
            size = int(fields["content-length"])
            if len(held) < end + len(END) + size:
                break
            yield fields, bytes(held[end + len(END) : end + len(END) + size])
            del held[: end + len(END) + size]
    if held.strip(b"\r\n"):
        raise ValueError("the archive ends inside a record")


def page_of(name: str) -> int | None:
    page = name.strip("<>").split(":")[2]
    return int(page) if page else None


def scan(spark: SparkSession, path: str, segmented: bool) -> DataFrame:
    """The records of all archives that are (or aren't) part of a segmented record. A gzipped file is read by one task,
    in order and piece by piece, so memory holds one record at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        types = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}
        kinds = [types[x.split()[1]] for x in RECORD.split(", ")]
        rows: list[tuple] = []
        held = 0
        for fields, block in parse(x for b in batches for x in b.column(0).to_pylist()):
            number = fields.get("warc-segment-number")
            if (number is not None) != segmented:
                continue
            refers, digest, total = fields.get("warc-refers-to"), fields.get("warc-payload-digest"), fields.get("warc-segment-total-length")
            origin = fields.get("warc-segment-origin-id", fields["warc-record-id"])
            head = dict(x.lower().split(": ", 1) for x in block.partition(END)[0].decode().split("\r\n")[1:]) if fields["warc-type"] == "revisit" else {}
            length = int(head["content-length"]) if "content-length" in head else None
            rows.append((page_of(origin), fields["warc-type"], page_of(refers) if refers else None, digest and digest.removeprefix("sha1:"), length, origin, number and int(number), total and int(total), block))
            held += len(block)
            if held > 8 << 20:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    lines = spark.read.option("lineSep", END.decode()).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(read, RECORD)


def payload_column(blocks: Column) -> Column:
    """The payload of a response whose block comes in parts: HTTP head dropped, chunked framing decoded; null if broken."""

    @F.arrow_udf("binary")
    def payload(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for parts in batch.to_pylist():
                head, found, body = b"".join(parts or ()).partition(END)
                try:
                    out.append((dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body) if found else None)
                except ValueError:
                    out.append(None)
            yield pa.array(out, pa.binary())

    return payload(blocks)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page record under ``path``: page_id, record_type, refers_to, payload, payload_bytes, payload_digest, verified.

    Continuation records are grouped by origin and ordered by segment number; a record is verified if its segments run
    from 1 without a gap, add up to the stated total length, and the decoded payload has the stated digest. Segments of
    one page meet in one group, whole records don't move. A revisit has no payload; its bytes and digest are those
    its headers state. An empty folder of archives gives an empty table; text after the last record raises an error.
    """
    bound_arrow_batches(spark)
    whole = scan(spark, path, False).select("page_id", "warc_type", "refers_to", "digest", "length", F.array("block").alias("blocks"), F.lit(True).alias("complete"))
    parts = scan(spark, path, True).groupBy("origin").agg(
        F.first("page_id").alias("page_id"), F.max(F.when(F.col("segment") == 1, F.col("warc_type"))).alias("warc_type"), F.max("refers_to").alias("refers_to"), F.max("digest").alias("digest"), F.max("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("held"), F.max("total").alias("total"), F.sum(F.octet_length("block")).alias("size"),
    )
    in_order = F.col("held.segment") == F.sequence(F.lit(1), F.size("held"))
    joined = parts.select("page_id", "warc_type", "refers_to", "digest", "length", F.col("held.block").alias("blocks"), F.coalesce(in_order & (F.col("size") == F.col("total")), F.lit(False)).alias("complete"))
    every = whole.union(joined)
    revisit = F.col("warc_type") == "revisit"
    decoded = every.withColumn("payload", payload_column(F.when(~revisit, F.col("blocks"))))
    decoded = decoded.withColumn("payload", F.when(~revisit, F.col("payload")))
    own = F.sha1("payload")
    return decoded.select(
        "page_id", F.col("warc_type").alias("record_type"), "refers_to", "payload", F.when(revisit, F.col("length")).otherwise(F.octet_length("payload")).cast("long").alias("payload_bytes"),
        F.when(revisit, F.col("digest")).otherwise(own).alias("payload_digest"), (F.col("complete") & (revisit | F.coalesce(own == F.col("digest"), F.lit(False)))).alias("verified"),
    )


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment_bytes)
    return read_archives(pages.sparkSession, path)


SQL = """
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN octet_length(encode(h)) >= 1000 AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(h)) >= 1000 AND page_id < m THEN m END AS refers_to, true AS verified
FROM (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)
"""
