"""WARC archives with revisit resolution.

Headers alone are shuffled by payload digest, a frequent digest's in parts, to find each payload's first record; what is
to become a revisit is then joined to its page by page and digest, so that copies of one payload do not meet in one task,
and payloads are only shuffled where there are many revisits.
Records are strung together up to a number of bytes, and Spark's own text sink, whose line separator is the blank line
that ends a record, writes so many of these to a file. Reading parses whole records by their Content-Length.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_keys, read, salted_join, shared_dir, store

#: Payloads shorter than this are always written in full.
LEAST = 100
#: Revisits up to which they are broadcast (about 250 bytes each); beyond, they and the pages are dealt by page and digest.
BROADCAST_ROWS = 200_000
#: Bytes up to which records are strung together, and such strings, or single longer records, of one file: a file is read as
#: a whole, and stays below 2 GB while pages are below 250 MB.
STRING_BYTES, FILE_STRINGS = 1 << 24, 8
END = "\r\n\r\n"


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null; control characters in it are percent-encoded."""
    text = value.cast("string")
    for raw, safe in (("\r", "%0D"), ("\n", "%0A")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit("\r\n")), F.lit(""))


def _record_id(page: Column) -> Column:
    h = F.md5(F.concat(F.lit("record:"), page.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, n), F.lit("-"))][:-1], F.lit(">"))


def resolve_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_url of each row of ``pages``.

    Of rows with equal payloads of at least ``least`` bytes, that with the smallest page_id is the response and the
    others revisit it; shorter ones are all responses. A null html is an empty payload. A repeated row of the response's
    page is a response too, as its page_id is as small. A null page_id is never the smallest. Other columns are left out.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumns({
        "payload_digest": F.sha2(F.col("payload").cast("binary"), 256),
        "payload_bytes": F.octet_length("payload").cast("long"),
    })
    heads = base.where(F.col("payload_bytes") >= least).select("page_id", "url", "payload_digest")
    smallest = F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("_first")
    shared = heads.groupBy("payload_digest").agg(F.count("*").alias("_n"), smallest).where(F.col("_n") > 1)
    counts = shared.select("payload_digest", "_n")
    late = salted_join(heads, shared.select("payload_digest", "_first"), "payload_digest", hot_keys(counts, "payload_digest", heads.count()), ["page_id", "url"])
    late = late.where(F.col("_first.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first.page_id")))
    late = late.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_d"), F.col("_first.page_id").alias("refers_to"), F.col("_first.url").alias("refers_url")).distinct()
    late = store(late, "revisits")
    late = F.broadcast(late) if late.count() <= BROADCAST_ROWS else late
    revisit = F.col("refers_to").isNotNull()
    return base.join(late, base["page_id"].eqNullSafe(late["_id"]) & (base["payload_digest"] == late["_d"]), "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), "refers_to", "refers_url",
    )


def write_warc(resolved: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write each row of ``resolve_revisits`` as a WARC/1.1 record to a folder of archives at ``path``.

    A null page_id or url gives no such header, an empty table a folder without archives; repeated rows give repeated
    records.
    """
    full = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(full, F.concat(http, "payload")).otherwise(http)
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", _record_id(F.coalesce(F.col("page_id").cast("string"), F.lit("null")))),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _header("WARC-Profile", F.when(~full, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.when(~full, _record_id(F.col("refers_to")))),
        _header("WARC-Refers-To-Target-URI", F.when(~full, F.col("refers_url"))),
        _header("X-Page-Id", F.col("page_id")), _header("X-Refers-To-Page-Id", F.col("refers_to")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"), _header("Content-Length", F.octet_length(block)), F.lit("\r\n"),
    )

    def strung(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            for record in batch.column(0).to_pylist():
                held.append(record)
                size += len(record.encode())
                if size >= STRING_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([END.join(held)])], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.join(held)])], names=["value"])

    records = resolved.select(F.concat(head, block).alias("value")).mapInArrow(strung, "value string")
    records.write.option("lineSep", END).option("maxRecordsPerFile", FILE_STRINGS).text(path)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(headers["content-length"])
        yield headers, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at ``path``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, html.

    The digest of a response is taken anew from its payload; a revisit has those of the payload it stands for, and no
    html; its size is null where its block does not say it. Records of other kinds come with the size and digest of their
    block. page_id and refers_to are those of archives that ``write_warc`` wrote, else null. Bytes that are no UTF-8 are
    replaced in html, not in the digest. One archive file is held in memory at a time. A folder without archives gives an
    empty table.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"

    def parse(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for k in range(batch.num_rows):
                rows, held = [], 0
                for headers, block in parse_records(batch.column(0)[k].as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    number = {n: int(headers[n]) if headers.get(n, "").lstrip("-").isdigit() else None for n in ("x-page-id", "x-refers-to-page-id")}
                    kind = headers.get("warc-type", "unknown")
                    if kind == "revisit":
                        said = re.search(rb"(?i)^content-length:\s*(\d+)\s*$", http, re.M)
                        size, digest = int(said[1]) if said else None, headers.get("warc-payload-digest", "").partition(":")[2] or None
                    else:
                        payload = payload if kind == "response" else block
                        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                    text = payload.decode("utf-8", "replace") if kind == "response" else None
                    rows.append((number["x-page-id"], headers.get("warc-target-uri"), size, digest, kind, number["x-refers-to-page-id"], text))
                    held += len(payload)
                    if held > 1 << 23:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("length") > 0)
    return files.select("content").mapInArrow(parse, schema)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(resolve_revisits(read(spark, sf_dir, "pages")), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op6_warc": op6_warc}
ORACLE = {
    "op6_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f"""
}
