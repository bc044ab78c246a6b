"""Web archives: equal payloads are stored once, and later captures revisit them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewise.session import checkpointed, scratch_path

#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
_BETWEEN = f"\r\n\r\n{VERSION}\r\n"
#: Revisits that are sent to every task; more are joined by page.
BROADCAST_ROWS = 100_000
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: five hex digits are four base32 digits."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(
        F.md5(F.concat_ws(" ", page.cast("string"), digest)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def resolved(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """`pages` (page_id, url, html) with the columns payload, digest, original: the smallest page_id of those with
    an equal payload for records that revisit it, null for responses.

    Only headers (page_id, digest, length) are shuffled, and counted per digest before they are; the list of
    revisits then goes to the pages, to every task if it has BROADCAST_ROWS at most.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("bigint")})
    headers = rows.filter(F.col("size") >= min_bytes).select("page_id", "digest", "size")
    first = headers.groupBy("digest", "size").agg(F.min("page_id").alias("original"))
    revisits = headers.join(first, ["digest", "size"]).filter(F.col("page_id") > F.col("original")) \
        .select("page_id", "digest", "original").distinct()
    revisits = checkpointed(revisits, "revisits")
    few = revisits.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(revisits) if few else revisits, ["page_id", "digest"], "left")


def records(pages: DataFrame, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """(record): a WARC record per page, with fresh headers. Control characters in a URL are percent-encoded."""
    page = resolved(pages, min_bytes)
    is_revisit = F.col("original").isNotNull()
    url = F.coalesce("url", F.lit(""))
    for code in (*range(32), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    lines = lambda *parts: F.concat_ws("\r\n", *parts)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)

    def record(body: Column, *more: Column) -> Column:
        body = F.when(is_revisit, "").otherwise(body)
        http = lines(F.lit(HTTP_HEAD), line("Content-Length", F.octet_length(body).cast("string")))
        block = F.concat(http, F.lit("\r\n\r\n"), body)
        return F.concat(lines(
            F.lit(VERSION),
            line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
            line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
            line("WARC-Date", F.lit(date)),
            line("WARC-Target-URI", url),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            F.when(is_revisit, line("WARC-Refers-To", _record_id(F.col("original"), F.col("digest")))),
            F.when(is_revisit, line("WARC-Profile", F.lit(PROFILE))),
            line("X-Page-ID", F.col("page_id").cast("string")),
            *more,
            F.lit("Content-Type: application/http; msgtype=response"),
            line("Content-Length", F.octet_length(block).cast("string"))), F.lit("\r\n\r\n"), block)

    plain = page.withColumn("record", record(F.col("payload")))
    coded = record(F.base64(F.col("payload").cast("binary")), F.lit("X-Payload-Encoding: base64"))
    # the line separator that is written after a record may complete what stands at its end
    unsafe = F.instr(F.concat("record", F.lit("\r\n\r\n")), _BETWEEN) > 0
    return plain.select(F.when(unsafe, coded).otherwise(F.col("record")).alias("record"))


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = DATE) -> None:
    """Archives under `path`, a file per task. A payload that holds what separates records is stored in base64."""
    records(pages, min_bytes, date).write.option("lineSep", "\r\n\r\n").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record under `path`: page_id, url, record_id, record_type, digest, refers (a record id), payload
    (binary; empty for revisits), intact (a response's payload has the digest and its block the length that the
    headers state).

    Large files are split between records. A payload of another writer that holds the line that begins a record,
    after an empty line, is not intact, and neither is what follows in it.
    """
    whole = spark.read.option("lineSep", _BETWEEN).text(path).select(
        F.regexp_replace("value", f"^{VERSION}\r\n", "").alias("value")).filter("value != ''")
    head = whole.select("value", F.concat(F.substring_index("value", "\r\n\r\n", 1), F.lit("\r\n")).alias("head"))
    field = lambda name: F.nullif(F.regexp_extract("head", f"(?m)^{name}: ?([^\r\n]*)", 1), F.lit(""))
    rows = head.select(
        field("X-Page-ID").cast("bigint").alias("page_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        field("WARC-Refers-To").alias("refers"), field("X-Payload-Encoding").alias("coding"),
        field("Content-Length").cast("int").alias("n"),
        F.expr("substring(value, length(head) + 3)").alias("block"))
    rows = rows.withColumn("http", F.substring_index("block", "\r\n\r\n", 1))
    body = F.expr("substring(cast(substring(block, length(http) + 5) AS binary), 1, n - octet_length(http) - 4)")
    rows = rows.withColumn("body", body)
    rows = rows.withColumn("payload", F.when(F.col("coding") == "base64", F.unbase64(F.col("body").cast("string"))).otherwise(F.col("body")))
    whole_block = F.octet_length("block") >= F.col("n")
    return rows.select(
        "page_id", "url", "record_id", "record_type", "digest", "refers", "payload",
        (whole_block & ((F.col("record_type") == "revisit") | (base32_sha1(F.col("payload")) == F.col("digest")))).alias("intact"))


def captures(archive: DataFrame) -> DataFrame:
    """Per record of `read`: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's
    page_id). Revisits get the figures of the response that they refer to, by its header alone."""
    rows = archive.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "payload_digest": base32_sha1(F.col("payload"))})
    rows = rows.select("page_id", "record_id", "record_type", "refers", "payload_bytes", "payload_digest")
    own = F.col("record_type") == "response"
    responses = checkpointed(rows.filter(own).select(
        F.col("record_id").alias("response"), F.col("page_id").alias("to"), F.col("payload_bytes").alias("bytes"),
        F.col("payload_digest").alias("of")).distinct(), "responses")
    # a response meets itself, so no key but a much revisited response's is frequent, and Spark can split that
    found = rows.withColumn("response", F.when(own, F.col("record_id")).otherwise(F.col("refers"))).join(responses, "response", "left")
    return found.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("of").alias("payload_digest"), "record_type",
        F.when(~own, F.col("to")).alias("refers_to"))


def archived(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes `pages` to new archives in the shared folder and gives the captures that they hold.

    Per row: page_id, payload_bytes, payload_digest, record_type, refers_to. Null html is an empty payload. Of equal
    payloads of `min_bytes` at least, rows with the smallest page_id are responses and others revisits; rows without
    a page_id, and smaller payloads, are responses. An empty table gives no rows.
    """
    path = scratch_path(spark, "archive")
    write(pages, path, min_bytes)
    return captures(read(spark, path))
