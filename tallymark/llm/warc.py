"""A content-addressed WARC archive.

Payload bytes are stored once each under a SHA-256 digest; the exact record headers are stored
apart. Whole records come back by joining the two, and every payload that is read is digested
again and compared with the name it is stored under.

Of records with equal payloads, those with the smallest id are ``response`` records, all others
``revisit`` records that refer to it. Payloads below ``min_bytes`` are never revisited.

Defined cases: a null payload is the empty payload; a null URL is an empty one; a null id counts as
larger than any other, so it refers to a known id if there is one; repeated rows are records of
their own (of the smallest id, all are responses, and the payload is still stored once); line
breaks in a URL are percent-encoded, as they would end the header. An empty table gives an empty
archive. Further columns of the input are not archived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.plans.lineage import settle

# WARC 1.1 record syntax and its revisit profile.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"

DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits of hex at a time, read as base 32 and re-lettered."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    parts = [
        F.lpad(F.conv(F.substring(F.sha1(payload), at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*parts), digits, BASE32)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def records(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int = 0) -> DataFrame:
    """One row per page: id, url, digests, length, record type and the id referred to.

    Only digests and ids are grouped; a digest that many rows share is reduced to its smallest id
    in each task first.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.sha2(payload, 256).alias("digest"), base32_sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("length"),
    )
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    repeat = ~F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("length") >= min_bytes)
    return rows.join(first, "digest").select(
        *rows.columns, F.when(repeat, "revisit").otherwise("response").alias("kind"),
        F.when(repeat, F.col("first_id")).alias("refers_to"), "first_id",
    )


def _headers(rows: DataFrame, date: str) -> DataFrame:
    """The exact WARC header and HTTP header of each record."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("length").cast("string"), F.lit(CRLF + CRLF),
    )
    revisit = F.col("kind") == "revisit"
    size = F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("length"))
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    warc = F.concat(
        F.lit(f"{VERSION}{CRLF}WARC-Type: "), F.col("kind"),
        F.lit(f"{CRLF}WARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), target,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(
            F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), _record_id(F.col("refers_to")),
        )).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        size.cast("string"), F.lit(CRLF + CRLF),
    )
    return rows.withColumn("http", http).select(
        "page_id", "digest", (~revisit).alias("has_payload"),
        F.encode(warc, "utf-8").alias("warc_header"), F.encode(F.col("http"), "utf-8").alias("http_header"),
    )


def write_archive(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0, date: str = DATE,
) -> None:
    """Write ``headers`` (one row per record) and ``payloads`` (one row per digest) below ``folder``.

    The stored copy of a payload is that of the smallest id. The rows not to be stored, and the ones
    that are there several times, are listed first (ids and digests only); the planner then
    broadcasts that list if it is small, so that payloads are not shuffled, and else joins by (id, digest),
    which no group of copies makes hot.
    """
    rows = records(pages, page_id, url, html, min_bytes)
    _headers(rows, date).write.parquet(f"{folder}/headers")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    known = [F.coalesce("page_id", F.lit(0)).alias("_known"), F.col("page_id").isNull().alias("_null")]
    keys = ["_known", "_null", "digest"]
    bodies = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.sha2(payload, 256).alias("digest"), payload.alias("payload")
    ).select(*known, "digest", "payload")
    per_row = rows.groupBy("digest", "page_id").agg(F.count(F.lit(1)).alias("n"), F.min("first_id").alias("first_id"))
    stays = F.col("page_id").eqNullSafe(F.col("first_id"))
    listed = settle(per_row.where(~stays | (F.col("n") > 1)).select(*known, "digest", stays.alias("stays")), "unstored")
    one = F.row_number().over(Window.partitionBy(*keys).orderBy("digest")) == 1
    several = bodies.join(listed.where("stays"), keys, "left_semi").withColumn("_one", one).where("_one")
    kept = bodies.join(listed, keys, "left_anti").unionByName(several.drop("_one"))
    kept.select("digest", "payload").write.parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: id, headers, payload (null for revisits), ``record``, the whole
    bytes with the closing line breaks, and for revisits digest and length of the payload they refer to
    (``stored_sha1``, ``stored_bytes``). Fails on a payload that does not have its digest, and on a
    record whose payload is not stored.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    stored = spark.read.parquet(f"{folder}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload is not what its digest says: "), F.col("digest"))).cast("binary")
    )
    payloads = stored.select(F.col("digest").alias("_digest"), sound.alias("payload"))
    lost = F.raise_error(F.concat(F.lit("no payload stored for "), F.col("digest")))
    responses = headers.where("has_payload").join(payloads, F.col("digest") == F.col("_digest"), "left").withColumn(
        "_body", F.coalesce("payload", lost.cast("binary"))
    ).withColumns({"stored_sha1": F.lit(None).cast("string"), "stored_bytes": F.lit(None).cast("long")})
    # digest and length only, not the payload, go to each revisit
    facts = payloads.select("_digest", base32_sha1(F.col("payload")).alias("_sha1"), F.octet_length("payload").cast("long").alias("stored_bytes"))
    revisits = headers.where("not has_payload").join(facts, F.col("digest") == F.col("_digest"), "left").withColumns({
        "payload": F.lit(None).cast("binary"), "_body": F.lit(b""), "stored_sha1": F.coalesce("_sha1", lost.cast("string")),
    })
    return responses.unionByName(revisits.drop("_sha1")).select(
        "page_id", "digest", "warc_header", "http_header", "payload",
        F.concat("warc_header", "http_header", "_body", F.lit(b"\r\n\r\n")).alias("record"), "stored_sha1", "stored_bytes",
    )


def _field(header: Column, name: str) -> Column:
    return F.regexp_extract(header.cast("string"), rf"(?:^|\r\n){name}: ([^\r]*)\r\n", 1)


def describe(read: DataFrame) -> DataFrame:
    """What the headers of read records say, checked against the rebuilt record and its payload, or the payload a
    revisit refers to.
    """
    warc, http = F.col("warc_header"), F.col("http_header")
    said = F.substring(_field(warc, "WARC-Payload-Digest"), 6, 32)
    size = _field(http, "Content-Length").cast("long")
    body = F.octet_length("record") - F.octet_length("warc_header") - F.octet_length("http_header") - 4
    true = F.when(
        _field(warc, "WARC-Type") == "revisit", (F.col("stored_sha1") == said) & (F.col("stored_bytes") == size) & (body == 0)
    ).otherwise((base32_sha1(F.col("payload")) == said) & (body == size))
    refers = F.regexp_extract(warc.cast("string"), r"\r\nWARC-Refers-To: <urn:page:(-?\d+)>\r\n", 1)
    return read.select(
        "page_id", size.alias("payload_bytes"),
        F.when(true, said).otherwise(F.raise_error(F.lit("header and payload differ"))).alias("payload_digest"),
        _field(warc, "WARC-Type").alias("record_type"),
        F.when(refers != "", refers).cast("long").alias("refers_to"),
        F.octet_length("record").cast("long").alias("record_bytes"),
    )


def export_warc(read: DataFrame, folder: str, compression: str | None = "gzip") -> None:
    """Write read records as plain WARC files. Payloads must be UTF-8, as the archive's are."""
    rows = read.select(F.decode(F.substring(F.col("record"), F.lit(1), F.octet_length("record") - 4), "utf-8").alias("value"))
    writer = rows.write.option("lineSep", "\r\n\r\n")
    (writer.option("compression", compression) if compression else writer).text(folder)
