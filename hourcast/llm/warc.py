"""Content-addressed WARC archive.

``write_archive`` stores each distinct payload once, under its SHA-256, and the
exact header bytes of every record (WARC and HTTP header) on their own.  Of the
records with equal payloads of at least ``min_bytes`` bytes, the one with the
largest id is the response and the others are revisits of it; smaller payloads
are stored once too, but all their records are responses.  ``read_archive``
joins headers with payloads, recomputes the digest of every payload it reads
and fails on a mismatch, and gives back each record's bytes.

Only ids and digests are grouped; a payload with a third of all records is one
stored row, and the join that gives it back to its records is one that adaptive
execution can split.

Defined results: a null payload is empty.  Records with a null id never win
over others; repeated rows of the largest id are all responses.  A null URL has
no target line; line breaks in a URL are percent-escaped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_root, materialise

BROADCAST_IDS = 1 << 20
# The digits of base 32 as ``conv`` writes them, and as RFC 4648 does.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base 32 of the SHA-1: each 5 hex digits are 4 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), _CONV_DIGITS, _RFC_DIGITS)


def record_name(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), F.coalesce(record_id.cast("string"), F.lit("none")), F.lit(">"))


def headers(date: str) -> Column:
    """Header bytes of a record, over record_id, url, size, sha1, refers_to."""
    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))

    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(_CRLF * 2))
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    head = F.concat(
        F.lit("WARC/1.1" + _CRLF), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_name(F.col("record_id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, line("WARC-Refers-To", record_name(F.col("refers_to")))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))
        .otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "), block.cast("string"), F.lit(_CRLF * 2))
    return F.encode(F.concat(head, http), "UTF-8")


def write_archive(records: DataFrame, path: str | None = None, min_bytes: int = 0,
                  date: str = "1970-01-01T00:00:00Z") -> str:
    """Write records (record_id long, url string, payload binary) as ``headers``
    and ``payloads`` under ``path`` (default: the shared checkpoint folder)."""
    spark = records.sparkSession
    path = path or f"{checkpoint_root(spark)}/hourcast-llm/{spark.sparkContext.applicationId}/archive-{uuid.uuid4().hex}"
    payload = F.coalesce("payload", F.lit(b""))
    r = records.select("record_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    meta = r.select("record_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"),
                    base32_sha1(F.col("payload")).alias("sha1"))
    meta = materialise(meta, "warc-records")
    first = meta.groupBy("digest").agg(F.max("record_id").alias("keeper"), F.count("*").alias("n"))
    shared = materialise(first.filter("n > 1").drop("n"), "warc-shared")
    m = meta.join(shared, "digest", "left")
    other = F.col("keeper").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("keeper")) & (F.col("size") >= min_bytes)
    m = m.withColumn("refers_to", F.when(other, F.col("keeper")))
    m = m.select("record_id", "digest", "sha1", "size", headers(date).alias("header"))
    m.write.option("compression", "zstd").parquet(f"{path}/headers")
    # Payloads: all rows but those whose payload another row stores.
    spare = meta.join(shared, "digest").filter(~F.col("record_id").eqNullSafe(F.col("keeper")) | F.col("record_id").isNull())
    spare = materialise(spare.select(F.col("record_id").alias("_id"), F.col("digest").alias("_dg")), "warc-spare")
    counts = spare.agg(F.count("*").alias("n"), F.count("_id").alias("ids")).first()
    repeated = meta.join(shared, "digest").filter("record_id = keeper").groupBy("digest").count().filter("count > 1").limit(1).count()
    body = r.select("record_id", "digest", "payload")
    if counts["n"]:
        side = F.broadcast(spare) if counts["n"] <= BROADCAST_IDS else spare
        body = body.join(side, F.col("record_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_dg")), "left_anti")
    body = body.select("digest", "payload")
    if repeated or counts["n"] != counts["ids"]:  # repeated rows or null ids share payloads: one of them stores it
        body = r.select("digest", "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
    body.write.option("compression", "zstd").parquet(f"{path}/payloads")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: record_id, header, payload (verified), record."""
    store = spark.read.parquet(f"{path}/payloads")
    good = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    store = store.withColumn("payload", F.when(good, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.hex("digest")))))
    h = spark.read.parquet(f"{path}/headers")
    out = h.join(store, "digest", "left")
    found = F.coalesce("payload", F.raise_error(F.concat(F.lit("no payload for digest "), F.hex("digest"))).cast("binary"))
    out = out.withColumn("payload", found)
    end = F.lit((_CRLF * 2).encode())
    revisit = F.decode("header", "UTF-8").contains(f"{_CRLF}WARC-Type: revisit{_CRLF}")
    record = F.when(revisit, F.concat("header", end)).otherwise(F.concat("header", "payload", end))
    return out.select("record_id", "header", "payload", record.alias("record"))


def parsed(records: DataFrame) -> DataFrame:
    """Fields of the records, read from their bytes: record_id, payload_bytes,
    payload_digest, record_type, refers_to.  A record's header lines end at its first empty
    line, the HTTP header at the next; a response's payload is what stands between that and the
    record's closing line breaks, and a revisit's is the one its digest names."""
    text, gap = F.decode("record", "ISO-8859-1"), F.lit(_CRLF * 2)  # a character per byte
    r = records.select("record_id", "record", "payload", text.alias("_t")).withColumn("_a", F.locate(_CRLF * 2, F.col("_t")))
    r = r.withColumn("_b", F.call_function("locate", gap, F.col("_t"), F.col("_a") + 4))
    # Each line with the break before it: names stand at the beginning of a line.
    head = F.concat(F.lit(_CRLF), F.substring(F.col("_t"), F.lit(1), F.col("_a") + 1))
    r = r.select("record_id", "payload", head.alias("_h"),
                 F.substring(F.col("record"), F.col("_b") + 4, F.octet_length("record") - F.col("_b") - 7).alias("_body"))
    kind = F.regexp_extract("_h", r"\r\nWARC-Type: ([a-z]+)\r\n", 1)
    refers = F.regexp_extract("_h", r"\r\nWARC-Refers-To: <urn:x-record:(-?[0-9]+)>\r\n", 1)
    r = r.select("record_id", kind.alias("record_type"), F.when((kind == "revisit") & (refers != ""), refers.cast("long")).alias("refers_to"),
                 F.when(kind == "revisit", F.col("payload")).otherwise(F.col("_body")).alias("_p"))
    return r.select("record_id", F.octet_length("_p").cast("long").alias("payload_bytes"), base32_sha1(F.col("_p")).alias("payload_digest"),
                    "record_type", "refers_to")
