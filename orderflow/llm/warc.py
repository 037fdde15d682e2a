"""Content-addressed WARC archive.

An archive is two Parquet tables: ``payloads`` holds each distinct payload once under its SHA-256, and
``headers`` holds for each record its exact header bytes (WARC and HTTP part) and its payload's key.
``restore`` joins the two, checks every payload against its key and gives back the records as they
were; ``export_warc`` writes them as WARC files.

Of records with equal payloads of at least MIN_BYTES bytes, the one with the largest id is a response
and the others are revisits that refer to it; smaller payloads make responses only. Rows that repeat
the largest id are all responses. A null body is an empty payload. A null id is written as an empty
name and never chosen if there is another; a null URL is written as ``about:blank``, and blanks or
control characters in a URL are percent-encoded. Payloads of any length are handled whole. An empty table makes
an archive without records. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.llm.common import store

MIN_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"
CRLF = "\r\n"


def _name(id_column: Column) -> Column:
    return F.concat(F.lit(f"<{NAME}"), F.coalesce(id_column.cast("string"), F.lit("")), F.lit(">"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field whose value is null is left out."""
    lines = [
        F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
        for name, value in fields
    ]
    return F.concat(*lines, F.lit(CRLF))


def _safe_url(url: Column) -> Column:
    encoded = url
    for code in (0x20, 0x0D, 0x0A, 0x09, 0x00):
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(encoded, F.lit("about:blank"))


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html"
) -> DataFrame:
    """One record per page: ``id``, ``url``, ``payload``, and the payload's ``key`` and ``size``."""
    payload = F.coalesce(F.col(body_col).cast("string").cast("binary"), F.lit(b""))
    base = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
    )
    return base.withColumns(
        {"key": F.unhex(F.sha2("payload", 256)), "size": F.octet_length("payload").cast("long")}
    )


def headers(found: DataFrame, min_bytes: int = MIN_BYTES, date: str = DATE) -> DataFrame:
    """``key`` and the exact ``header`` bytes of every record.

    Runs a job: the largest ids of repeated payloads are stored, so that both sides of the join are
    plain scans, and adaptive execution splits a payload that a third of all records share.
    """
    narrow = found.select("id", "url", "key", "size", F.sha1("payload").alias("digest"))
    repeated = found.where(F.col("size") >= min_bytes).groupBy("key").agg(
        F.max("id").alias("response_id"), F.count("*").alias("copies")
    )
    largest = store(repeated.where("copies > 1").drop("copies"), "warc-responses")
    linked = narrow.join(largest.withColumn("shared", F.lit(True)), "key", "left")
    refers = F.col("shared").isNotNull() & ~F.col("id").eqNullSafe(F.col("response_id"))
    linked = linked.withColumn("revisit", refers)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        _lines(
            ("Content-Type", F.lit("text/html; charset=utf-8")),
            ("Content-Length", F.col("size").cast("string")),
        ),
    )
    block = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _lines(
            ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
            ("WARC-Record-ID", _name(F.col("id"))),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", _safe_url(F.col("url"))),
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(F.col("revisit"), _name(F.col("response_id")))),
            ("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
            ("Content-Length", block.cast("string")),
        ),
    )
    return linked.select("key", F.concat(warc, http).cast("binary").alias("header"))


def archive(found: DataFrame, path: str) -> None:
    """Write records (see ``records``) as an archive below ``path``."""
    headers(found).write.option("compression", "zstd").parquet(f"{path}/headers")
    # Partial aggregation leaves one copy of a payload per task before anything is shuffled.
    once = found.groupBy("key").agg(F.first("payload").alias("payload"))
    once.write.option("compression", "zstd").parquet(f"{path}/payloads")


def restore(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``payload`` of every record of an archive; fails on a damaged payload."""
    stored_headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    joined = stored_headers.join(payloads, "key", "left")
    whole = F.sha2("payload", 256).eqNullSafe(F.lower(F.hex("key")))
    checked = F.when(whole, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("missing or damaged payload "), F.hex("key"))).cast("binary")
    )
    return joined.select("header", checked.alias("payload"))


def field(name: str) -> Column:
    """The first value of a field in the exact header; null if the record has none."""
    text = F.col("header").cast("string")
    value = F.regexp_extract(text, f"\\r\\n{name}: ([^\\r]*)\\r\\n", 1)
    return F.when(value != "", value)


def parse(restored: DataFrame) -> DataFrame:
    """What the records say: id, type, reference, and size and digest of the full payload."""
    pattern = f"<{NAME}(-?[0-9]+)>"
    named = {
        name: F.regexp_extract(F.coalesce(field(header), F.lit("")), pattern, 1)
        for name, header in (("id", "WARC-Record-ID"), ("refers_to", "WARC-Refers-To"))
    }
    return restored.select(
        F.when(named["id"] != "", named["id"]).cast("long").alias("id"),
        field("WARC-Type").alias("record_type"),
        F.when(named["refers_to"] != "", named["refers_to"]).cast("long").alias("refers_to"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )


def export_warc(restored: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write restored records as WARC files; a revisit's block has no payload.

    Two line ends close a record, so the files are lines of text with that separator; the payloads'
    bytes are written as they are.
    """
    revisit = field("WARC-Type") == "revisit"
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat("header", body).cast("string").alias("value")
    restored.select(record).write.option("compression", compression).option(
        "lineSep", CRLF + CRLF
    ).text(path)
