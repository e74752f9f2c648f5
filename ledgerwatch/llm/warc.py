"""WARC archives with revisit records.

Headers (digest, size, page) are grouped by payload digest with a map-side-combined minimum,
joined back to the headers, and each record is written once: the page with the smallest id of
a payload as a response, others as revisits that name it and carry no payload. Payloads move
once, by page id and digest, so a payload that a third of all pages share stays spread.

Archives are gzipped WARC/1.1 with UTF-8 payloads. A gzipped file is read by one task, in order, so
``records_per_file`` bounds its length. The reader takes any such archive: text is cut where
``WARC/1.1`` begins a line, and cuts inside a payload are mended by ``Content-Length``; digests are
checked on the payloads as read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
VERSION = f"WARC/1.1{CRLF}"
HOST = "urn:page:"
#: A record is dated by its crawl; the tables have no date, so all records carry this one.
DATE = "2024-01-01T00:00:00Z"
#: Records that a reader's task hands on together.
RECORDS = 256


def _base32(sha1_hex: Column) -> Column:
    """Bare base32 of 20 bytes given in hex: five hex digits are four letters."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, sha1 of every page's whole payload; a null html is empty."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body).alias("sha1"))


def resolve(heads: DataFrame, least: int = 0) -> DataFrame:
    """page_id, sha1, payload_bytes and ``refers_to``, the first page with that payload, of all other pages with it.

    Payloads under ``least`` bytes are all responses. Pages without an id are responses too and
    never referred to.
    """
    payload = ["sha1", "payload_bytes"]
    known = heads.where("page_id is not null and payload_bytes >= %d" % least)
    first = known.groupBy(*payload).agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    shared = first.where("n > 1").select(*payload, "refers_to")
    return known.join(shared, payload).where("page_id != refers_to").select("page_id", *payload, "refers_to").distinct()


def write_archives(pages: DataFrame, path: str, least: int = 0, records_per_file: int = 20_000) -> None:
    """Write one record per page below ``path``.

    ``pages`` needs page_id, url and html. Extra columns are ignored. Null urls are written as an
    empty target, a null html as an empty payload. A page id that occurs more than once gives a
    record each time, each by its own payload: of equal payloads all records of the smallest id are
    responses. An empty table gives an archive without records.
    """
    pages = pages.select("page_id", "url", "html")
    revisits = resolve(headers(pages), least)
    text = F.coalesce(F.col("html"), F.lit(""))
    body = text.cast("binary")
    revisit = F.col("refers_to").isNotNull()
    payload = F.when(revisit, F.lit("")).otherwise(text)
    clean_url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", "")
    digest = F.concat(F.lit("sha1:"), _base32(F.sha1(body)))
    record = F.concat(
        F.lit(f"{VERSION}WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}WARC-Record-ID: <{HOST}"),
        F.coalesce(F.col("page_id").cast("string"), F.lit("none")),
        F.lit(f">{CRLF}WARC-Target-URI: "),
        clean_url,
        F.lit(f"{CRLF}WARC-Payload-Digest: "),
        digest,
        F.when(
            revisit,
            F.concat(
                F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: <{HOST}"),
                F.col("refers_to").cast("string"),
                F.lit(f">{CRLF}X-Payload-Length: "),
                F.octet_length(body).cast("string"),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload.cast("binary")).cast("string"),
        F.lit(CRLF + CRLF),
        payload,
    )
    keyed = pages.select("*", F.sha1(body).alias("sha1"), F.octet_length(body).cast("long").alias("payload_bytes"))
    joined = keyed.join(revisits, ["page_id", "sha1", "payload_bytes"], "left")
    writer = joined.select(record.alias("value")).write.option("lineSep", CRLF + CRLF)
    writer.option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def _fields(text: str) -> dict[str, str]:
    head = text.partition(CRLF + CRLF)[0]
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.split(CRLF))


def _records(parts: Iterator[str]) -> Iterator[str]:
    """Whole records from the text between version lines: a part that ends before its record's length
    says belongs together with the next ones."""
    held: list[str] = []
    missing = 0
    for part in parts:
        if held:
            held.append(VERSION + part)
            missing -= len(held[-1].encode())
        elif part.strip(CRLF):
            held = [part]
            missing = int(_fields(part)["Content-Length"]) - len(part.partition(CRLF + CRLF)[2].encode())
        if held and missing <= 0:
            yield "".join(held)
            held = []
    if held:
        raise ValueError(f"record {_fields(held[0])['WARC-Record-ID']} ends before its length says")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of archives as page_id, url, payload, payload_bytes, payload_digest,
    record_type and refers_to; fails on a record whose size or digest does not hold."""
    lines = spark.read.option("lineSep", VERSION).text(path)
    schema = "page_id long, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = []
        for text in _records(part for batch in batches for part in batch["value"]):
            waiting.append(_record(text))
            if len(waiting) >= RECORDS:
                yield pd.DataFrame(waiting, columns=names).astype(kinds)
                waiting = []
        yield pd.DataFrame(waiting, columns=names).astype(kinds)

    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"}
    return lines.mapInPandas(parse, schema)


def _record(text: str) -> tuple:
    field = _fields(text)
    body = text.partition(CRLF + CRLF)[2].encode()
    size = int(field["Content-Length"])
    if body[size:].strip(b"\r\n") or len(body) < size:
        raise ValueError(f"record {field['WARC-Record-ID']} does not end where its length says")
    body = body[:size]
    number = lambda v: None if v == "none" else int(v)
    page = number(field["WARC-Record-ID"].removeprefix(f"<{HOST}").removesuffix(">"))
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "revisit":
        first = number(field["WARC-Refers-To"].removeprefix(f"<{HOST}").removesuffix(">"))
        return page, field["WARC-Target-URI"], None, int(field["X-Payload-Length"]), digest, "revisit", first
    if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError(f"record {field['WARC-Record-ID']} does not match its digest")
    return page, field["WARC-Target-URI"], body.decode(), size, digest, "response", None
