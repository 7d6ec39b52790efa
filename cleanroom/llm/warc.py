"""Web archives: records written and read by Spark, and equal payloads kept once.

Archives are gzipped WARC 1.1 files under a shared folder.  Records are composed by
SQL functions and written as text whose line separator is the blank lines between
records.  A file is read whole by one task, so files are cut after a number of records
that goes down with the size of their payloads: records of a size class share a folder,
and no file holds more than 64 MB of payloads unless it is a single record.
De-duplication shuffles headers only: the response of each payload digest
is found by an aggregate that is combined before the shuffle, joined back to the
headers, and the decisions meet the payloads by record id, which no hot digest skews.

Defined cases: a null html is an empty payload; a null url leaves the target header out;
a null page id leaves the id header out, loses against any other and stays null; of
equal largest page ids the greater record id wins; line breaks in header values become
spaces; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleanroom.llm.common import arrow_rows, settle
from cleanroom.session import checkpoint_root

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Most payload bytes of a size class (the last has no bound) and records of a file of it.
SIZES = ((1 << 17, 500), (1 << 20, 64), (1 << 23, 8), (None, 1))
RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, target_uri string, date string, payload_digest string,"
    " payload_bytes long, refers_to_record string, refers_to_page long"
)
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "page_id": "X-Page-ID",
    "target_uri": "WARC-Target-URI", "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length", "refers_to_record": "WARC-Refers-To", "refers_to_page": "X-Refers-To-Page",
    "profile": "WARC-Profile", "refers_to_uri": "WARC-Refers-To-Target-URI", "refers_to_date": "WARC-Refers-To-Date",
}


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a binary column, by SQL functions.

    Forty hexadecimal digits are eight groups of 20 bits, each four base-32 digits.
    """
    groups = [F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def as_records(pages: DataFrame, date: str) -> DataFrame:
    """A response record (header fields and payload) per page; nothing is written yet."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload"))
    return rows.select(
        F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">")).alias("record_id"),
        F.lit("response").alias("record_type"),
        "page_id",
        F.regexp_replace("target_uri", r"[\r\n]+", " ").alias("target_uri"),
        F.lit(date).alias("date"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        "payload",
    )


def size_class(n_bytes: Column) -> Column:
    """The place of a payload's size class among ``SIZES``."""
    return sum((F.when(n_bytes > most, 1).otherwise(0) for most, _ in SIZES[:-1]), F.lit(0))


def write_archives(records: DataFrame, path: str, records_per_file: int = SIZES[0][1]) -> None:
    """Write records as WARC files; a revisit has a block of HTTP headers and no payload."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes"), F.lit(CRLF + CRLF),
    )
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    # concat_ws leaves out fields that are null.
    fields = [
        F.concat(F.lit(f"{HEADERS[c]}: "), F.lit("sha1:") if c == "payload_digest" else F.lit(""), F.col(c).cast("string"))
        for c in HEADERS
        if c in records.columns
    ]
    kind = F.lit("Content-Type: application/http;msgtype=response")
    length = F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.octet_length(body)).cast("string"))
    head = F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *fields, kind, length), F.lit(CRLF + CRLF), http)
    whole = F.concat(head.cast("binary"), body).cast("string").alias("value")
    writer = records.select(whole).write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records_per_file)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    writer.option("encoding", "UTF-8").text(path)


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Header fields of every record, its payload too if wanted.

    Digest and length of a response are computed from the bytes read; those of a revisit
    are its header's.
    """

    def parse(batches):
        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
        numbers = {"page_id", "payload_bytes", "refers_to_page"}
        for batch in batches:
            for content in batch.column(0):
                raw, at = gzip.decompress(content.as_buffer()), 0
                view = memoryview(raw)
                rows: dict[str, list] = {n: [] for n in [*names, "payload"]}
                while at < len(raw):
                    end = raw.index(b"\r\n\r\n", at)
                    lines = raw[at:end].decode("utf-8", "replace").split("\r\n")
                    if not lines[0].startswith("WARC/"):
                        raise ValueError(f"no record at byte {at}")
                    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
                    start = end + 4
                    stop = start + int(head["content-length"])
                    begin = min(raw.index(b"\r\n\r\n", start, stop) + 4, stop)
                    values = {n: head.get(HEADERS[n].lower()) for n in names}
                    values = {n: int(v) if n in numbers and v is not None else v for n, v in values.items()}
                    values["payload_digest"] = (values["payload_digest"] or "").removeprefix("sha1:")
                    if values["record_type"] == "response":
                        values["payload_bytes"] = stop - begin
                        values["payload_digest"] = base64.b32encode(hashlib.sha1(view[begin:stop]).digest()).decode()
                    for n in names:
                        rows[n].append(values[n])
                    rows["payload"].append(raw[begin:stop] if payload else None)
                    at = stop + 4  # a record ends with two line breaks
                kinds = {n: pa.int64() if n in numbers else pa.string() for n in names}
                arrays = [pa.array(rows[n], kinds[n]) for n in names]
                if payload:
                    arrays.append(pa.array(rows["payload"], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names + ["payload"] * payload)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, RECORD_SCHEMA + ", payload binary" * payload)


def decide(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``record_type`` and what a revisit refers to, per record.

    ``headers`` is a written table.  Of records with equal payloads of at least
    ``min_bytes`` bytes the one with the largest page id is the response.
    """
    rank = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "record_id", "target_uri", "date")
    same = headers.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
    groups = same.agg(F.max(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    groups = settle(groups, "responses")
    revisit = F.col("first").isNotNull() & (F.col("record_id") != F.col("first.record_id"))
    of = lambda c: F.when(revisit, F.col(f"first.{c}"))
    return headers.join(groups, ["payload_digest", "payload_bytes"], "left").select(
        "record_id",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        of("record_id").alias("refers_to_record"),
        of("page_id").alias("refers_to_page"),
        of("target_uri").alias("refers_to_uri"),
        of("date").alias("refers_to_date"),
        F.when(revisit, F.lit(PROFILE)).alias("profile"),
    )


def deduplicate(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Archive ``pages``, resolve revisits, write archives with fresh headers and read them back.

    ``folder`` gets ``full`` and ``deduplicated``, with a folder for each size class that
    occurs; the result has one row per record.
    """
    spark = pages.sparkSession
    full, lean = f"{folder}/full", f"{folder}/deduplicated"
    of_page = size_class(F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit(""))))
    found = [r.place for r in pages.select(of_page.alias("place")).distinct().collect()] or [0]  # of four at most
    for place in found:
        write_archives(as_records(pages.where(of_page == place), date), f"{full}/size={place}", SIZES[place][1])
    with arrow_rows(spark, 1):  # a row is a whole file
        headers = settle(read_archives(spark, full), "headers")
        decisions = settle(decide(headers, min_bytes), "decisions")
        for place in found:
            records = read_archives(spark, f"{full}/size={place}", payload=True)
            records = records.drop("record_type", "refers_to_record", "refers_to_page").join(decisions, "record_id")
            write_archives(records, f"{lean}/size={place}", SIZES[place][1])
        return settle(read_archives(spark, lean), "records")


def archive_folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
