"""Web archives: writing pages as WARC records, and reading archives back.

A record whose block is longer than ``segment_bytes`` is written in segments: a first one and
continuation records that name it as their origin. ``reassemble`` brings the segments of an
origin together, in whatever files they lie, orders them by number and checks that none lacks
and that they add up to the total length. Payloads are framed in chunks, as HTTP transfers
them, and ``with_payload`` takes the frames off.

Archives are plain WARC files. Spark's text writer stores them, a record a row, so that lost
executors leave nothing behind; its reader splits them at the heads of records, so that many
tasks share one file. Our own frames are cut inside every text that looks like such a head.
In an archive from elsewhere a payload may hold one: the record then seems cut short, and
only the files with such records are read again, each as a whole by its declared lengths.

Of equal payloads of at least ``least`` bytes the page of the smallest id is a response and
the others are revisits of it; shorter ones are all responses. A null id is larger than all
others, a null page is an empty payload, a null address is written as the urn of the page.
Rows of equal id and payload are one page: it is written as often as it comes, under one
record id, and read back once. Empty tables give an archive without records. Only the columns
named are read, others may have any name.
"""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import materialize, scratch_path

VERSION = "1.1"
SEGMENT_BYTES, CHUNK_BYTES, LEAST_BYTES = 16_384, 4_096, 100
IDS = uuid.UUID("8a4b54c6-0c3f-5c1f-9d55-2c1f0a7c9a11")  # record ids are names in this space
# What the format prescribes.
BLANK = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


# Writing


def framed(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunks of ``size`` bytes or less; none holds the head of a record."""
    cuts = {*range(0, len(payload), size), len(payload)}
    cuts |= {m.start() + 4 for m in re.finditer(rb"WARC/", payload)}
    edges = sorted(cuts)
    parts = []
    for start, stop in zip(edges, edges[1:]):
        parts += [b"%x\r\n" % (stop - start), payload[start:stop], b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def record_id(*names: object) -> str:
    return f"<{uuid.uuid5(IDS, ':'.join(map(str, names))).urn}>"


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its last byte, a line feed, which the writer sets after each row."""
    fields = [(name, value) for name, value in [*fields, ("Content-Length", len(block))] if value is not None]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"".join([f"WARC/{VERSION}\r\n{head}\r\n".encode(), block, BLANK.encode()[:-1]])


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, keeper: str | None, date: str, segment_bytes: int) -> Iterator[bytes]:
    """The record or records of one page; ``keeper`` is the response that a revisit refers to."""
    own = record_id(page_id, digest)
    address = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    shared = [("WARC-Date", date), ("WARC-Target-URI", address)]
    body = HTTP_HEAD + b"\r\n" if keeper else HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + framed(payload)
    blocks = [body[i : i + segment_bytes] for i in range(0, len(body), segment_bytes)]
    yield record(
        [
            ("WARC-Type", "revisit" if keeper else "response"), ("WARC-Record-ID", own), *shared,
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Profile", PROFILE if keeper else None), ("WARC-Refers-To", keeper),
            ("Content-Type", "application/http; msgtype=response"), ("Page-ID", page_id),
            ("WARC-Segment-Number", 1 if len(blocks) > 1 else None),
        ],
        blocks[0],
    )
    for number, block in enumerate(blocks[1:], start=2):
        yield record(
            [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(page_id, digest, number)), *shared,
                ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", len(body) if number == len(blocks) else None),
            ],
            block,
        )


def revisits_of(pages: DataFrame, least: int) -> DataFrame:
    """id, digest and keeper of the pages that repeat the payload of a smaller id.

    Payloads stay where they are: only digests are grouped, and those of repeated payloads
    joined from stored rows, where Spark splits one that very many pages share."""
    marks = pages.filter(F.octet_length("payload") >= least).select("page_id", "digest")
    marks = materialize(marks, "payload-digests")
    groups = marks.groupBy("digest").agg(F.min("page_id").alias("keeper"), F.count(F.lit(1)).alias("pages"))
    groups = materialize(groups.filter("pages > 1").select("digest", "keeper"), "repeated-payloads")
    found = marks.join(groups, "digest").filter(~F.col("page_id").eqNullSafe(F.col("keeper")))
    found = found.groupBy(F.col("page_id").alias("id"), F.col("digest").alias("of")).agg(F.min("keeper").alias("keeper"))
    return materialize(found, "revisits")


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: datetime | None = None,
    segment_bytes: int = SEGMENT_BYTES,
    least: int = LEAST_BYTES,
) -> None:
    """Write a response or a revisit per page to WARC files in the new folder ``path``."""
    at = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    whole = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), whole.alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256))
    revisits = revisits_of(own, least)
    same = F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of"))
    marked = own.join(revisits, same, "left").select(
        F.col("page_id").cast("string"), "url", "payload", "digest", F.col("keeper").cast("string"), F.col("of").isNotNull().alias("again")
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        info = record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", at), ("Content-Type", "application/warc-fields")], f"format: WARC File Format {VERSION}\r\n".encode())
        for batch in batches:
            found = [info] if info else []
            for number, address, content, digest, keeper, again in batch.itertuples(index=False):
                refers = record_id(keeper, digest) if again else None
                found.extend(records_of(number, address, content, digest, refers, at, segment_bytes))
            info = None
            yield pd.DataFrame({"record": found})

    rows = marked.mapInPandas(write, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


# Reading


def field(name: str) -> Column:
    """A named field of a record's head; null if it lacks."""
    return F.nullif(F.regexp_extract("header", rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?:\r|\n|$)", 1), F.lit(""))


def parts_of(content: bytes) -> Iterator[tuple[str, bytes]]:
    """Head and block of each record of a whole archive, by declared lengths."""
    content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while content[at : at + 5] == b"WARC/":
        end = content.find(b"\r\n\r\n", at)
        head = content[at:end].decode("utf-8", "replace")
        length = re.search(r"(?i)\nContent-Length:[ \t]*(\d+)", head)
        if end < 0 or not length or end + 4 + int(length[1]) > len(content):
            raise ValueError(f"the record at byte {at} is broken")
        start, at = end + 4, end + 4 + int(length[1])
        yield head, content[start:at]
        while content[at : at + 1] in (b"\r", b"\n"):
            at += 1
    if at < len(content):
        raise ValueError(f"no record at byte {at}")


def read_records(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """The records of the archives in ``path``, segments apart: header, block, and the fields
    that matter here. A file that is no archive fails."""
    lines = spark.read.option("lineSep", f"{BLANK}WARC/{version}\r\n").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.substring_index("value", BLANK, 1).alias("header"))
    length = F.nullif(F.regexp_extract("header", r"(?i)(?:^|\n)Content-Length:[ \t]*(\d+)", 1), F.lit("")).cast("long")
    start = F.octet_length("header") + 4
    lines = lines.select("value", "file", "header", length.alias("length"), start.alias("start"))
    left = F.octet_length("value") - F.col("start")
    cut = lines.filter(F.col("length").isNull() | (F.col("length") > left)).select("file").distinct()
    files = [r["file"] for r in cut.collect()]  # names of files, which the planner holds anyhow
    block = F.substring(F.col("value").cast("binary"), F.col("start") + 1, F.col("length").cast("int"))
    records = lines.filter(~F.col("file").isin(files)).select("header", block.alias("block"))
    if files:

        def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for content in batch["content"]:
                    yield pd.DataFrame(list(parts_of(content)), columns=["header", "block"])

        again = spark.read.format("binaryFile").load(files).select("content")
        records = records.unionByName(again.mapInPandas(whole, "header string, block binary"))
    return records.select(
        field("WARC-Record-ID").alias("record_id"),
        field("WARC-Type").alias("warc_type"),
        field("WARC-Segment-Number").cast("int").alias("segment"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin_id"),
        field("WARC-Segment-Total-Length").cast("long").alias("total_length"),
        "header",
        "block",
    )


def reassemble(records: DataFrame) -> DataFrame:
    """record_id, warc_type, header, block and complete, a row per whole record.

    Only segments are shuffled, once, by their origin; a segment that is there twice counts once.
    A record is complete if its segments are 1, 2, … and add up to the total length that the
    last one declares; an incomplete one keeps what there is."""
    plain = records.filter(F.col("segment").isNull())
    plain = plain.select("record_id", "warc_type", "header", "block", F.lit(True).alias("complete"))
    content = F.struct(F.col("block").alias("block"), "total_length", "warc_type", "header")
    parts = records.filter(F.col("segment").isNotNull()).repartition("origin_id")
    parts = parts.groupBy("origin_id", "segment").agg(F.min(content).alias("of"))
    listed = F.sort_array(F.collect_list(F.struct("segment", "of"))).alias("parts")
    joined = parts.groupBy("origin_id").agg(listed)
    numbers = F.transform("parts", lambda p: p["segment"])
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda sum_, p: sum_ + F.octet_length(p["of"]["block"]))
    total = F.get("parts", F.size("parts") - 1)["of"]["total_length"]
    complete = (numbers == F.sequence(F.lit(1), F.size("parts"))) & F.coalesce(size == total, F.lit(False))
    first = F.get("parts", F.lit(0))["of"]
    # Bytes pass through text unread: they are only joined.
    block = F.array_join(F.transform("parts", lambda p: p["of"]["block"].cast("string")), "").cast("binary")
    whole = joined.select(F.col("origin_id").alias("record_id"), first["warc_type"].alias("warc_type"), first["header"].alias("header"), block.alias("block"), complete.alias("complete"))
    return plain.unionByName(whole)


def http_payload(block: bytes) -> tuple[bytes, bool]:
    """The payload of an HTTP message without chunk framing, and whether it is whole. Blocks
    that are no such message are payloads as they are."""
    if not block.startswith(b"HTTP/"):
        return block, True
    head, gap, body = block.partition(b"\r\n\r\n")
    if not re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head):
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
        return body, bool(gap) and (length is None or int(length[1]) == len(body))
    found, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = re.match(rb"[ \t]*([0-9a-fA-F]+)[ \t]*(?:;|$)", body[at:end])
        if not size:
            break
        start, at = end + 2, end + 2 + int(size[1], 16)
        if start == at:  # the last chunk; trailers and a blank line may follow
            rest = body[start:]
            return b"".join(found), rest.startswith(b"\r\n") or b"\r\n\r\n" in rest
        found.append(body[start:at])
        if body[at : at + 2] != b"\r\n":
            break
        at += 2
    return b"".join(found), False


def with_payload(records: DataFrame) -> DataFrame:
    """Reassembled records with ``payload``; one whose framing is broken isn't complete."""

    @F.pandas_udf("payload binary, whole boolean")
    def take(blocks: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([http_payload(b) for b in blocks], columns=["payload", "whole"])

    found = records.withColumn("taken", take("block"))
    whole = F.col("complete") & F.col("taken.whole")
    return found.select("record_id", "warc_type", "header", F.col("taken.payload").alias("payload"), whole.alias("complete"))


def page_report(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """One row per page of the archives: page_id, payload_bytes, payload_digest, record_type,
    refers_to (the response's page) and verified (segments, framing and digest are right).

    A revisit has the length and digest of the response it refers to; if that is not in the
    archives, its declared digest and no length. Payloads are digested where they are read,
    and only rows without them are joined, from stored tables."""
    records = with_payload(reassemble(read_records(spark, path, version)))
    rows = records.filter(F.col("warc_type").isin("response", "revisit")).select(
        "record_id",
        F.col("warc_type").alias("record_type"),
        field("Page-ID").cast("long").alias("page_id"),
        field("WARC-Refers-To").alias("refers"),
        F.lower(F.regexp_replace(field("WARC-Payload-Digest"), "(?i)^sha-?256:", "")).alias("declared"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "complete",
    )
    rows = materialize(rows, "archived")
    rows = materialize(rows.dropDuplicates(["record_id"]), "archived-once")
    responses = rows.filter("record_type = 'response'")
    right = F.col("complete") & F.coalesce(F.col("declared") == F.col("payload_digest"), F.lit(True))
    own = responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), right.alias("verified"))
    known = responses.select(F.col("record_id").alias("response"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest", right.alias("right"))
    again = rows.filter("record_type = 'revisit'").select("page_id", "record_type", "refers", "declared", "complete")
    again = again.join(known, F.col("refers") == F.col("response"), "left")
    digest = F.coalesce("payload_digest", "declared")
    verified = F.coalesce(F.col("complete") & F.col("right") & (F.col("declared") == F.col("payload_digest")), F.lit(False))
    again = again.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to", verified.alias("verified"))
    return own.unionByName(again)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives and report on what is read back."""
    path = scratch_path(pages.sparkSession, "archives")
    write_archives(pages, path)
    return page_report(pages.sparkSession, path)


ORACLE = """
WITH own AS (
  SELECT DISTINCT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
kept AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM own
),
judged AS (
  SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM keeper AS again FROM kept
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN keeper END AS refers_to,
       TRUE AS verified
FROM judged
"""
