"""WARC archives: write, read back, and put segmented records together.

Every page becomes a ``response`` record (an HTTP message in chunked transfer
framing) or, if a page with an equal payload and a larger id exists, a
``revisit`` record. A record longer than ``segment_bytes`` is cut into segments:
the first record and ``continuation`` records that name it as their origin. The
text writer of Spark writes the archives: one record is one row, and the blank
lines that end a WARC record are its line separator, so a file is a plain
concatenation of records, compressed as a whole.

Reading parses each archive by its content lengths. Segments are grouped by
origin, ordered by number, checked against the total length, and only then is
the chunked framing decoded. Archives hold at most ``RECORDS_A_FILE`` records of
at most ``segment_bytes``, which bounds what one task reads.

Defined results: null payload counts as empty; of rows with the same largest
page_id and payload each is a response; a null page_id never is the largest if
another exists; null addresses give an empty target; an empty table gives no
records; a record whose segments do not add up has no payload (``complete`` is
false) instead of a wrong one.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.llm.store import folder, stored

SEGMENT_BYTES = 64 << 10
RECORDS_A_FILE = 1000
CHUNK_BYTES = 16 << 10
DUPLICATE_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload behind chunked framing; None if the framing is broken."""
    parts, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        if stop < 0:
            return None
        try:
            size = int(body[at:stop].split(b";")[0], 16)
        except ValueError:
            return None
        at = stop + 2
        if not size:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes | None:
    """The decoded body of an HTTP message."""
    head, found, body = block.partition(END)
    if not found:
        return None
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def records(rows: pd.DataFrame, segment_bytes: int) -> Iterator[bytes]:
    """Records of each row, without the two line ends that close each."""
    for page_id, url, digest, refers_to, html in zip(
        rows["page_id"], rows["url"], rows["digest"], rows["refers_to"], rows["html"], strict=True
    ):
        name = f"<urn:uuid:{uuid.uuid4()}>"
        target = "" if url is None else "".join(c for c in url if c not in "\r\n")
        common = (
            f"WARC-Date: {DATE}\r\nWARC-Target-URI: {target}\r\n"
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}\r\n"
            + (f"Page-Id: {int(page_id)}\r\n" if not pd.isna(page_id) else "")
        )
        if not pd.isna(refers_to):
            head = (
                f"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: {name}\r\n{common}"
                f"WARC-Profile: {PROFILE}\r\nRefers-To-Page-Id: {int(refers_to)}\r\n"
                "Content-Type: application/http;msgtype=response\r\nContent-Length: "
            )
            yield f"{head}{len(HTTP)}\r\n\r\n".encode() + HTTP
            continue
        block = HTTP + chunked(html)
        pieces = range(0, len(block), segment_bytes)
        for number, at in enumerate(pieces, 1):
            piece = block[at : at + segment_bytes]
            if number == 1:
                head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\n{common}"
            else:
                head = (
                    f"WARC/1.1\r\nWARC-Type: continuation\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
                    f"WARC-Date: {DATE}\r\nWARC-Segment-Origin-ID: {name}\r\n"
                )
            if len(pieces) > 1:
                head += f"WARC-Segment-Number: {number}\r\n"
                if number == len(pieces):
                    head += f"WARC-Segment-Total-Length: {len(block)}\r\n"
            head += f"Content-Type: application/http;msgtype=response\r\nContent-Length: {len(piece)}\r\n\r\n"
            yield head.encode() + piece


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (bytes), digest and refers_to (null: a response).

    The table of repeated payloads is written first, so the planner broadcasts
    it only when its known size is small and joins by shuffle otherwise.
    """
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("html"),
    ).withColumn("digest", F.sha1("html"))
    repeated = stored(
        base.where(F.octet_length("html") >= DUPLICATE_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and keeper is not null")
        .drop("n")
    )
    refers = F.when(F.col("keeper") != F.coalesce("page_id", F.col("keeper") - 1), F.col("keeper"))
    return base.join(repeated, "digest", "left").select(
        "page_id", "url", "html", "digest", refers.alias("refers_to")
    )


def write(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Archives of all pages below ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 200):
                yield pd.DataFrame({"value": list(records(rows.iloc[at : at + 200], segment_bytes))})

    (
        with_revisits(pages)
        .mapInPandas(run, "value binary")
        .select(F.col("value").cast("string"))  # keeps the bytes as they are
        .write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_A_FILE)
        .text(path)
    )


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record."""
    at = 0
    while (stop := archive.find(END, at)) >= 0:
        lines = archive[at:stop].decode().split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        yield head, archive[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + len(END)


RECORD = (
    "record_id string, record_type string, page_id long, refers_to long, digest string, "
    "origin string, number int, total long, body binary"
)


def _record(head: dict[str, str], block: bytes, segments: bool) -> tuple:
    def number(name: str) -> int | None:
        return int(head[name]) if name in head else None

    digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
    return (
        head["warc-record-id"],
        head["warc-type"],
        number("page-id"),
        number("refers-to-page-id"),
        base64.b32decode(digest).hex() if digest else None,
        head.get("warc-segment-origin-id", head["warc-record-id"]) if segments else None,
        number("warc-segment-number"),
        number("warc-segment-total-length"),
        block if segments else payload_of(block),
    )


def _scan(spark: SparkSession, path: str, segments: bool) -> DataFrame:
    """Whole records with decoded payload, or raw segments."""
    names = [x.split()[0] for x in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for content in files["content"]:
                out, size = [], 0
                archive = zlib.decompress(content, 47) if content[:2] == b"\x1f\x8b" else content
                for head, block in parsed(archive):
                    if ("warc-segment-number" in head) == segments:
                        out.append(_record(head, block, segments))
                        size += len(block)
                    if size > 4 << 20:
                        yield _frame(out, names)
                        out, size = [], 0
                yield _frame(out, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInPandas(run, RECORD)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to", "number", "total"):
        out[c] = out[c].astype("Int64")
    return out


def _reassembled(parts: pd.DataFrame) -> pd.DataFrame:
    """One record from its segments; no body if one is missing or the length is wrong."""
    parts = parts.sort_values("number")
    first = parts.iloc[0]
    block = b"".join(parts["body"])
    total = parts["total"].dropna()
    whole = (
        list(parts["number"]) == list(range(1, len(parts) + 1))
        and len(total) == 1
        and int(total.iloc[0]) == len(block)
    )
    row = first.to_dict() | {"total": len(block), "body": payload_of(block) if whole else None}
    return pd.DataFrame([row])[list(parts.columns)].astype({"total": "Int64"})


def read(spark: SparkSession, path: str) -> DataFrame:
    """All response and revisit records with decoded payload (null for revisits)."""
    whole = _scan(spark, path, segments=False)
    pieces = _scan(spark, path, segments=True)
    joined = pieces.groupBy("origin").applyInPandas(_reassembled, RECORD)
    both = whole.unionByName(joined)
    payload = F.when(F.col("record_type") == "response", F.col("body"))
    return both.select(
        "record_id",
        "record_type",
        "page_id",
        "refers_to",
        "digest",
        payload.alias("payload"),
        ((F.col("record_type") == "revisit") | payload.isNotNull()).alias("complete"),
    )


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write archives to the shared folder, read them back, and resolve revisits.

    ``payload_bytes`` and ``payload_digest`` come from the payloads read; a
    revisit takes them from the response it refers to.
    """
    spark = pages.sparkSession
    path = folder(spark)
    write(pages, path, segment_bytes)
    found = stored(
        read(spark, path).select(
            "page_id",
            "record_type",
            "refers_to",
            F.when(F.col("record_type") == "revisit", F.col("digest"))
            .otherwise(F.sha1("payload"))
            .alias("payload_digest"),
            F.octet_length("payload").cast("long").alias("own_bytes"),
        )
    )
    kept = (
        found.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("own_bytes").alias("kept_bytes"))
    )
    return found.join(kept, ["refers_to", "payload_digest"], "left").select(
        "page_id",
        F.coalesce("own_bytes", "kept_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
