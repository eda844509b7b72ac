"""WARC archives: one gzip member per record, written by Spark's own file sink and read as a stream of members.

Writing needs no access to the store from Python: each record is compressed to one member, and Spark's text
sink writes the raw bytes with its usual task commit, so a lost executor leaves no half archive.  The sink puts
one byte after every row; it is the last byte of the member itself, the top byte of its length field, which is 0
for records below 16 MiB.  A larger record is followed by one zero byte, which readers skip as padding.

Reading takes an archive's bytes through Spark's binary reader (any store Spark can read) and walks them in
order: ``zlib`` is fed ``CHUNK`` bytes at a time, a member's head is parsed as soon as it is complete, its
block is framed by Content-Length, and payload and block digests are verified.  Archives are bounded when
written (``records`` per file and Spark's scan partitions), one record is in memory at a time.

Defined cases: a null payload is empty; a null page id is written as ``null`` and read back as null, and such
a record is a response only if no record with an id has its payload; repeated rows of the largest id are all responses;
an empty table gives no rows; a broken member gives one row with ``error`` and ends its archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import arrow_batches, join_small, stage

CHUNK = 64 * 1024
#: Records of an archive, which a task reads whole, and of an Arrow batch of payloads.
RECORDS, BATCH = 2_000, 200
# Fixed values of the format.
VERSION, BREAK, REVISIT = "WARC/1.1", b"\r\n\r\n", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, valid boolean, error string"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member; a revisit keeps the payload's digest and length and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = lambda i: f"<urn:x-page:{'null' if i is None else i}>"
    fields = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {name(page_id)}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or '').translate({13: 32, 10: 32})}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        fields[2:2] = [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name(refers_to)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(fields).encode() + BREAK + block + BREAK) + packer.flush()


def with_originals(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` with ``payload``, ``refers_to`` and ``revisit``.

    Copies are found by digest and length on narrow rows.  Few payloads have copies, as a rule: then they are broadcast and
    no payload is shuffled or sorted; beyond that the pages of one payload are spread over salts.
    """
    held = pages.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    keyed = held.withColumns({"_digest": F.sha1("payload"), "_bytes": F.octet_length("payload")})
    first = (
        keyed.where(F.col("_bytes") >= least)
        .groupBy("_digest", "_bytes")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _first is not null")
        .drop("_n")
    )
    met = join_small(keyed, stage(first, "copied-payloads"), ["_digest", "_bytes"], "left", salt=["page_id"])
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return met.select("page_id", "url", "payload", F.when(revisit, F.col("_first")).alias("refers_to"), revisit.alias("revisit"))


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page_id, url, payload, refers_to, revisit in batch.itertuples(index=False, name=None):
            whole = lambda v: None if pd.isna(v) else int(v)
            data = record_bytes(whole(page_id), url, bytes(payload), whole(refers_to), bool(revisit))
            rows.append(data[:-1] if data[-1] == 0 else data)
        yield pd.DataFrame({"member": rows})


def write_archives(pages: DataFrame, path: str, records: int = RECORDS, least: int = 0) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``; payloads of at least ``least`` bytes are revisited."""
    ready = with_originals(pages, least).withColumn("page_id", F.col("page_id").cast("string")).withColumn("refers_to", F.col("refers_to").cast("string"))
    members = ready.mapInPandas(_members, "member binary")
    with arrow_batches(pages.sparkSession, BATCH):
        members.select(F.col("member").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", records).text(path)


def stream_members(data: bytes, chunk: int = CHUNK) -> Iterator[tuple[dict, bytes]]:
    """(head fields, block) of every member of an archive, decompressed ``chunk`` bytes at a time."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:  # padding after a member
            at += 1
            continue
        unpacker, head, fields, need = zlib.decompressobj(31), b"", None, -1
        block = bytearray()
        while not unpacker.eof:
            piece = view[at : at + chunk]
            if not piece:
                raise ValueError("the archive ends inside a member")
            out = unpacker.decompress(piece)
            at += len(piece) - len(unpacker.unused_data)
            if fields is None:
                head += out
                end = head.find(BREAK)
                if end < 0:
                    continue
                lines = head[:end].decode("utf-8", "replace").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("no record version")
                fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
                need = int(fields["content-length"])
                out, head = head[end + len(BREAK) :], b""
            block += out
            if len(block) > need + len(BREAK):
                raise ValueError("the block is longer than its Content-Length")
        if fields is None or len(block) != need + len(BREAK) or block[need:] != BREAK:
            raise ValueError("the block is not as long as its Content-Length")
        yield fields, bytes(block[:need])


def parse_record(fields: dict, block: bytes) -> dict:
    """Row of one record; ``valid`` says whether both digests and the payload length hold."""
    page = lambda v: None if not v or "null" in v else int(v.removeprefix("<urn:x-page:").removesuffix(">"))
    kind, stated = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha1:")
    head, _, payload = block.partition(BREAK)
    lengths = [line.partition(":")[2] for line in head.decode("latin-1").split("\r\n") if line.lower().startswith("content-length:")]
    length = int(lengths[0]) if lengths else len(payload)
    valid = f"sha1:{digest(block)}" == fields.get("warc-block-digest")
    if kind != "revisit":
        valid = valid and digest(payload) == stated and len(payload) == length
    return {
        "page_id": page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
        "refers_to": page(fields.get("warc-refers-to")), "payload_bytes": length, "payload_digest": stated,
        "payload": None if kind == "revisit" else payload, "valid": valid, "error": None,
    }


def read_archives(spark: SparkSession, path: str, payloads: bool = True, batch: int = BATCH) -> DataFrame:
    """Rows of every record of the archives below ``path`` in archive order; ``payloads`` keeps response bodies."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for content in files["content"]:
                held: list[dict] = []
                try:
                    for fields, block in stream_members(content):
                        held.append(parse_record(fields, block) | ({} if payloads else {"payload": None}))
                        if len(held) == batch:
                            yield frame(held)
                            held = []
                except (ValueError, KeyError, zlib.error) as problem:
                    held.append(dict.fromkeys(names) | {"error": str(problem), "valid": False})
                if held:
                    yield frame(held)

    names = [field.split()[0] for field in RECORD.split(", ")]

    def frame(held: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(held, columns=names)
        for name in ("page_id", "refers_to", "payload_bytes"):
            out[name] = pd.array([row[name] for row in held], dtype="Int64")
        return out

    archives = spark.read.format("binaryFile").load(path).select("content")
    return archives.mapInPandas(rows, RECORD)
