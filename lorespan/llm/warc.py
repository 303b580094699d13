"""WARC archives: a writer with revisit records, and a reader that salvages what it can from damaged files.

Every record is a gzip member. Members are gathered to chunks of bounded size and written as raw rows by the
text writer, whose row separator is an empty gzip member; so archives are written by tasks through Spark's own
commit protocol and to any store Spark can write to. Files hold at most ``CHUNKS_PER_FILE`` chunks.

The reader takes each file as bytes. Where a member or a plain record fails a check (gzip sums, version line,
headers, lengths, digests) it searches for the next member or version line that passes, goes on from there
and reports the bytes between as a gap.
"""

from __future__ import annotations

import re
import zlib
from base64 import b32encode, b64encode
from collections.abc import Iterator
from hashlib import new, sha256
from uuid import UUID

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorespan.session import scratch_path

LEAST_REVISIT_BYTES = 100
CHUNK_BYTES, CHUNKS_PER_FILE = 4 << 20, 8
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MAGIC, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_FEED = 1 << 16


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = gzip_member(b"")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{UUID(bytes=sha256(f'{page_id} {digest}'.encode()).digest()[:16], version=5)}>"


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One record: a response, or a revisit of the page ``refers_to`` if that is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + _END + block + _END


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_REVISIT_BYTES) -> None:
    """Write a record for every row of ``pages`` (``page_id long, url, html``) to archives below ``path``.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at least ``least_bytes``
    that with the smallest page_id is the response, the others revisit it; rows that repeat that page_id are
    responses too, and rows with a null page_id are never the one revisited. A null url gives no target header.
    Other columns are ignored; an empty table gives no record.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    repeated = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    rows = rows.join(repeated, "digest", "left").withColumn("refers_to", refers)
    rows = rows.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "digest", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                member = gzip_member(record(*(column[row].as_py() for column in batch.columns)))
                held.append(member)
                size += len(member)
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["chunk"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["chunk"])

    (
        rows.mapInArrow(run, "chunk binary")
        .select(F.col("chunk").cast("string").alias("value"))  # the same bytes; nothing is decoded
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("compression", "none")
        .option("maxRecordsPerFile", CHUNKS_PER_FILE)
        .text(path)
    )


def _member(data: memoryview, at: int) -> tuple[bytes, int, bool]:
    """(content, end, sound) of the gzip member at ``at``. Of a damaged or cut-off one: what was unpacked before that."""
    unpacker, parts, place = zlib.decompressobj(31), [], at
    while not unpacker.eof and place < len(data):
        piece, before = data[place : place + _FEED], unpacker.copy()
        try:
            parts.append(unpacker.decompress(piece))
            place += len(piece)
        except zlib.error:
            # The same piece byte by byte, for what comes before the error.
            try:
                for k in range(len(piece)):
                    parts.append(before.decompress(piece[k : k + 1]))
            except zlib.error:
                return b"".join(parts), place + k, False
    return b"".join(parts), place - len(unpacker.unused_data), unpacker.eof


def _place_of(data: memoryview, at: int, size: int) -> int:
    """Where in ``data`` the first ``size`` bytes of the member at ``at`` are complete."""
    unpacker, place, total = zlib.decompressobj(31), at, 0
    step = _FEED
    while total < size:
        before = unpacker.copy()
        try:
            got = len(unpacker.decompress(data[place : place + step]))
        except zlib.error:
            got = size
        if step > 1 and total + got >= size:
            unpacker, step = before, 1
            continue
        total, place = total + got, place + step
    return place


def _records(content: bytes, sound: bool) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | None]]:
    """(start, end, headers, block) of the records in unpacked bytes, and of the parts between them with null headers.

    If the member isn't ``sound``, its sum vouches for nothing: only records whose own digest can be checked are taken.
    """
    place, bad = 0, None
    while place < len(content):
        one = _record(content, place) if content.startswith(_VERSION, place) else None
        if one is not None and (sound or _vouched(*one[:2])):
            if bad is not None:
                yield bad, place, None, None
                bad = None
            yield place, one[2], *one[:2]
            place = one[2]
            continue
        bad = place if bad is None else bad
        place = content.find(_VERSION, place + 1)
        place = len(content) if place < 0 else place
    if bad is not None:
        yield bad, len(content), None, None


def _vouched(headers: dict[str, str], block: bytes) -> bool:
    return bool(_digest_matches(headers.get("warc-block-digest", ""), block)) or bool(
        _digest_matches(headers.get("warc-payload-digest", ""), block.partition(_END)[2])
    )


def _digest_matches(stated: str, data: bytes) -> bool | None:
    """Whether ``data`` has the stated digest (``algorithm:value`` in hex, base32 or base64); None if it can't be checked."""
    name, colon, value = stated.partition(":")
    if not colon:
        name, value = "sha256", stated
        if len(stated) != 64:
            return None
    name, value = name.strip().lower().replace("-", ""), value.strip()
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return None
    digest = new(name, data, usedforsecurity=False).digest()
    if value.lower() == digest.hex():
        return True
    value = value.rstrip("=")
    return value.upper() == b32encode(digest).decode().rstrip("=") or value in (b64encode(digest).decode().rstrip("="), b64encode(digest, b"-_").decode().rstrip("="))


def _record(data: bytes | memoryview, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """(headers, block, end) of the record at ``at``; None if a check fails."""
    head_end = -1
    for window in (1 << 13, 1 << 20):
        head = bytes(data[at : at + window])
        head_end = head.find(_END)
        if head_end >= 0:
            break
    if head_end < 0 or not re.match(rb"WARC/1\.[01]\r\n", head):
        return None
    headers = {}
    for line in head[:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit() or "warc-type" not in headers:
        return None
    start = at + head_end + 4
    end = start + int(headers["content-length"])
    block = bytes(data[start:end])
    if bytes(data[end : end + 4]) != _END:
        return None
    if _digest_matches(headers.get("warc-block-digest", ""), block) is False:
        return None
    return headers, block, end + 4


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object, object]]:
    """("record", start, end, headers, block) and ("gap", start, end, reason, None) of an archive, in file order.

    Places are those in the file. A member's records have its place; a part of a sound member that is no record is a gap
    with the member's place and the unpacked bytes in the reason. Of a damaged or cut-off member, the records that are
    whole before the damage are passed on if their digests match, or if only the end of the file cuts it off.
    A record that ends right where the unpacked bytes end counts as part of the damage, even if it is whole.
    """
    view, at, bad, reason = memoryview(data), 0, None, ""
    while at < len(data):
        found, end, why = [], at, "no member or version line"
        if data[at : at + 2] == _MAGIC[:2]:
            content, stop, sound = _member(view, at)
            why = "damaged or cut-off member"
            found = list(_records(content, sound or stop == len(data)))
            if sound:
                end = stop
            elif last := max((f[1] for f in found if f[2] is not None and f[1] < len(content)), default=0):
                found, end = [f for f in found if f[1] <= last], _place_of(view, at, last)
            else:
                found = []
        elif data[at : at + len(_VERSION)] == _VERSION:
            sound, one, why = True, _record(view, at), "record fails its checks"
            if one is not None:
                found, end = [(at, one[2], *one[:2])], one[2]
        if end > at:
            if bad is not None:
                yield "gap", bad, at, reason, None
                bad = None
            for first, last, headers, block in found:
                if headers is None:
                    yield "gap", at, end, f"record in a member fails its checks: unpacked bytes {first} to {last}", None
                else:
                    yield "record", at, end, headers, block
            at = end
            if sound or at >= len(data) or data[at : at + 3] == _MAGIC:
                continue
        if bad is None:
            bad, reason = at, why
        nexts = [p for p in (data.find(_MAGIC, at + 1), data.find(_VERSION, at + 1)) if p >= 0]
        at = min(nexts, default=len(data))
    if bad is not None:
        yield "gap", bad, len(data), reason, None


_READ = (
    "kind string, file string, start long, end long, reason string, record_type string, page_id long, url string,"
    " payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """What the archives below ``path`` hold: rows of kind ``record``, and of kind ``gap`` for quarantined bytes.

    The size and digest of a response are those of the payload read; those of a revisit are the stated ones of
    the payload it stands for. Records of other types have no page. A response whose payload doesn't match its stated
    digest is a gap; algorithms other than MD5 and SHA are not checked. Stated digests other than SHA-256 keep their algorithm's name. ``payloads`` adds the payloads of responses.
    """

    def rows_of(file: str, data: bytes) -> Iterator[tuple]:
        for kind, start, end, head, block in salvage(data):
            if kind == "gap":
                yield kind, file, start, end, head, None, None, None, None, None, None, None
                continue
            stated = head.get("warc-payload-digest") or None
            page, refers = (int(v) if (v := head.get(k, "")).lstrip("-").isdigit() else None for k in ("x-page-id", "x-refers-to-page-id"))
            http, _, payload = block.partition(_END)
            size = digest = None
            if head["warc-type"] == "response":
                size, digest = len(payload), sha256(payload).hexdigest()
                if stated is not None and _digest_matches(stated, payload) is False:
                    yield "gap", file, start, end, "payload digest differs", None, None, None, None, None, None, None
                    continue
            elif head["warc-type"] == "revisit":
                length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                size, digest, payload = int(length.group(1)) if length else None, stated and re.sub("^sha-?256:", "", stated, flags=re.I), None
            yield (
                kind, file, start, end, None, head["warc-type"], page, head.get("warc-target-uri"), size, digest, refers,
                payload if payloads and head["warc-type"] == "response" else None,
            )

    schema = pa.schema(
        [("kind", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("record_type", pa.string()),
         ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                held, size = [], 0
                for row in rows_of(file, content.as_py()):
                    held.append(row)
                    size += len(row[-1] or b"")
                    if len(held) >= 5000 or size > 1 << 24:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, _READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the scratch folder; return the records read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path).where("kind = 'record'")
