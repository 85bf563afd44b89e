"""WARC archives: written with segmented and chunked records, read back whole.

A response longer than ``segment_bytes`` is written as a first record and continuation
records, which may lie in any file of the archive. The reader groups segments by origin
id, orders them by segment number, verifies the total length, decodes chunked transfer
framing and verifies the payload digest. Records in one piece are decoded where they
are read; only segments are shuffled, and a task holds one record at a time.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, functions as F

from .common import batches_of, file_system, fresh_file, per_file, rows_of, small_batches, stage

SEGMENT_BYTES = 32 * 1024
CHUNK_BYTES = 8 * 1024
FILE_BYTES = 512 * 1024**2
DATE = "2024-01-01T00:00:00Z"

LIST = "path string, records long"
SEGMENT = (
    "origin string, number int, total long, target_uri string, digest string, block binary"
)
PAGE = (
    "page_id long, target_uri string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, status string, payload binary"
)


def base32_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# Writing --------------------------------------------------------------------


def duplicates(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with body, digest and refers_to: the largest page_id
    with an equal payload, if that is another one and the payload has ``min_bytes``.

    Digests meet as partial maxima; the join back on a digest that a third of all pages
    share is a plain join, which Spark splits.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", body.alias("body"), F.sha1(body).alias("digest"))
    shared = (
        pages.filter(F.octet_length("body") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first")
    )
    joined = pages.join(shared, "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "body", "digest", refers.alias("refers_to"))


def chunked(body: bytes) -> bytes:
    parts = [body[at : at + CHUNK_BYTES] for at in range(0, len(body), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return b"WARC/1.1\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (head.encode(), len(block), block)


def page_records(page_id, url, body: bytes, digest: str, refers_to, segment_bytes: int) -> Iterator[bytes]:
    """The one record of a page, or its segments in order."""
    name = f"urn:page:{'' if page_id is None else page_id}"
    target = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    payload = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    common = [("WARC-Date", DATE), ("WARC-Target-URI", target)]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is not None:
        yield record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common,
             ("WARC-Payload-Digest", payload), ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
             ("Content-Type", "application/http; msgtype=response")],
            f"{http}Content-Length: {len(body)}\r\n\r\n".encode(),
        )
        return
    block = f"{http}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(body)
    first = [("WARC-Payload-Digest", payload), ("Content-Type", "application/http; msgtype=response")]
    if len(block) <= segment_bytes:
        yield record([("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, *first], block)
        return
    # Rows that repeat a page_id must not share an origin.
    origin = f"<{name}:{uuid.uuid4().hex}>"
    yield record(
        [("WARC-Type", "response"), ("WARC-Record-ID", origin), *common, *first,
         ("WARC-Segment-Number", "1")],
        block[:segment_bytes],
    )
    starts = range(segment_bytes, len(block), segment_bytes)
    for k, at in enumerate(starts, 2):
        last = at + segment_bytes >= len(block)
        yield record(
            [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{origin[:-1]}:{k}>"), *common,
             ("WARC-Segment-Origin-ID", origin), ("WARC-Segment-Number", str(k)),
             ("WARC-Segment-Total-Length", str(len(block)) if last else None)],
            block[at : at + segment_bytes],
        )


class ArchiveWriter:
    def __init__(self, folder: str):
        self.path = fresh_file(folder, ".warc.gz")
        system, path = file_system(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self._out = system.open_output_stream(path, compression=None)
        self.records = self.bytes = 0

    def add(self, data: bytes) -> None:
        member = gzip.compress(data, 1, mtime=0)
        self._out.write(member)
        self.records += 1
        self.bytes += len(member)

    def close(self) -> tuple[str, int]:
        self._out.close()
        return self.path, self.records


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files; returns their list.

    Null html is an empty payload, a null url leaves the target out; of equal payloads of
    at least ``min_bytes`` bytes that with the largest page_id is written in full, rows
    with its page_id likewise, all others as revisits. An empty table gives an empty list.
    """
    small_batches(pages.sparkSession)
    rows = duplicates(pages, min_bytes)

    def write(batches):
        writers: list[ArchiveWriter | None] = [None, None]
        for row in rows_of(batches, ["page_id", "url", "body", "digest", "refers_to"]):
            for k, data in enumerate(page_records(*row, segment_bytes)):
                # Continuations go to files of their own, as a crawler rolls files over.
                k = min(k, 1)
                writers[k] = writers[k] or ArchiveWriter(folder)
                writers[k].add(data)
                if writers[k].bytes >= FILE_BYTES:
                    yield writers[k].close()
                    writers[k] = None
        for writer in filter(None, writers):
            yield writer.close()

    listed = rows.mapInArrow(lambda batches: batches_of(write(batches), LIST, 1), LIST)
    return stage(listed, "archive-list")


# Reading --------------------------------------------------------------------


def read_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of a file, one at a time."""
    system, path = file_system(path)
    with system.open_input_stream(path, compression=None) as file:
        held, member, plain = b"", zlib.decompressobj(31), bytearray()
        while True:
            if not held and not (held := file.read(1 << 20)):
                break
            plain += member.decompress(held)
            held = member.unused_data
            if member.eof:
                yield parse_record(bytes(plain))
                member, plain = zlib.decompressobj(31), bytearray()
        if plain:
            raise ValueError(f"{path} ends within a record")


def header_lines(head: bytes) -> dict[str, str]:
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = header_lines(head)
    length = int(headers["content-length"])
    if not head.startswith(b"WARC/") or len(rest) < length:
        raise ValueError("not a whole WARC record")
    return headers, rest[:length]


def decode_chunks(data: bytes) -> bytes | None:
    """The body behind chunked framing; None if the framing is broken or cut off."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        try:
            size = int(data[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0:
            return None
        if size == 0:
            return b"".join(out) if data.find(b"\r\n", end + 2) >= 0 else None
        at = end + 2 + size
        if data[at : at + 2] != b"\r\n":
            return None
        out.append(data[end + 2 : at])
        at += 2


def page_of(name: str | None) -> int | None:
    """The page id in a record's id."""
    parts = (name or "").strip("<>").split(":")
    return int(parts[2]) if parts[:2] == ["urn", "page"] and parts[2] else None


def response(name, target, digest, block, problem=None) -> tuple:
    """A row of ``PAGE``; status names the first check that failed."""
    head, _, body = block.partition(b"\r\n\r\n")
    headers = header_lines(head)
    if not problem and headers.get("transfer-encoding", "").lower() == "chunked":
        body = decode_chunks(body)
        problem = "bad chunks" if body is None else None
    elif not problem and len(body) != int(headers.get("content-length", len(body))):
        problem = "length differs"
    if problem:
        return page_of(name), target, "response", None, None, None, problem, None
    found = base32_digest(body)
    problem = "ok" if digest in (None, "sha1:" + found) else "digest differs"
    return page_of(name), target, "response", None, len(body), found, problem, body


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The pages of the listed archives, in the columns of ``PAGE``.

    status is ok, or names what is wrong: a segment missing or repeated, the total length,
    the chunked framing or the digest. A revisit takes its length and digest from its
    record. ``payloads=False`` leaves the payloads out after they are verified.
    """
    small_batches(files.sparkSession)
    listed = per_file(files)

    def whole(batches):
        for (path,) in rows_of(batches, ["path"]):
            for headers, block in read_records(path):
                name, target = headers.get("warc-record-id"), headers.get("warc-target-uri")
                digest = headers.get("warc-payload-digest")
                if headers["warc-type"] == "revisit":
                    http = header_lines(block.partition(b"\r\n\r\n")[0])
                    yield (
                        page_of(name), target, "revisit", page_of(headers.get("warc-refers-to")),
                        int(http["content-length"]), digest.removeprefix("sha1:"), "ok", None,
                    )
                elif headers["warc-type"] == "response" and "warc-segment-number" not in headers:
                    row = response(name, target, digest, block)
                    yield row if payloads else (*row[:-1], None)

    def segments(batches):
        for (path,) in rows_of(batches, ["path"]):
            for headers, block in read_records(path):
                if "warc-segment-number" in headers:
                    yield (
                        headers.get("warc-segment-origin-id", headers["warc-record-id"]),
                        int(headers["warc-segment-number"]),
                        int(n) if (n := headers.get("warc-segment-total-length")) else None,
                        headers.get("warc-target-uri"), headers.get("warc-payload-digest"), block,
                    )

    def assemble(batches):
        """Segments in order of origin and number, to one row per origin."""
        origin, held = None, []
        for row in rows_of(batches, ["origin", "number", "total", "target_uri", "digest", "block"]):
            if held and row[0] != origin:
                yield assembled(origin, held)
                held = []
            origin = row[0]
            held.append(row[1:])
        if held:
            yield assembled(origin, held)

    def assembled(origin, parts):
        block = b"".join(p[4] for p in parts)
        problem = None
        if [p[0] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1][1] is None:
            problem = "segment missing or repeated"
        elif parts[-1][1] != len(block):
            problem = "total length differs"
        row = response(origin, parts[0][2], parts[0][3], block, problem)
        return row if payloads else (*row[:-1], None)

    single = listed.mapInArrow(lambda b: batches_of(whole(b), PAGE, 128), PAGE)
    joined = (
        listed.mapInArrow(lambda b: batches_of(segments(b), SEGMENT, 64), SEGMENT)
        .repartition("origin")
        .sortWithinPartitions("origin", "number")
        .mapInArrow(lambda b: batches_of(assemble(b), PAGE, 64), PAGE)
    )
    return single.unionByName(joined)
