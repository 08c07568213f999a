"""WARC records as bytes: chunked framing, segments, headers. Runs inside tasks."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

#: Bytes of a chunk of the transfer coding, and of a segment's block.
CHUNK_BYTES, SEGMENT_BYTES = 8192, 16384
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Raises ValueError where the framing is broken or cut short."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: dict[str, str | int | None], block: bytes) -> bytes:
    """A record without the four bytes that end it; line ends within values become spaces."""
    lines = [f"{k}: {' '.join(str(v).split())}" for k, v in headers.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]).encode("utf-8", "replace") + END + block


def page_records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, segment: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and what continues it."""
    digest = hashlib.sha1(payload).hexdigest()
    rid = record_id(page_id, digest)
    common = {"WARC-Date": date, "WARC-Target-URI": url, "WARC-Page-ID": page_id, "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Payload-Length": len(payload)}
    if refers_to is not None:
        yield record({"WARC-Type": "revisit", "WARC-Record-ID": rid, "WARC-Refers-To": record_id(refers_to, digest), "WARC-Refers-To-Page-ID": refers_to, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"} | common, b"")
        return
    block = HTTP + chunked(payload)
    kind = {"Content-Type": "application/http;msgtype=response"}
    if len(block) <= segment:
        yield record({"WARC-Type": "response", "WARC-Record-ID": rid} | common | kind, block)
        return
    parts = range(0, len(block), segment)
    for i, at in enumerate(parts, 1):
        own = {"WARC-Type": "response", "WARC-Record-ID": rid} | common | kind if i == 1 else {"WARC-Type": "continuation", "WARC-Record-ID": record_id(page_id, f"{digest}/{i}"), "WARC-Date": date, "WARC-Segment-Origin-ID": rid}
        last = {"WARC-Segment-Total-Length": len(block)} if i == len(parts) else {}
        yield record(own | {"WARC-Segment-Number": i} | last, block[at : at + segment])


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of every record of a file, plain or gzip of one or more members."""
    while data[:2] == b"\x1f\x8b":
        out, rest = [], data
        while rest[:2] == b"\x1f\x8b":
            unpack = zlib.decompressobj(31)
            out.append(unpack.decompress(rest))
            rest = unpack.unused_data
        data = b"".join(out)
    at = 0
    while at < len(data):
        head = data.index(END, at)
        first, *lines = data[at:head].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines if ":" in x)}
        size = int(headers["content-length"])
        start = head + len(END)
        if start + size + len(END) > len(data):
            raise ValueError("record cut short")
        yield headers, data[start : start + size]
        at = start + size + len(END)


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, its transfer coding undone."""
    head, _, body = block.partition(END)
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
