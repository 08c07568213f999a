"""Token ids in sorted-string tables: prefix-compressed blocks, sparse index, Bloom filter, footer. Runs inside tasks.

A file is, in ascending key order, blocks (zstd, each followed by a line feed, which Spark's text writer adds), then the
Bloom filter, the index and the footer. Integers are little-endian; the keys are 9 bytes that sort as the ids do.

block   entries: u16 bytes shared with the key before, u16 bytes of its own, u32 ids, key bytes, ids (u16 or u32)
index   per block: 9 bytes of its first key, u64 offset, u32 length, u32 entries, u64 ids in the blocks before
footer  u64 offset and length of filter and of index, u64 entries, u64 ids, u8 bytes an id, 8 bytes MAGIC
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard

MAGIC = b"SSTOKEN1"
BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 1 << 16, 10, 7
ENTRY, INDEX, FOOTER = struct.Struct("<HHI"), struct.Struct("<9sQIIQ"), struct.Struct("<QQQQQQB8s")


def key_of(doc_id: int | None) -> bytes:
    """Null sorts first; then by value."""
    return bytes(9) if doc_id is None else b"\1" + ((doc_id + (1 << 63)) & ((1 << 64) - 1)).to_bytes(8, "big")


def id_of(key: bytes) -> int | None:
    return int.from_bytes(key[1:], "big") - (1 << 63) if key[0] else None


def bloom_bits(key: bytes, size: int) -> list[int]:
    h = xxhash.xxh64_intdigest(key)
    a, b = h & 0xFFFFFFFF, h >> 32 | 1
    return [(a + i * b) % size for i in range(BLOOM_HASHES)]


def chunks(rows: Iterator[tuple[int | None, bytes]], width: int) -> Iterator[bytes]:
    """The file's pieces, each of which a line feed follows, from (id, ids as bytes of `width` each) in key order.

    What is held is a block, the index and the keys for the filter; the ids go out block by block.
    """
    packer, keys, index = zstandard.ZstdCompressor(level=1), [], []
    offset = count = tokens = before = 0
    block, first, last = bytearray(), b"", b""

    def closed() -> bytes:
        nonlocal offset, count, before, block
        data = packer.compress(bytes(block))
        index.append(INDEX.pack(first, offset, len(data), count, before))
        offset, count, before, block = offset + len(data) + 1, 0, tokens, bytearray()
        return data

    for doc_id, ids in rows:
        key = key_of(doc_id)
        shared = 0
        if count:
            while shared < 9 and key[shared] == last[shared]:
                shared += 1
        else:
            first = key
        block += ENTRY.pack(shared, 9 - shared, len(ids) // width) + key[shared:] + ids
        count, last, tokens = count + 1, key, tokens + len(ids) // width
        keys.append(key)
        if len(block) >= BLOCK_BYTES:
            yield closed()
    if count:
        yield closed()
    if not keys:
        return
    size = max(64, len(keys) * BLOOM_BITS)
    bits = np.zeros((size + 7) // 8 * 8, np.uint8)
    for key in keys:
        bits[bloom_bits(key, size)] = 1
    bloom = struct.pack("<Q", size) + np.packbits(bits, bitorder="little").tobytes()
    yield bloom
    yield b"".join(index)
    at = offset + len(bloom) + 1
    yield FOOTER.pack(offset, len(bloom), at, len(index) * INDEX.size, len(keys), tokens, width, MAGIC)


class Table:
    """A file's bytes, read by its footer."""

    def __init__(self, data: bytes):
        f = FOOTER.unpack(data[-FOOTER.size - 1 : -1])
        if f[-1] != MAGIC or data[-1:] != b"\n":
            raise ValueError("not a sorted token table, or cut short")
        self.data, self.rows, self.tokens, self.width = data, f[4], f[5], f[6]
        self.bloom = data[f[0] : f[0] + f[1]]
        self.blocks = list(INDEX.iter_unpack(data[f[2] : f[2] + f[3]]))
        self.firsts = [b[0] for b in self.blocks]
        self.unpacker = zstandard.ZstdDecompressor()

    def entries(self, block: tuple) -> Iterator[tuple[bytes, bytes]]:
        raw = self.unpacker.decompress(self.data[block[1] : block[1] + block[2]])
        at, key = 0, b""
        for _ in range(block[3]):
            shared, own, n = ENTRY.unpack_from(raw, at)
            at += ENTRY.size
            key = key[:shared] + raw[at : at + own]
            at += own
            yield key, raw[at : at + n * self.width]
            at += n * self.width

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for b in self.blocks:
            yield from self.entries(b)

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def may_hold(self, key: bytes) -> bool:
        (size,) = struct.unpack_from("<Q", self.bloom)
        return all(self.bloom[8 + b // 8] >> b % 8 & 1 for b in bloom_bits(key, size))

    def find(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every entry of this id: filter, binary search of the index, then the blocks that can hold it."""
        key, found = key_of(doc_id), []
        if not self.blocks or not self.may_hold(key):
            return found
        i = max(0, bisect_right(self.firsts, key) - 1)
        while i and self.firsts[i] == key:
            i -= 1
        while i < len(self.blocks) and self.firsts[i] <= key:
            found += [self.ids(raw) for k, raw in self.entries(self.blocks[i]) if k == key]
            i += 1
        return found


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
