"""A sorted string table: one file of key-ordered entries that is searched without reading it whole.

Layout: data blocks, Bloom filter, block index, footer.

* A block holds entries ``shared, unshared, value length`` (varints), the key's unshared bytes and the value; keys are
  prefix-compressed against the entry before, from scratch at each block.  It is stored zstandard-compressed and ends with
  the CRC-32 of what is stored.
* The index is sparse: per block its offset, stored length and last key.
* The Bloom filter has ``BLOOM_BITS`` bits a key.
* The footer has fixed length: offsets and lengths of filter and index, counts of entries and ids, width of an id, magic.

Keys sort as their bytes; ``key_of`` gives a document id's key: null before all numbers, numbers in numeric order.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import xxhash
import zstandard

MAGIC = b"TMSST001"
FOOTER = struct.Struct("<QQQQQQI8s")
BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 1 << 16, 10, 7


def key_of(doc_id: int | None) -> bytes:
    """The order-preserving key of a document id."""
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    """The document id of a key."""
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_places(keys: list[bytes], bits: int) -> np.ndarray:
    h = np.array([[xxhash.xxh3_64_intdigest(k, seed=s) & 0xFFFFFFFF for s in (1, 2)] for k in keys], dtype=np.uint64).reshape(-1, 2)
    return (h[:, :1] + h[:, 1:] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(bits)


class Writer:
    """Writes entries, which must come in key order, to a binary stream."""

    def __init__(self, out: BinaryIO, id_bytes: int):
        self.out, self.id_bytes, self.at = out, id_bytes, 0
        self.block, self.last, self.index, self.keys = bytearray(), b"", [], []
        self.n_ids, self.pack = 0, zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.block:
            top = min(len(key), len(self.last))
            while shared < top and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:]
        self.block += value
        self.last = key
        self.keys.append(key)
        self.n_ids += len(value) // self.id_bytes
        if len(self.block) >= BLOCK_BYTES:
            self._end_block()

    def _put(self, data: bytes) -> tuple[int, int]:
        at, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return at, len(data)

    def _end_block(self) -> None:
        if self.block:
            data = self.pack.compress(bytes(self.block))
            self.index.append((*self._put(data + struct.pack("<I", zlib.crc32(data))), self.last))
            self.block = bytearray()

    def close(self) -> None:
        self._end_block()
        bits = max(64, -(-len(self.keys) * BLOOM_BITS // 8) * 8)
        filled = np.zeros(bits, dtype=bool)
        if self.keys:
            filled[_bloom_places(self.keys, bits).ravel().astype(np.int64)] = True
        bloom = self._put(np.packbits(filled).tobytes())
        index = self._put(b"".join(_varint(at) + _varint(n) + _varint(len(k)) + k for at, n, k in self.index))
        self._put(FOOTER.pack(*bloom, *index, len(self.keys), self.n_ids, self.id_bytes, MAGIC))


class Reader:
    """Reads a table through a seekable binary file; a lookup reads footer, index and filter once, then one block a key."""

    def __init__(self, file: BinaryIO, size: int):
        self.file, self.unpack = file, zstandard.ZstdDecompressor()
        *places, self.n_docs, self.n_ids, self.id_bytes, magic = FOOTER.unpack(self._get(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a sorted string table")
        self.bloom = np.unpackbits(np.frombuffer(self._get(*places[:2]), dtype=np.uint8))
        data, at, self.index = self._get(*places[2:]), 0, []
        while at < len(data):
            start, at = _read_varint(data, at)
            length, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            self.index.append((start, length, data[at : at + n]))
            at += n
        self.last_keys = [k for _, _, k in self.index]

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def block(self, i: int) -> Iterator[tuple[bytes, bytes]]:
        """The entries of one block."""
        data = self._get(*self.index[i][:2])
        if zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("a block is damaged")
        data, at, key = self.unpack.decompress(data[:-4]), 0, b""
        while at < len(data):
            shared, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            v, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + n]
            yield key, data[at + n : at + n + v]
            at += n + v

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.index)):
            yield from self.block(i)

    def get(self, key: bytes) -> list[bytes]:
        """All values of a key, by filter, binary search of the index, and the blocks that may hold it."""
        if not self.bloom[_bloom_places([key], len(self.bloom)).ravel().astype(np.int64)].all():
            return []
        found = []
        for i in range(bisect.bisect_left(self.last_keys, key), len(self.index)):
            for k, v in self.block(i):
                if k == key:
                    found.append(v)
            if self.last_keys[i] > key:
                break
        return found
