"""Blocks of texts as rows: whole numbers packed into one binary value, and numbers for blocks."""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark import TaskContext

_BLOCK_BITS = 33


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane and compressed; most are small."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_ids(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers whose sequences repeat, in two bytes each if all are small."""
    kind = "<u2" if not len(numbers) or numbers.max() < 1 << 16 else "<u4"
    data = np.ascontiguousarray(numbers.astype(kind)).tobytes()
    return kind[-1].encode() + zstandard.ZstdCompressor(level=9).compress(data)


def unpack_ids(packed: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(packed[1:])
    return np.frombuffer(data, f"<u{packed[:1].decode()}").astype(np.uint32)


def block_numbers():
    """Numbers for the blocks a task makes: no other task of the same job gives one of them."""
    n = (TaskContext.get().partitionId() if TaskContext.get() else 0) << _BLOCK_BITS
    while True:
        yield n
        n += 1


class Codes(dict):
    """Numbers for keys in the order of their first use."""

    def __missing__(self, key):
        code = self[key] = len(self)
        return code


def pack_bytes(values: list[bytes]) -> bytes:
    """Byte strings in one value: the packed lengths' size, the packed lengths, the bytes."""
    sizes = pack(np.fromiter(map(len, values), np.uint32, len(values)))
    body = zstandard.ZstdCompressor(level=12).compress(b"".join(values))
    return len(sizes).to_bytes(4, "little") + sizes + body


def unpack_bytes(packed: bytes) -> list[bytes]:
    start = 4 + int.from_bytes(packed[:4], "little")
    ends = np.cumsum(unpack(packed[4:start]), dtype=np.int64).tolist()
    body = zstandard.ZstdDecompressor().decompress(packed[start:])
    return [body[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches [start, start + size) of ``flat``, one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
