"""Arrays as one compressed value, for rows that hold a block of data each."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays end to end, small whole numbers in the narrowest type that holds them, by planes of
    bytes (high bytes of sorted or small numbers repeat), compressed."""
    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        if a.dtype.kind in "iu" and len(a) and a.min() >= 0 and a.max() < 1 << 32:  # hashes stay signed
            a = a.astype(np.min_scalar_type(a.max()))
        head.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        body.append(np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + body))


def unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n, at = data[0], 1 + data[0] * struct.calcsize("<2sQ")
    out = []
    for kind, size in struct.iter_unpack("<2sQ", data[1:at]):
        dtype = np.dtype(kind.decode())
        planes = np.frombuffer(data, np.uint8, size * dtype.itemsize, at).reshape(dtype.itemsize, -1)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(-1) if size else np.zeros(0, dtype))
        at += dtype.itemsize * size
    return out
