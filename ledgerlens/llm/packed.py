"""Compact numbers in binary columns, and rows that hold them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: four planes, or eight if one is 2^32 or more."""
    wide = 8 if len(values) and int(values.max()) >= 1 << 32 else 4
    planes = np.ascontiguousarray(values.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T)
    head = len(values).to_bytes(7, "little") + bytes([wide])
    return head + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    size, wide = int.from_bytes(raw[:7], "little"), raw[7]
    planes = pa.Codec("zstd").decompress(raw[8:], decompressed_size=wide * size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(wide, size).T).view(f"<u{wide}").ravel()


def rows(batches):
    """Rows of record batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
