"""Text helpers shared by the operators that work on Arrow batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = 512,
           size: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches cut to at most ``rows`` rows and ``size`` bytes of text (one row at least), each
    with its texts as UTF-8 bytes (null: empty). Bounds what a task holds besides the batch."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(at, to - at), [t or b"" for t in column.slice(at, to - at).to_pylist()]
            at = to


def tokens(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased (both only touch ASCII in bytes)."""
    return text.lower().split()


def id_crc(value) -> int:
    """crc32 of the id as text (null: the empty text)."""
    return zlib.crc32(b"" if value is None else str(value).encode())
