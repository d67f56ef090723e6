"""Whole texts in blocks of some megabytes, named by their content and packed for a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shelfsight.llm import textscan
from shelfsight.llm.packing import expand, squeeze

BLOCK_BYTES = 8 << 20
TEXTS = "block long, size long, ids binary, ends binary, texts binary"

_U = np.uint64


class TextBlock:
    """Texts in a row: ids, bytes, and where each text begins and ends in them."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray):
        self.ids, self.offsets, self.data = ids, offsets, data

    def chunks(self) -> Iterator[textscan.Chunk]:
        column = pa.StringArray.from_buffers(
            len(self.ids), pa.py_buffer(self.offsets.astype(np.int32)), pa.py_buffer(self.data)
        )
        return textscan.chunks(column)

    def name(self) -> int:
        """The same texts make the same block whenever they are read again."""
        content = len(self.ids)
        for chunk in self.chunks():
            whole = textscan.window(
                textscan.prefix_hashes(chunk.data), chunk.offsets[:-1], chunk.offsets[1:]
            )
            own = self.ids[chunk.first : chunk.first + len(chunk)].view(_U)
            order = np.arange(chunk.first, chunk.first + len(chunk)).astype(_U)
            content += int(np.add.reduce(textscan.mix(whole + textscan.mix(own + textscan.mix(order)))))
        return content % (1 << 63)


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[TextBlock]:
    """Blocks of whole texts of about ``limit`` bytes each, over the batches of a task."""
    ids, sizes, parts, total = [], [], [], 0

    def close() -> TextBlock:
        offsets = np.zeros(sum(map(len, sizes)) + 1, np.int64)
        np.cumsum(np.concatenate(sizes), out=offsets[1:])
        return TextBlock(np.concatenate(ids), offsets, np.concatenate(parts))

    for batch in batches:
        own = textscan.ids(batch.column("doc_id"))
        for chunk in textscan.chunks(batch.column("text")):
            ids.append(own[chunk.first : chunk.first + len(chunk)])
            sizes.append(np.diff(chunk.offsets))
            parts.append(chunk.data.copy())
            total += len(chunk.data)
            if total >= limit:
                yield close()
                ids, sizes, parts, total = [], [], [], 0
    if ids:
        yield close()


def pack_texts(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """One row per block, as in TEXTS."""
    for block in blocks(batches, limit):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block.name()], pa.int64()),
                pa.array([len(block.ids)], pa.int64()),
                pa.array([squeeze(block.ids.tobytes())], pa.binary()),
                pa.array([squeeze(block.offsets.tobytes())], pa.binary()),
                pa.array([squeeze(block.data.tobytes())], pa.binary()),
            ],
            ["block", "size", "ids", "ends", "texts"],
        )


def unpack_texts(packed: pa.Table, row: int) -> TextBlock:
    n, ids, ends, texts = (packed.column(c)[row].as_py() for c in ("size", "ids", "ends", "texts"))
    offsets = np.frombuffer(expand(ends, 8 * (n + 1)), np.int64)
    data = np.frombuffer(expand(texts, int(offsets[-1])), np.uint8)
    return TextBlock(np.frombuffer(expand(ids, 8 * n), np.int64), offsets, data)
