"""Exact removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Only the first ``WINDOW`` bytes of a suffix matter here. Texts are worked on in blocks:

1. Cover sample, a filter. Positions whose remainder by the cover's modulus is in a
   difference cover ask, by a 64-bit hash of their next bytes, whether these occur twice. For
   two equal windows at any two positions some offset below the modulus brings both to sample
   positions, so a window without a repeated sample is alone.
2. Suffix buckets. The windows that are left go to the bucket of the least hash of their
   32-byte strings, so that equal windows meet and neighbours mostly go together: a stretch
   of neighbours is sent as one run of bytes, once per block. Each bucket puts its distinct
   runs one behind the other and sorts their suffixes by bytes (``suffix_sort``): first by a
   short prefix, then, where that ties, by ranks of a cover sample that are worked out
   beforehand. Neighbours in that order are compared byte by byte, so that hashes decide only
   where windows meet, never whether they are equal.

The number of buckets follows the bytes, so a bucket's memory does not grow with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import textscan
from shelfsight.llm.packing import (
    bucket_count, bucket_edges, expand, pack_keys, squeeze, unpack_keys,
)
from shelfsight.llm.staging import discard, small_batches, stage
from shelfsight.llm.suffix_sort import difference_cover, repeated
from shelfsight.llm.textblocks import TEXTS, TextBlock, pack_texts, unpack_texts

WINDOW = 200
BLOCK_BYTES = 4 << 20
#: Bytes that a bucket is asked about, about, and bytes of the strings whose hashes pick it.
BUCKET_BYTES = 4 << 20
PICK_BYTES = 32

_U = np.uint64
_ASK = "bucket int, block long, n int, keys binary, twice binary"
_ANSWER = "block long, bucket int, n int, twice binary"
_PACKED = TEXTS + ", packed long"
_RUNS = "bucket int, block long, n int, lengths binary, twice binary, texts binary"
_PIECES = "block long, size long, places binary, texts binary, bytes long"
_RANGES = "block long, size long, ranges binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _layout(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of some texts: its place in its text, and the bytes left from it on."""
    sizes = np.diff(offsets)
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes)
    return place, np.repeat(sizes, sizes) - place


def _samples(block: TextBlock, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the block of the cover samples, and the hashes of their bytes."""
    v, cover = difference_cover(window)
    chosen = np.zeros(v, bool)
    chosen[list(cover)] = True
    width = window - v + 1
    positions, hashes = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    for chunk in block.chunks():
        place, left = _layout(chunk.offsets)
        at = np.flatnonzero(chosen[place % v] & (left >= width))
        hashes.append(textscan.window(textscan.prefix_hashes(chunk.data), at, at + width))
        positions.append(at + block.offsets[chunk.first])
    return np.concatenate(positions), np.concatenate(hashes)


def _requests(name: int, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    keys, counts = textscan.counted(hashes)
    edges = bucket_edges(keys, buckets)
    used = np.flatnonzero(np.diff(edges))
    cut = [(edges[b], edges[b + 1]) for b in used]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used, pa.int32()),
            pa.array(np.full(len(used), name), pa.int64()),
            pa.array([h - l for l, h in cut], pa.int32()),
            pa.array([pack_keys(keys[l:h]) for l, h in cut], pa.binary()),
            pa.array([squeeze(np.packbits(counts[l:h] > 1).tobytes()) for l, h in cut], pa.binary()),
        ],
        ["bucket", "block", "n", "keys", "twice"],
    )


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(expand(packed, (n + 7) // 8), np.uint8), count=n).astype(bool)


def _pack(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in pack_texts(batches, limit):
        yield batch.append_column("packed", pa.array([batch.nbytes], pa.int64()))


def _ask_samples(
    batches: Iterator[pa.RecordBatch], window: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            _, hashes = _samples(unpack_texts(batch, row), window)
            if len(hashes):
                yield _requests(batch.column("block")[row].as_py(), hashes, buckets)


def _answer(asked: pa.Table) -> pa.Table:
    """Which keys of a bucket occur twice, for each block in the order it asked."""
    sizes = asked.column("n").to_pylist()
    keys = [unpack_keys(k, n) for k, n in zip(asked.column("keys").to_pylist(), sizes, strict=True)]
    twice = [_bits(t, n) for t, n in zip(asked.column("twice").to_pylist(), sizes, strict=True)]
    table, place, seen = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    more = seen > 1
    more[place[np.concatenate(twice)]] = True
    flags = np.split(more[place], np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": asked.column("block"),
            "bucket": asked.column("bucket"),
            "n": asked.column("n"),
            "twice": pa.array([squeeze(np.packbits(f).tobytes()) for f in flags], pa.binary()),
        }
    )


def _told(answers: pa.Table, turn: int, same: int) -> np.ndarray:
    """What the buckets, in order, told the block ``turn`` of the ``same`` equal ones of its name."""
    flags = [
        _bits(t, n)
        for t, n in zip(
            answers.column("twice").to_pylist()[turn::same],
            answers.column("n").to_pylist()[turn::same],
            strict=True,
        )
    ]
    return np.concatenate(flags) if flags else np.zeros(0, bool)


def _answered(answers: pa.Table, turn: int, same: int, hashes: np.ndarray) -> np.ndarray:
    """For each hash of a block whether it occurs twice in all texts."""
    return _told(answers, turn, same)[np.searchsorted(textscan.distinct(hashes), hashes)]


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _candidates(texts: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    """The stretches of a block that hold every window with a repeated sample."""
    v, _ = difference_cover(window)
    answers, same, out = answers.sort_by("bucket"), len(texts), []
    for turn in range(same):
        block = unpack_texts(texts, turn)
        positions, hashes = _samples(block, window)
        at = positions[_answered(answers, turn, same, hashes)]
        doc = np.searchsorted(block.offsets, at, "right") - 1
        low = np.maximum(at - v + 1, block.offsets[doc])
        high = np.minimum(at, block.offsets[doc + 1] - window)
        low, high = low[low <= high], high[low <= high]
        # bytes of these windows; windows of two texts never overlap, but may touch
        change = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(change, low, 1)
        np.add.at(change, high + window, -1)
        covered = np.cumsum(change[:-1]) > 0
        begin, end = _split(*_runs(covered), block.offsets)
        if len(begin) == 0:
            continue
        doc = np.searchsorted(block.offsets, begin, "right") - 1
        places = np.stack([doc, begin - block.offsets[doc], end - begin]).astype(np.int64)
        pieces = block.data[covered]
        out.append(
            (
                texts.column("block")[turn].as_py(),
                len(begin),
                squeeze(places.tobytes()),
                squeeze(pieces.tobytes()),
                len(pieces),
            )
        )
    names = [c.split()[0] for c in _PIECES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    columns = list(zip(*out, strict=True)) if out else [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _split(
    begin: np.ndarray, end: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Cut runs where one text ends and the next begins."""
    inside = offsets[1:-1]
    run = np.searchsorted(begin, inside, "right") - 1
    ok = run >= 0
    inside, run = inside[ok], run[ok]
    cuts = np.unique(inside[(inside > begin[run]) & (inside < end[run])]) if len(begin) else inside[:0]
    return np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))


def _pieces(table: pa.Table | pa.RecordBatch, row: int) -> tuple[np.ndarray, TextBlock]:
    n = table.column("size")[row].as_py()
    places = np.frombuffer(expand(table.column("places")[row].as_py(), 24 * n), np.int64).reshape(3, n)
    offsets = np.concatenate(([0], np.cumsum(places[2])))
    data = np.frombuffer(expand(table.column("texts")[row].as_py(), int(offsets[-1])), np.uint8)
    return places, TextBlock(np.arange(n), offsets, data)


def _stretches(block: TextBlock, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with the same least hash: first window, how many, the hash."""
    pick = max(1, min(PICK_BYTES, window // 4))
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U))]
    for chunk in block.chunks():
        _, left = _layout(chunk.offsets)
        at = np.flatnonzero(left >= window)
        if len(at) == 0:
            continue
        start = np.arange(len(chunk.data) - pick + 1)
        least = textscan.window(textscan.prefix_hashes(chunk.data), start, start + pick)
        span, strings = 1, window - pick + 1
        while 2 * span <= strings:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = strings - span
        least = np.minimum(least[: len(least) - rest], least[rest:])[at]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])
        begin = np.flatnonzero(first)
        counts = np.diff(np.append(begin, len(at)))
        out.append((at[begin] + block.offsets[chunk.first], counts, least[begin]))
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


class _Runs:
    """The distinct runs of a block in the order of their buckets, and where its windows are in them."""

    def __init__(self, block: TextBlock, window: int, buckets: int):
        begin, counts, least = _stretches(block, window)
        raw, seen = block.data.tobytes(), {}
        which = np.array(
            [
                seen.setdefault(raw[b : b + c + window - 1], len(seen))
                for b, c in zip(begin.tolist(), counts.tolist(), strict=True)
            ],
            np.int64,
        )
        _, first, times = np.unique(which, return_index=True, return_counts=True)
        spread = textscan.mix(least[first]) >> _U(32)
        bucket = ((spread * _U(buckets)) >> _U(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        texts = list(seen)
        self.texts = [texts[i] for i in order]
        self.times, self.bucket = times[order], bucket[order]
        size = counts[first]
        place = np.zeros(len(order), np.int64)
        place[order] = np.cumsum(size[order]) - size[order]
        self.windows = _inside(place[which], counts)


def _inside(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each of ``counts``, one behind the other."""
    return np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _ask_runs(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            runs = _Runs(_pieces(batch, row)[1], window, buckets)
            used, low = np.unique(runs.bucket, return_index=True)
            cut = list(zip(low, np.append(low[1:], len(runs.bucket)), strict=True))
            lengths = np.array([len(t) for t in runs.texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int32()),
                    pa.array(np.full(len(used), batch.column("block")[row].as_py()), pa.int64()),
                    pa.array([h - l for l, h in cut], pa.int32()),
                    pa.array([squeeze(lengths[l:h].tobytes()) for l, h in cut], pa.binary()),
                    pa.array([squeeze(np.packbits(runs.times[l:h] > 1).tobytes()) for l, h in cut], pa.binary()),
                    pa.array([squeeze(b"".join(runs.texts[l:h])) for l, h in cut], pa.binary()),
                ],
                [c.split()[0] for c in _RUNS.split(", ")],
            )


def _sorted_bucket(asked: pa.Table, window: int) -> pa.Table:
    """Which windows of a bucket's runs begin twice, for each block in the order it asked."""
    seen, which, many = {}, [], []
    for row in range(len(asked)):
        n, lengths, twice, texts = (asked.column(c)[row].as_py() for c in ("n", "lengths", "twice", "texts"))
        ends = np.cumsum(np.frombuffer(expand(lengths, 8 * n), np.int64)).tolist()
        raw, low, own = expand(texts, ends[-1]), 0, []
        for high in ends:
            own.append(seen.setdefault(raw[low:high], len(seen)))
            low = high
        which.append(np.array(own, np.int64))
        many.append(1 + _bits(twice, n))
    times = np.bincount(np.concatenate(which), np.concatenate(many))
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in seen]))).astype(np.int64)
    data = np.frombuffer(b"".join(seen), np.uint8)
    counts = np.diff(offsets) - window + 1
    place = np.cumsum(counts) - counts
    found = repeated(data, offsets, window) | np.repeat(times > 1, counts)
    flags = [found[_inside(place[own], counts[own])] for own in which]
    return pa.table(
        {
            "block": asked.column("block"),
            "bucket": asked.column("bucket"),
            "n": pa.array([len(f) for f in flags], pa.int32()),
            "twice": pa.array([squeeze(np.packbits(f).tobytes()) for f in flags], pa.binary()),
        }
    )


def _removed(pieces: pa.Table, answers: pa.Table, window: int, buckets: int) -> pa.Table:
    """The byte ranges to remove, as text number, begin and end in the text."""
    answers, same, out = answers.sort_by("bucket"), len(pieces), []
    for turn in range(same):
        places, block = _pieces(pieces, turn)
        twice = _told(answers, turn, same)[_Runs(block, window, buckets).windows]
        # windows back to their positions: each piece has length - window + 1 of them
        counts = np.diff(block.offsets) - window + 1
        first = np.cumsum(counts) - counts
        at = np.flatnonzero(twice)
        piece = np.searchsorted(first, at, "right") - 1
        low = at - first[piece] + block.offsets[piece]
        change = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(change, low, 1)
        np.add.at(change, low + window, -1)
        begin, end = _split(*_runs(np.cumsum(change[:-1]) > 0), block.offsets)
        piece = np.searchsorted(block.offsets, begin, "right") - 1
        shift = places[1, piece] - block.offsets[piece]
        ranges = np.stack([places[0, piece], begin + shift, end + shift]).astype(np.int64)
        if len(begin):
            out.append((pieces.column("block")[turn].as_py(), len(begin), squeeze(ranges.tobytes())))
    names = [c.split()[0] for c in _RANGES.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*out, strict=True)) if out else [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _cut(texts: pa.Table, ranges: pa.Table) -> pa.Table:
    rows = []
    for turn in range(len(texts)):
        block = unpack_texts(texts, turn)
        gone = np.zeros(len(block.data), bool)
        if turn < len(ranges):
            n = ranges.column("size")[turn].as_py()
            doc, low, high = np.frombuffer(
                expand(ranges.column("ranges")[turn].as_py(), 24 * n), np.int64
            ).reshape(3, n)
            for l, h in zip(block.offsets[doc] + low, block.offsets[doc] + high, strict=True):
                gone[l:h] = True
        for d in range(len(block.ids)):
            low, high = block.offsets[d], block.offsets[d + 1]
            own, mask = block.data[low:high], gone[low:high]
            removed = int(mask.sum())
            spans = len(_runs(mask)[0]) if removed else 0
            kept = own[~mask] if removed else own
            rows.append((len(own), removed, spans, hashlib.sha256(kept.tobytes()).hexdigest()))
        ids = textscan.id_array(block.ids)
        columns = [list(c) for c in zip(*rows, strict=True)]
        batch = pa.RecordBatch.from_arrays(
            [ids, *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
            [c.split()[0] for c in RESULT.split(", ")],
        )
        rows = []
        yield batch


def remove_repeats(docs: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """What stays of every text after all repeated strings of ``window`` bytes are removed.

    One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 of the bytes that stay. A byte goes if a string of ``window`` bytes that
    covers it also begins at any other position of any text, its own included; overlapping
    occurrences count and all are judged on the input. Matches never cross texts. Texts are
    taken as UTF-8; null and shorter texts lose nothing. Null ids stay null; a row that is
    repeated is a copy like any other. An empty table gives an empty table; further columns
    are not read. ``docs`` is read once, in any order; its packed texts are staged.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    small_batches(spark)
    least = bucket_count(spark)

    def buckets_for(table: DataFrame, size: str, share: float) -> int:
        total = table.agg(F.sum(size)).first()[0] or 0
        return max(least, int(total * share) // BUCKET_BYTES)

    def by_bucket(asked: DataFrame, buckets: int):
        return asked.repartition(buckets // 2, "bucket").groupBy("bucket")

    packed = stage(docs.mapInArrow(partial(_pack, limit=block_bytes), _PACKED))
    texts = packed.drop("packed")
    # a sample's key is 8 bytes; packed texts are some 0.4 of their size
    v, cover = difference_cover(window)
    buckets = buckets_for(packed, "packed", 8 * len(cover) / v / 0.4)

    def candidates(one: pa.Table, two: pa.Table) -> pa.Table:
        return _candidates(one, two, window)

    ranks = by_bucket(
        texts.mapInArrow(partial(_ask_samples, window=window, buckets=buckets), _ASK), buckets
    ).applyInArrow(_answer, _ANSWER)
    pieces = stage(
        texts.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(candidates, _PIECES)
    )
    # a run has some 85 windows, and so some 285 bytes
    buckets = buckets_for(pieces, "bytes", 3.3)

    def sort_bucket(asked: pa.Table) -> pa.Table:
        return _sorted_bucket(asked, window)

    def removed(one: pa.Table, two: pa.Table) -> pa.Table:
        return _removed(one, two, window, buckets)

    def cut(one: pa.Table, two: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_cut(one, two)))

    classes = by_bucket(
        pieces.mapInArrow(partial(_ask_runs, window=window, buckets=buckets), _RUNS), buckets
    ).applyInArrow(sort_bucket, _ANSWER)
    ranges = stage(
        pieces.groupBy("block").cogroup(classes.groupBy("block")).applyInArrow(removed, _RANGES)
    )
    discard(pieces)
    return texts.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(cut, RESULT)
