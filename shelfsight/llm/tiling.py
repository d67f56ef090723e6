"""Benchmark decontamination: greedy string tiling of documents with benchmark items.

Seeds are runs of ``MIN_TILE`` words, hashed as in Karp and Rabin. Documents and items that
share one are tiled: the longest common run of words that touches no marked word is marked,
again and again, until none of ``MIN_TILE`` words is left. The order of the tiles does not
matter, so passages that were moved about are found as well.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm import textscan
from shelfsight.llm.staging import small_batches, stage

MIN_TILE = 5
#: Documents that only share common phrases with an item stay well below.
COVERAGE = 0.6
#: Benchmarks of more bytes are joined with the documents through a shuffle of the seeds.
BROADCAST_BYTES = 16 << 20

_U = np.uint64
RESULT = "doc_id long, item_id long, item_words long, n_tiles long, covered_words long, longest_tile long, coverage double"
SEEDS = "key string, k int, seed long, times long, n_words long"
#: Keys that the documents of one item are dealt over where they meet its text.
SALTS = 16
_MASK = (1 << 20) - 1


class Item:
    """Word hashes of one benchmark text and its seeds; a short text is one seed of all its words."""

    def __init__(self, item_id: int, hashes: np.ndarray, min_tile: int):
        self.item_id, self.words = item_id, hashes
        self.tile = min(min_tile, len(hashes))


def tile_pair(
    doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """Tiles (begin in doc, begin in item, length) from the positions of all common seeds.

    Longest first; of equally long runs the one that begins first in the item, then in the
    document. Runs that lost words to a longer tile come back with what is left of them.
    """
    order = np.lexsort((at_doc, at_doc - at_item))
    at_doc, at_item = at_doc[order], at_item[order]
    # consecutive seeds on one diagonal make one run
    new = np.ones(len(at_doc), bool)
    new[1:] = (np.diff(at_doc) != 1) | (np.diff(at_item) != 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at_doc))) + least - 1
    heap = [
        (-int(n), int(i), int(d))
        for n, i, d in zip(length, at_item[begin], at_doc[begin], strict=True)
        if np.array_equal(doc[d : d + n], item[i : i + n])
    ]
    heapq.heapify(heap)
    doc_marked, item_marked = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    tiles = []
    while heap:
        n, i, d = heapq.heappop(heap)
        n = -n
        free = ~(doc_marked[d : d + n] | item_marked[i : i + n])
        if free.all():
            doc_marked[d : d + n] = item_marked[i : i + n] = True
            tiles.append((d, i, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for low, high in zip(edges[::2], edges[1::2], strict=True):
            if high - low >= least:
                heapq.heappush(heap, (-int(high - low), i + int(low), d + int(low)))
    return tiles


def _items(ids: list[int], texts: list[str | None], min_tile: int) -> list[Item]:
    out, at = [], 0
    for chunk in textscan.chunks(pa.array(texts, pa.string())):
        found = textscan.words(chunk, lower=True)
        for d in range(len(chunk)):
            own = found.hash[found.of[d] : found.of[d + 1]]
            if len(own):
                out.append(Item(ids[at + d], own, min_tile))
        at += len(chunk)
    return out


def _windows(hashes: np.ndarray, k: int) -> np.ndarray:
    found = textscan.Words(hashes, hashes, np.array([0, len(hashes)]), hashes)
    return textscan.grams(found, k)[0]


def _result(doc_id: int, item: Item, tiles: list[tuple[int, int, int]], threshold: float):
    covered = sum(n for _, _, n in tiles)
    coverage = covered / len(item.words)
    if coverage >= threshold:
        longest = max(n for _, _, n in tiles)
        return (doc_id, item.item_id, len(item.words), len(tiles), covered, longest, coverage)
    return None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    types = [pa.int64()] * 6 + [pa.float64()]
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


class Index:
    """Every seed of some items, sorted by hash, with a bit table that most words fail."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.lengths = sorted({i.tile for i in items})
        self.tables = {}
        for k in self.lengths:
            mine = [(n, _windows(i.words, k)) for n, i in enumerate(items) if i.tile == k]
            seeds = np.concatenate([w for _, w in mine])
            owner = np.concatenate([np.full(len(w), n) for n, w in mine])
            place = np.concatenate([np.arange(len(w)) for _, w in mine])
            order = np.argsort(seeds, kind="stable")
            bits = np.zeros(_MASK + 1, bool)
            bits[(seeds & _U(_MASK)).astype(np.int64)] = True
            self.tables[k] = (seeds[order], owner[order], place[order], bits)

    def hits(self, found: textscan.Words, k: int):
        """(document, item, word in the document, word in the item) of every common seed."""
        seeds, owner, place, bits = self.tables[k]
        hashes, of = textscan.grams(found, k)
        at = np.flatnonzero(bits[(hashes & _U(_MASK)).astype(np.int64)])
        low = np.searchsorted(seeds, hashes[at], "left")
        count = np.searchsorted(seeds, hashes[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        doc = np.searchsorted(of, at, "right") - 1
        word = at - of[doc]
        entry = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.repeat(doc, count), owner[entry], np.repeat(word, count), place[entry]


def _scan(
    batches: Iterator[pa.RecordBatch], index: Index, threshold: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for chunk in textscan.chunks(batch.column("text")):
            found = textscan.words(chunk, lower=True)
            for k in index.lengths:
                doc, item, word, place = index.hits(found, k)
                if len(doc) == 0:
                    continue
                order = np.lexsort((item, doc))
                doc, item, word, place = doc[order], item[order], word[order], place[order]
                cut = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
                for low, high in zip([0, *cut], [*cut, len(doc)], strict=True):
                    d, entry = int(doc[low]), index.items[item[low]]
                    # seeds of the item that occur at all bound what tiles can cover
                    seen = np.zeros(len(entry.words) + 1, np.int64)
                    np.add.at(seen, place[low:high], 1)
                    np.add.at(seen, place[low:high] + k, -1)
                    if (np.cumsum(seen)[:-1] > 0).sum() < threshold * len(entry.words):
                        continue
                    own = found.hash[found.of[d] : found.of[d + 1]]
                    tiles = tile_pair(own, entry.words, word[low:high], place[low:high], k)
                    if tiles and (row := _result(ids[chunk.first + d], entry, tiles, threshold)):
                        rows.append(row)
        yield _batch(rows)


def _seed_rows(
    batches: Iterator[pa.RecordBatch], lengths: tuple[int, ...], own_only: bool
) -> Iterator[pa.RecordBatch]:
    """One row per text and distinct seed of each of some lengths, with the times it occurs.

    ``own_only``: of these only the last one, or all words of a text that has no more.
    """
    for batch in batches:
        keys = batch.column("key")
        for chunk in textscan.chunks(batch.column("text")):
            found = textscan.words(chunk, lower=True)
            for k in lengths:
                hashes, of = textscan.grams(found, k)
                for d in range(len(chunk)):
                    n = int(found.of[d + 1] - found.of[d])
                    own, times = textscan.counted(hashes[of[d] : of[d + 1]])
                    if len(own) and not (own_only and k != min(n, lengths[-1])):
                        key = keys[chunk.first + d].as_py()
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([key] * len(own), pa.string()),
                                pa.array(np.full(len(own), k, np.int32)),
                                pa.array(own.view(np.int64)),
                                pa.array(np.asarray(times, np.int64)),
                                pa.array(np.full(len(own), n, np.int64)),
                            ],
                            [c.split()[0] for c in SEEDS.split(", ")],
                        )


def _tile_rows(
    batches: Iterator[pa.RecordBatch], min_tile: int, threshold: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, item_id, item_text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            index = Index(_items([item_id], [item_text], min_tile))
            one = pa.RecordBatch.from_pydict({"doc_id": [doc_id], "text": [text]})
            for out in _scan(iter([one]), index, threshold):
                rows += [tuple(r.values()) for r in out.to_pylist()]
        yield _batch(rows)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    threshold: float = COVERAGE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document and benchmark item whose tiles cover ``threshold`` of the item's words.

    Columns: doc_id, item_id, item_words, n_tiles, covered_words, longest_tile, coverage.
    Words are folded A to Z. An item of fewer than ``min_tile`` words is matched as a whole.
    Null and empty texts or items match nothing; rows that are repeated give repeated rows;
    further columns are not read. An empty table on either side gives an empty table.

    A benchmark of at most ``broadcast_bytes`` (measured first) is shipped to the tasks that
    scan the documents, so nothing is shuffled. A larger one is joined by seed hash, which
    gives the same rows: see ``_joined``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null"
    )
    small_batches(docs.sparkSession)
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        rows = items.collect()
        entries = _items([r[0] for r in rows], [r[1] for r in rows], min_tile)
        index = Index(entries) if entries else None
        if index is None:
            return docs.sparkSession.createDataFrame([], RESULT)
        return docs.mapInArrow(partial(_scan, index=index, threshold=threshold), RESULT)

    keyed = docs.withColumn("key", _content("doc_id"))
    kept = items.withColumnRenamed("text", "item_text").withColumn("item_key", _content("item_id", "item_text"))
    pairs = _joined(keyed, kept, min_tile, threshold)
    salted = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = (
        pairs.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        .join(keyed, "key")
        .join(salted, ["item_key", "salt"])
        .select("doc_id", "text", "item_id", "item_text")
    )
    return both.mapInArrow(partial(_tile_rows, min_tile=min_tile, threshold=threshold), RESULT)


def _content(id_name: str, text: str = "text") -> Column:
    """A key that rows share if they are equal in id and text, null or not."""
    parts = (F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in (id_name, text))
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _joined(docs: DataFrame, items: DataFrame, min_tile: int, threshold: float) -> DataFrame:
    """(key, item_key) of every document and item whose tiles may cover enough of the item.

    A tile covers at most the words of the seeds in it, so a document that covers enough
    shares at least ``threshold * n_words / k`` of the item's seed positions. Leaving out
    fewer positions than that, it still shares one of the others: an item only asks by its
    rarest seeds among all documents, and a phrase that a third of both sides share is left
    out unless the item has little else.
    """
    every = partial(_seed_rows, lengths=tuple(range(1, min_tile + 1)), own_only=True)
    of_items = stage(
        items.select(F.col("item_key").alias("key"), F.col("item_text").alias("text"))
        .distinct()
        .mapInArrow(every, SEEDS)
    )
    lengths = tuple(sorted(r.k for r in of_items.select("k").distinct().collect()))
    found = (
        docs.select("key", "text")
        .mapInArrow(partial(_seed_rows, lengths=lengths, own_only=False), SEEDS)
        .select("key", "k", "seed")
        .join(of_items.select("k", "seed").distinct(), ["k", "seed"], "left_semi")
    )
    found = stage(found)
    common = found.groupBy("k", "seed").agg(F.count(F.lit(1)).alias("common"))
    own = Window.partitionBy("key")
    rarest = own.orderBy("common", "seed").rowsBetween(Window.unboundedPreceding, -1)
    positions, before = F.sum("times").over(own), F.coalesce(F.sum("times").over(rarest), F.lit(0))
    shared = F.greatest(F.ceil(F.col("n_words") * threshold / F.col("k") - 1e-9), F.lit(1))
    asking = (
        of_items.join(common, ["k", "seed"], "left")
        .withColumn("common", F.coalesce("common", F.lit(0)))
        .withColumns({"positions": positions, "before": before})
        .where(F.col("before") <= F.col("positions") - shared)
        .select("k", "seed", F.col("key").alias("item_key"))
    )
    return found.join(asking, ["k", "seed"]).select("key", "item_key").distinct()


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that cover no benchmark item; rows without doc_id stay."""
    leaking = find_leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaking, "doc_id", "left_anti").select(*docs.columns)
