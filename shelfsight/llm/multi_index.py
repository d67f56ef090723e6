"""Nearest neighbours by an inverted multi-index over two separately quantised vector halves.

A cell is a pair of centroids, one per half. A query walks the cells from the largest sum of
its two inner products downwards with a heap, until the cells seen hold a share of all
vectors, and reranks their entries on the original vectors. The share is fitted with the
centroids on a bounded sample, so that it suits the data: small for clustered vectors, large
for vectors without structure, which no index can prune.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.staging import stage

#: Vectors that centroids and share are fitted on, and how many of them are asked for it.
SAMPLE, ASKED = 20_000, 300
#: Share of the true neighbours in the sample that the cells walked must hold.
SAMPLE_RECALL = 0.97
#: Centroids of a half at most; the table of cell sizes has at most the square of it.
MOST_CENTROIDS = 256
#: Vectors of a shard and queries of a block, about.
SHARD, BLOCK = 8192, 512

_ENCODED = "vec_id long, cell int, vector array<double>"
_SHARDS = "shard int, size int, ids binary, cells binary, vectors binary"
_REQUESTS = "shard int, n int, query_ids binary, queries binary, cells binary"
_FOUND = "query_id long, vec_id long, score double"


@dataclass
class Codebook:
    """Centroids of both halves and the share of all vectors that a query walks."""

    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        one = _nearest(vectors[:, : self.half], self.first)
        return one * len(self.second) + _nearest(vectors[:, self.half :], self.second)

    def walk(self, query: np.ndarray, sizes: np.ndarray, wanted: float) -> np.ndarray:
        """Cells in falling order of summed inner product, until they hold ``wanted`` vectors.

        Both lists are sorted once; a pair enters the heap when its neighbours in both lists
        have left it, so only the walked front is ever held.
        """
        one, two = self.first @ query[: self.half], self.second @ query[self.half :]
        by_one, by_two = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        one, two = one[by_one], two[by_two]
        width, held, cells = len(two), 0, []
        reached = np.zeros(len(one), np.int64)  # pairs (i, 0 .. reached[i] - 1) have left
        heap = [(-(one[0] + two[0]), 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            cell = int(by_one[i]) * width + int(by_two[j])
            reached[i] = j + 1
            if sizes[cell]:
                cells.append(cell)
                held += int(sizes[cell])
                if held >= wanted:
                    break
            if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if i + 1 < len(one) and reached[i + 1] == j:
                heapq.heappush(heap, (-(one[i + 1] + two[j]), i + 1, j))
        return np.array(cells, np.int32)


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    norms = (centroids**2).sum(1)
    for low in range(0, len(points), 4096):
        out[low : low + 4096] = (norms - 2 * points[low : low + 4096] @ centroids.T).argmin(1)
    return out


def _centroids(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    distinct = np.unique(points, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(12):
        near = _nearest(points, centroids)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
    return centroids


def fit(sample: np.ndarray, n_all: int, neighbours: int, seed: int = 5) -> Codebook:
    """Centroids by k-means, and the share by asking for some sample vectors' true neighbours."""
    rng = np.random.default_rng(seed)
    k = int(min(MOST_CENTROIDS, max(4, 2 * n_all**0.3)))
    half = max(1, sample.shape[1] // 2)
    book = Codebook(
        _centroids(sample[:, :half], k, rng), _centroids(sample[:, half:], k, rng), 1.0
    )
    cells = book.encode(sample)
    sizes = np.bincount(cells, minlength=len(book.first) * len(book.second))
    needed = []
    for q in range(min(ASKED, len(sample))):
        scores = sample @ sample[q]
        scores[q] = -np.inf
        best = np.argsort(-scores, kind="stable")[: min(neighbours, len(sample) - 1)]
        order = book.walk(sample[q], sizes, np.inf)
        held = np.zeros(len(sizes))
        held[order] = np.cumsum(sizes[order])
        needed.append(held[cells[best]] / len(sample))
    needed = np.concatenate(needed) if needed else np.ones(1)
    if len(needed):
        book.share = float(np.quantile(needed, SAMPLE_RECALL))
    return book


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _encode(batches: Iterator[pa.RecordBatch], book: Codebook) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            cells = book.encode(_matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cells, pa.int32()), batch.column("vector")],
                ["vec_id", "cell", "vector"],
            )


def _shard_table(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each cell and its number of shards; small cells share one."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, held = 0, 0
    for cell in np.flatnonzero(sizes):
        n = int(sizes[cell])
        if n > SHARD:
            shard += held > 0
            first[cell], parts[cell] = shard, -(-n // SHARD)
            shard, held = shard + int(parts[cell]), 0
            continue
        if held and held + n > SHARD:
            shard, held = shard + 1, 0
        first[cell] = shard
        held += n
    return first, parts


def _place(batches, first: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cell = batch.column("cell").to_numpy()
        ids = batch.column("vec_id").to_numpy().view(np.uint64)
        salt = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
        shard = first[cell] + salt % parts[cell]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.int32()), *batch.columns], ["shard", *batch.schema.names]
        )


def _pack(shard: pa.Table) -> pa.Table:
    shard = shard.combine_chunks().sort_by("vec_id")
    vectors = _matrix(shard.column("vector").combine_chunks())
    return pa.table(
        {
            "shard": shard.column("shard").slice(0, 1),
            "size": pa.array([len(shard)], pa.int32()),
            "ids": pa.array([shard.column("vec_id").to_numpy().tobytes()], pa.binary()),
            "cells": pa.array([shard.column("cell").to_numpy().tobytes()], pa.binary()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
        }
    )


def _request(
    batches: Iterator[pa.RecordBatch],
    book: Codebook,
    sizes: np.ndarray,
    first: np.ndarray,
    parts: np.ndarray,
    neighbours: int,
) -> Iterator[pa.RecordBatch]:
    """For each block of queries and shard with walked cells: the queries and their cells."""
    total = int(sizes.sum())
    wanted = max(book.share * total, neighbours + 1)
    n_cells = len(sizes)
    for batch in batches:
        for low in range(0, len(batch), BLOCK):
            part = batch.slice(low, BLOCK)
            ids = part.column("vec_id").to_numpy()
            queries = _matrix(part.column("vector"))
            walked = np.zeros((len(ids), n_cells), bool)
            for q, query in enumerate(queries):
                walked[q, book.walk(query, sizes, wanted)] = True
            asked = np.flatnonzero(walked.any(0))
            shards = [range(first[c], first[c] + parts[c]) for c in asked]
            for shard in sorted({s for r in shards for s in r}):
                own = asked[(first[asked] <= shard) & (shard < first[asked] + parts[asked])]
                some = walked[:, own].any(1)
                mask = np.zeros((int(some.sum()), n_cells), bool)
                mask[:, own] = walked[np.ix_(some, own)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([int(some.sum())], pa.int32()),
                        pa.array([ids[some].tobytes()], pa.binary()),
                        pa.array([queries[some].tobytes()], pa.binary()),
                        pa.array([np.packbits(mask, axis=1).tobytes()], pa.binary()),
                    ],
                    ["shard", "n", "query_ids", "queries", "cells"],
                )


def _rerank(batches: Iterator[pa.RecordBatch], n_cells: int, neighbours: int) -> Iterator[pa.RecordBatch]:
    """The nearest entries of a shard for each query of a block, by exact inner product."""
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            n, size = row["n"], row["size"]
            ids, cells = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["shard_cells"], np.int32)
            vectors = np.frombuffer(row["vectors"], np.float64).reshape(size, -1)
            query_ids = np.frombuffer(row["query_ids"], np.int64)
            queries = np.frombuffer(row["queries"], np.float64).reshape(n, -1)
            walked = np.unpackbits(
                np.frombuffer(row["cells"], np.uint8).reshape(n, -1), axis=1, count=n_cells
            ).astype(bool)
            scores = queries @ vectors.T
            scores[~walked[:, cells] | (query_ids[:, None] == ids[None, :])] = -np.inf
            out = [[], [], []]
            for q in range(n):
                # ids are sorted, so a stable order leaves ties to the smaller one
                if size > 4 * neighbours:
                    least = -np.partition(-scores[q], neighbours - 1)[neighbours - 1]
                    some = np.flatnonzero(scores[q] >= least)
                else:
                    some = np.arange(size)
                some = some[np.argsort(-scores[q, some], kind="stable")][:neighbours]
                some = some[np.isfinite(scores[q, some])]
                out[0].append(np.full(len(some), query_ids[q]))
                out[1].append(ids[some])
                out[2].append(scores[q, some])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(out[0]), pa.int64()),
                    pa.array(np.concatenate(out[1]), pa.int64()),
                    pa.array(np.concatenate(out[2]), pa.float64()),
                ],
                ["query_id", "vec_id", "score"],
            )


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part.

    Out are rows whose id or vector is null, vectors with a null or non-finite component,
    zero vectors, and vectors that have not the commonest length (of equally common ones
    the shorter).
    """
    fine = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall(
            "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
        )
        & F.exists("vector", lambda x: x != 0)
    )
    common = fine.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return fine.where(F.size("vector") == (common.n if common else 0))


def nearest(vectors: DataFrame, queries: DataFrame, neighbours: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest other vectors that the walk finds.

    ``vectors`` has vec_id and embedding, ``queries`` vec_ids of it. Nearness is the inner
    product in double precision, ties go to the smaller vec_id, ranks begin at 1. Vectors
    as left out by ``usable`` are neither queries nor candidates. Rows that repeat a vec_id
    are candidates each, but a query is asked once and never finds its own id. Without
    usable vectors or queries the result is empty; further columns are not read.

    Cells are dealt to shards of about SHARD vectors, large ones to several, so identical
    vectors in any number are no hot group. Blocks of queries are joined to the shards they
    walk; every pair of block and shard gives its best, of which the best are kept.
    """
    spark = vectors.sparkSession
    fine = usable(vectors)
    n_all = fine.count()
    if n_all == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = fine.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(SAMPLE).collect()
    book = fit(np.array([r[0] for r in rows]), n_all, neighbours)
    n_cells = len(book.first) * len(book.second)

    encoded = stage(fine.mapInArrow(partial(_encode, book=book), _ENCODED))
    sizes = np.zeros(n_cells, np.int64)
    for cell, n in encoded.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        sizes[cell] = n
    first, parts = _shard_table(sizes)
    shards = (
        encoded.mapInArrow(partial(_place, first=first, parts=parts), f"shard int, {_ENCODED}")
        .groupBy("shard")
        .applyInArrow(_pack, _SHARDS)
        .withColumnRenamed("cells", "shard_cells")
    )
    asked = encoded.join(queries.select("vec_id").distinct(), "vec_id", "left_semi")
    request = partial(
        _request, book=book, sizes=sizes, first=first, parts=parts, neighbours=neighbours
    )
    requests = asked.dropDuplicates(["vec_id"]).select("vec_id", "vector").mapInArrow(request, _REQUESTS)
    found = requests.join(shards, "shard").mapInArrow(
        partial(_rerank, n_cells=n_cells, neighbours=neighbours), _FOUND
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", "vec_id", "score")
    )


