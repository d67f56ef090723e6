"""Stupid-backoff scores: counts of all n-grams by hash bucket, joined back and summed per text.

Texts are taken in blocks of some megabytes. A block sends its distinct n-grams with their
counts to hash buckets; a bucket adds up the counts of all blocks and returns them to those
that asked. Nothing but these count tables is gathered, they are partitioned by hash, and
no table is held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfsight.llm import textscan
from shelfsight.llm.packing import (
    bucket_count, bucket_edges, pack_counts, pack_keys, unpack_counts, unpack_keys,
)
from shelfsight.llm.staging import small_batches
from shelfsight.llm.textblocks import (
    BLOCK_BYTES, TEXTS, TextBlock, blocks, pack_texts, unpack_texts,
)

ORDER = 3
ALPHA = 0.4

_U = np.uint64
_ALL = textscan.mix(np.array([12345], _U))[0]  # the key that counts every word
_REQUEST = "bucket int, block long, n int, keys binary, counts binary"
_ANSWER = "block long, bucket int, n int, counts binary"
RESULT = "doc_id long, n_words long, n_known long, log_score double, mean_log_score double"


class WordBlock:
    """The hashed words of a block of texts; text d has the words [of[d], of[d + 1])."""

    def __init__(self, block: TextBlock):
        self.ids = block.ids
        hashes, starts, at = [], [np.zeros(1, np.int64)], 0
        for chunk in block.chunks():
            found = textscan.words(chunk, lower=False)
            hashes.append(found.hash)
            starts.append(found.of[1:] + at)
            at += len(found.hash)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, _U)
        self.of = np.concatenate(starts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the k-grams by the word they end at, and where there is one."""
        words = textscan.Words(self.of, self.of, self.of, self.hash)
        keys, of = textscan.grams(words, k)
        has = np.zeros(len(self.hash), bool)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(of))
        has[np.arange(len(keys)) - of[doc] + self.of[doc] + k - 1] = True
        return textscan.mix(keys + _U(k)), has


def _keys(block: WordBlock, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    return [block.grams(k) for k in range(1, order + 1)]


def _ask(
    batches: Iterator[pa.RecordBatch], order: int, buckets: int, limit: int
) -> Iterator[pa.RecordBatch]:
    for texts in blocks(batches, limit):
        block = WordBlock(texts)
        if len(block.hash) == 0:
            continue
        keys, counts = textscan.counted(np.concatenate([k for k, _ in _keys(block, order)]))
        at = int(np.searchsorted(keys, _ALL))
        keys, counts = np.insert(keys, at, _ALL), np.insert(counts, at, len(block.hash))
        edges = bucket_edges(keys, buckets)
        used = np.flatnonzero(np.diff(edges))
        cut = [(edges[b], edges[b + 1]) for b in used]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(np.full(len(used), texts.name())),
                pa.array([h - l for l, h in cut], pa.int32()),
                pa.array([pack_keys(keys[l:h]) for l, h in cut], pa.binary()),
                pa.array([pack_counts(counts[l:h]) for l, h in cut], pa.binary()),
            ],
            [c.split()[0] for c in _REQUEST.split(", ")],
        )


def _answer(asked: pa.Table) -> pa.Table:
    """The counts of a bucket over all blocks, for each block in the order it asked."""
    sizes = asked.column("n").to_pylist()
    keys = [unpack_keys(k, n) for k, n in zip(asked.column("keys").to_pylist(), sizes, strict=True)]
    counts = [unpack_counts(c, n) for c, n in zip(asked.column("counts").to_pylist(), sizes, strict=True)]
    table, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(table)).astype(np.int64)[place]
    answers = np.split(total, np.cumsum(sizes)[:-1])
    return pa.table(
        {
            "block": asked.column("block"),
            "bucket": asked.column("bucket"),
            "n": asked.column("n"),
            "counts": pa.array([pack_counts(a) for a in answers], pa.binary()),
        }
    )


def _score(texts: pa.Table, answers: pa.Table, order: int, alpha: float) -> pa.Table:
    answers = answers.sort_by("bucket")
    counts = [
        unpack_counts(c, n)
        for c, n in zip(answers.column("counts").to_pylist(), answers.column("n").to_pylist(), strict=True)
    ]
    out = []
    same = len(texts)  # more than one only if a table holds the same ids and texts twice
    for i in range(same):
        own = counts[i::same]
        block = WordBlock(unpack_texts(texts, i))
        out.append(_score_block(block, np.concatenate(own) if own else None, order, alpha))
    return pa.Table.from_batches(out)


def _score_block(block: WordBlock, counts: np.ndarray | None, order: int, alpha: float) -> pa.RecordBatch:
    n_docs, n = len(block.ids), len(block.hash)
    words = np.diff(block.of)
    score, known = np.zeros(n), np.zeros(n, bool)
    if n:
        keys = _keys(block, order)
        # where each n-gram, one order after the other, stands in the sorted keys
        table, place_of = np.unique(
            np.concatenate([k for k, _ in keys] + [np.array([_ALL], _U)]), return_inverse=True
        )
        if counts is None or len(counts) != len(table):
            raise RuntimeError("the texts were read in other blocks than before; stage them first")
        total = int(counts[place_of[-1]])
        doc = np.repeat(np.arange(n_docs), words)
        place = np.arange(n) - block.of[doc]
        longest = np.minimum(place + 1, order)
        others = []  # for each order, how often other texts hold the n-gram that ends here
        begin = 0
        for key, has in keys:
            at = place_of[begin : begin + len(key)]
            begin += len(key)
            # an n-gram that occurs once is in this text only
            several = counts[at] > 1
            words_at = np.flatnonzero(has)[several]
            at = at[several]
            _, inverse, own = np.unique(
                doc[words_at] * len(table) + at, return_inverse=True, return_counts=True
            )
            elsewhere = np.zeros(n, np.int64)
            elsewhere[words_at] = counts[at] - own[inverse]
            others.append(elsewhere)
        left = np.maximum(total - words, 1)[doc].astype(float)
        open_ = np.ones(n, bool)
        for k in range(order, 1, -1):
            seen = open_ & (others[k - 1] > 0)
            at = np.flatnonzero(seen)
            score[at] = (
                np.log(others[k - 1][at])
                - np.log(others[k - 2][at - 1])
                + (longest[at] - k) * np.log(alpha)
            )
            known |= seen
            open_ &= ~seen
        at = np.flatnonzero(open_)
        single = others[0][at]
        score[at] = (
            np.log(np.maximum(single, 1))
            - np.log(left[at])
            + (longest[at] - (single > 0)) * np.log(alpha)
        )
        known[at] |= single > 0
    log_score = np.array([score[a:b].sum() for a, b in zip(block.of[:-1], block.of[1:], strict=True)])
    n_known = np.diff(np.concatenate(([0], np.cumsum(known)))[block.of])
    mean = np.divide(log_score, words, out=np.zeros(n_docs), where=words > 0)
    return pa.RecordBatch.from_arrays(
        [
            textscan.id_array(block.ids),
            pa.array(words.astype(np.int64)),
            pa.array(n_known.astype(np.int64)),
            pa.array(log_score),
            pa.array(mean, mask=words == 0),
        ],
        [c.split()[0] for c in RESULT.split(", ")],
    )


def score_texts(
    docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Score every text by the n-grams of all the other texts.

    One row per row of ``docs``: doc_id, n_words, n_known (words that another text holds),
    log_score (sum over the words of the natural logarithm of their score) and its mean,
    null without words. A word's score is the relative frequency c(n-gram) / c(context) of
    the longest n-gram ending there that occurs elsewhere, times ``alpha`` for each shorter
    order tried; single words are divided by the number of all other words, and a word that
    occurs nowhere else counts 1 after one more step. A text's own counts are taken off
    before, so it is not scored by itself; its copies do count.

    Words are runs without white space, taken as they are. Null and empty texts have no
    words and score 0. Null ids stay null, repeated rows are scored like copies. An empty
    table gives an empty table; further columns are not read. ``docs`` is read twice and must come in the
    same order both times, as from stored files; else the run fails and says so.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    small_batches(docs.sparkSession)
    buckets = bucket_count(docs.sparkSession)
    asked = docs.mapInArrow(
        partial(_ask, order=order, buckets=buckets, limit=block_bytes), _REQUEST
    )
    answers = asked.groupBy("bucket").applyInArrow(_answer, _ANSWER)
    texts = docs.mapInArrow(partial(pack_texts, limit=block_bytes), TEXTS)

    def score(one: pa.Table, two: pa.Table) -> pa.Table:
        return _score(one, two, order, alpha)

    return (
        texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, RESULT)
    )
