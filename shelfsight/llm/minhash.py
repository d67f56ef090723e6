"""MinHash near-duplicates: universal minima, bands, verification, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import textscan
from shelfsight.llm.staging import discard, small_batches, stage

HASHES = 128
#: A pair at the threshold shares no band with at most this probability.
MISSED = 1e-7
#: Pairs whose signatures agree less than at the threshold by more deviations than these are
#: not confirmed on their sets.
DEVIATIONS = 5
#: Members of a bucket that are compared at once, and bytes of their sets, about.
BLOCK, BLOCK_BYTES = 1024, 8 << 20
#: Bits of the sketch of the doc_ids whose texts are needed again: 8 MB at most, at any size.
SKETCH_BITS = 26

_U = np.uint64
_A = textscan.mix(np.arange(1, HASHES + 1, dtype=_U)) | _U(1)
_B = textscan.mix(np.arange(1001, HASHES + 1001, dtype=_U))


def banding(percent: int) -> tuple[int, int]:
    """Bands and minima in each: as many minima as ``MISSED`` allows, one at least.

    At 80 % these are 32 bands of 4, which a pair misses with probability 5e-8.
    """
    share = min(max(percent, 0), 100) / 100
    rows = next((r for r in range(8, 1, -1) if (1 - share**r) ** (HASHES // r) <= MISSED), 1)
    return HASHES // rows, rows


def least_agreement(percent: int) -> int:
    """Minima on which a pair at the threshold agrees but for a chance of ``DEVIATIONS``.

    At 80 % they are 80 of 128: 102 on average with a deviation of 4.5.
    """
    share = min(max(percent, 0), 100) / 100
    mean = HASHES * share
    return max(math.ceil(mean - DEVIATIONS * math.sqrt(mean * (1 - share))), 0)


def shingle_sets(column: pa.Array, k: int) -> Iterator[list[np.ndarray]]:
    """For each chunk of texts, the sorted distinct hashes of each text's k-word shingles.

    Words are folded A to Z. A text of fewer than k words has its whole sequence as the only
    shingle; one without words has none.
    """
    for chunk in textscan.chunks(column):
        found = textscan.words(chunk, lower=True)
        hashes, of = textscan.grams(found, k)
        sets = []
        for d in range(len(chunk)):
            own = hashes[of[d] : of[d + 1]]
            if len(own) == 0 and found.of[d + 1] > found.of[d]:
                short = found.hash[found.of[d] : found.of[d + 1]]
                total = _U(len(short))
                for h in short:
                    total = textscan.mix(np.array([total ^ h], _U))[0]
                own = np.array([total], _U)
            sets.append(textscan.distinct(own))
        yield sets


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The 32-bit minima of 128 universal hash functions over each set (none may be empty)."""
    values = np.concatenate(sets)
    begin = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    out = np.empty((len(sets), len(_A)), np.uint32)
    low = 0
    # some sets at a time, so that the hashed values stay in the processor's cache
    while low < len(sets):
        high = int(np.searchsorted(begin, begin[low] + 32768, "right"))
        high = min(max(high, low + 1), len(sets))
        end = begin[high] if high < len(sets) else len(values)
        part, at = values[begin[low] : end], begin[low:high] - begin[low]
        for j in range(len(_A)):
            hashed = part * _A[j]
            hashed += _B[j]
            hashed >>= _U(32)
            out[low:high, j] = np.minimum.reduceat(hashed, at)
        low = high
    return out


_SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary"


def _sign(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    n_bands, n_rows = banding(percent)
    band_seeds = textscan.mix(np.arange(1, n_bands + 1, dtype=_U))
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        for sets in shingle_sets(batch.column("text"), k):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = sizes > 0
            set_a, set_b = np.zeros(len(sets), _U), np.zeros(len(sets), _U)
            signs = np.zeros((len(sets), HASHES), np.uint32)
            bands = np.zeros((len(sets), n_bands), _U)
            if full.any():
                some = [s for s in sets if len(s)]
                signs[full] = minima(some)
                set_a[full] = [np.add.reduce(s) for s in some]
                set_b[full] = [np.add.reduce(textscan.mix(s ^ _U(0x5851F42D4C957F2D))) for s in some]
                total = np.broadcast_to(band_seeds, bands.shape).copy()
                for r in range(n_rows):
                    own = signs[:, r : n_bands * n_rows : n_rows]
                    total = textscan.mix(total ^ own.astype(_U))
                bands = total
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(sets)),
                    pa.array(sizes),
                    pa.array(set_a.view(np.int64)),
                    pa.array(set_b.view(np.int64)),
                    pa.ListArray.from_arrays(
                        np.arange(len(sets) + 1, dtype=np.int32) * n_bands, bands.view(np.int64).ravel()
                    ),
                    pa.array([s.tobytes() for s in signs], pa.binary()),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "signature"],
            )
            at += len(sets)


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, at = batch.column("doc_id"), 0
        for sets in shingle_sets(batch.column("text"), k):
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(at, len(sets)).cast(pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["doc_id", "shingles"],
            )
            at += len(sets)


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    )


def _agreeing(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose signatures agree often enough."""
    for batch in batches:
        for low in range(0, len(batch), 4096):
            part = batch.slice(low, 4096)
            one, two = (
                np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint32).reshape(-1, HASHES)
                for c in ("sign_a", "sign_b")
            )
            keep = (one == two).sum(1) >= least
            yield _pairs_batch(
                part.column("a").to_numpy(zero_copy_only=False)[keep],
                part.column("b").to_numpy(zero_copy_only=False)[keep],
            )


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sets without repeats."""
    union = len(textscan.distinct(np.concatenate((one, two))))
    return 100 * (len(one) + len(two) - union) >= percent * union


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets are similar enough."""
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in "ab")
        keep = np.zeros(len(batch), bool)
        for i, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
            keep[i] = similar(*(np.frombuffer(v.as_buffer(), _U) for v in (x, y)), percent)
        yield _pairs_batch(a[keep], b[keep])


def _slots(ids: np.ndarray) -> np.ndarray:
    return (textscan.mix(ids.view(_U)) >> _U(64 - SKETCH_BITS)).astype(np.int64)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = _slots(batch.column("doc_id").to_numpy())
        words, place = np.unique(slots >> 6, return_inverse=True)
        bits = np.zeros(len(words), np.int64)
        np.bitwise_or.at(bits, place, np.int64(1) << (slots & 63))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits)], ["word", "bits"])


def _sketch(ids: DataFrame) -> np.ndarray:
    """A bit for every doc_id, some of them shared: 2**SKETCH_BITS in all."""
    rows = ids.mapInArrow(_sketch_rows, "word long, bits long")
    table = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    sketch = np.zeros(1 << (SKETCH_BITS - 6), np.int64)
    sketch[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return sketch


def _maybe_wanted(
    batches: Iterator[pa.RecordBatch], sketch: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slots = _slots(textscan.ids(batch.column("doc_id")))
        yield batch.filter(pa.array((sketch[slots >> 6] >> (slots & 63)) & 1 == 1))


def _sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Staged (doc_id, shingles) of the wanted doc_ids.

    A bounded sketch of them keeps most other texts out of the shuffle, the join the rest.
    """
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(wanted))

    def maybe(batches):
        return _maybe_wanted(batches, sketch.value)

    texts = docs.mapInArrow(maybe, docs.schema)
    texts = texts.join(wanted.hint("merge"), "doc_id", "left_semi")
    return stage(texts.mapInArrow(partial(_sets, k=k), "doc_id long, shingles binary"))


def _confirmed(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs a, b whose full shingle sets reach the similarity.

    Pairs and sets both grow with the input, so they are merged at every size.
    """
    sets = _sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), k)
    both = pairs.join(
        sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")).hint("merge"), "a"
    ).join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")).hint("merge"), "b")
    links = stage(both.mapInArrow(partial(_confirm, percent=percent), "a long, b long").distinct())
    discard(sets)
    return links


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component_id) for every end of a link; the component's smallest id.

    Alternates large-star and small-star until neither changes a link. Minima are aggregates
    that combine before the shuffle; each round goes to the shared folder.
    """

    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(ends.where("u <> v").distinct())
    before = mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(
            both.join(least(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        # every u now holds smaller neighbours only
        small = large.join(least(large), "u")
        stars = stage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .union(small.select("u", F.col("m").alias("v")))
            .distinct()
        )
        discard(edges, large)
        edges, after = stars, mark(stars)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked if their sets of distinct k-word shingles have 100 * intersection >=
    percent * union. component_id is the smallest doc_id that links reach, kept tells
    whether it is the row's own. Null texts and texts without words have no shingles, and
    link with nothing. A row without doc_id links with nothing either, has no component_id
    and is kept. Else doc_id names one text; a row that is repeated as a whole comes out as
    often. An empty table gives an empty table; further columns are
    not read.

    Equal sets meet by fingerprint and only their smallest doc_id goes on. Texts that share
    a band are compared with the smallest of that bucket. In buckets that are then still of
    several components all pairs across components are compared, block by block, until
    they are one; only the links found come out. So groups of copies cost a link each, and
    no link between different components is lost.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small_batches(docs.sparkSession)
    signed = stage(docs.mapInArrow(partial(_sign, k=k, percent=percent), _SIGNATURES))
    classes = (
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("n_shingles", "set_a", "set_b")
        .agg(F.min("doc_id").alias("head"))
    )
    heads = classes.select(F.col("head").alias("doc_id")).distinct()
    shown = signed.join(heads, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    banded = shown.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    leaders = (
        banded.groupBy("bucket")
        .agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last"))
        .where("leader < last")
        .drop("last")
    )
    members = stage(banded.join(leaders, "bucket"))
    signs = signed.select("doc_id", "signature")

    stars = members.where("doc_id > leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    near = stage(
        stars.distinct()
        .join(signs.select(F.col("doc_id").alias("b"), F.col("signature").alias("sign_b")).hint("merge"), "b")
        .join(signs.select(F.col("doc_id").alias("a"), F.col("signature").alias("sign_a")).hint("merge"), "a")
        .mapInArrow(partial(_agreeing, least=least_agreement(percent)), "a long, b long")
        .distinct()
    )
    links = _confirmed(docs, near, k, percent)
    parts = stage(components(links))
    more = stage(_across(docs, members, parts, signs, k, percent))
    known = parts.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    whole = stage(components(known.union(more)))
    discard(near, members, links, parts, more)
    parts = whole

    joined = classes.join(parts.withColumnRenamed("doc_id", "head"), "head", "left").select(
        "n_shingles", "set_a", "set_b", F.coalesce("component_id", "head").alias("component_id")
    )
    return (
        signed.select("doc_id", "n_shingles", "set_a", "set_b")
        .join(joined, ["n_shingles", "set_a", "set_b"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")
            ).alias("component_id"),
            F.coalesce(
                F.coalesce("component_id", "doc_id") == F.col("doc_id"), F.lit(True)
            ).alias("kept"),
        )
    )


def _across(
    docs: DataFrame, members: DataFrame, parts: DataFrame, signs: DataFrame, k: int, percent: int
) -> DataFrame:
    """Links between members of a bucket that are in different components.

    Members of a bucket are dealt to blocks by doc_id; each pair of blocks is one group.
    """
    placed = members.select("bucket", "doc_id", "n_shingles").join(parts, "doc_id", "left").select(
        "bucket", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("part")
    )
    blocks = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") * 8 / BLOCK_BYTES)
    mixed = (
        placed.groupBy("bucket")
        .agg(
            F.min("part").alias("low"), F.max("part").alias("high"),
            F.ceil(blocks).cast("int").alias("blocks"),
        )
        .where("low < high")
        .select("bucket", "blocks")
    )
    placed = stage(placed.join(mixed, "bucket"))
    sets = _sets_of(docs, placed.select("doc_id").distinct(), k)
    # block i meets every j: in the group (i, j) with the smaller first
    dealt = (
        placed.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket",
            "doc_id",
            "part",
            "own",
            F.least("own", "other").alias("one"),
            F.greatest("own", "other").alias("two"),
        )
        .join(signs.hint("merge"), "doc_id")
        .join(sets.hint("merge"), "doc_id")
    )
    keys = ("bucket", "one", "two")
    links = (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(partial(_compare_groups, percent=percent), "a long, b long")
        .distinct()
    )
    return links


def _compare_groups(
    batches: Iterator[pa.RecordBatch], percent: int
) -> Iterator[pa.RecordBatch]:
    """The links that join the components of each group, two blocks or one.

    Groups come one after the other; the last one of a batch may go on in the next.
    """
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        keys = np.stack([table.column(c).to_numpy() for c in ("bucket", "one", "two")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if last:
            yield _compare(table.slice(0, last), [0, *cuts[:-1], last], percent)
        rest = table.slice(last)
    if rest is not None and len(rest):
        yield _compare(rest, [0, len(rest)], percent)


def _compare(table: pa.Table, cuts: list[int], percent: int) -> pa.RecordBatch:
    ids, part, own, one, two = (
        table.column(c).to_numpy() for c in ("doc_id", "part", "own", "one", "two")
    )
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32)
    signs, least = signs.reshape(len(ids), HASHES), least_agreement(percent)
    sets = [np.frombuffer(v.as_buffer(), _U) for c in table.column("shingles").chunks for v in c]
    sizes = np.array([len(s) for s in sets], np.int64)
    part, a, b = part.copy(), [], []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        here = part[low:high]
        same = one[low] == two[low]
        right = np.flatnonzero(own[low:high] == two[low]) + low
        for i in np.flatnonzero(own[low:high] == one[low]) + low:
            others = right[right > i] if same else right
            others = others[part[others] != part[i]]
            if len(others) == 0:
                continue
            short, long = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
            others = others[100 * short >= percent * long]
            agree = (signs[others] == signs[i]).sum(1)
            likely = np.argsort(-agree, kind="stable")
            for j in others[likely[agree[likely] >= least]]:
                # a link found before may have joined the two
                if part[i] != part[j] and similar(sets[i], sets[j], percent):
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
                    here[here == part[j]] = part[i]
    return _pairs_batch(np.array(a, np.int64), np.array(b, np.int64))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest doc_id."""
    gone = near_duplicates(docs, k, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
