"""A Merkle manifest of a dataset: one tree per group, one root over the groups' roots.

A leaf's place in its group is its rank among the group's ids. It comes from bitmaps: each
group keeps the words of 64 ids that are not empty (partial bitmaps meet by bitwise or), and
a directory of two levels holds how many leaves lie before a block of 1,024 words and before
a word inside its block. A rank query adds the set bits below an id in its own word, so the
leaves themselves are never put in order. Repeated ids carry their number beside the bit.

Levels are reduced by key and slot: 243 nodes of a tree in a row meet under (tree, block) and
are hashed five levels up at once, so a table of any size takes a few shuffles, each a
243rd of the one before, and a group of any size is many keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.staging import discard, stage
from shelfsight.operators.ranking import running_totals

ARITY = 3
STEPS = 5  # levels hashed in one task
FAN = ARITY**STEPS
#: Words of 64 ids whose popcounts make one entry of the upper directory, as a power of two.
BLOCK_BITS = 10
_COPIES = 4096  # copies of one row are counted out in lists of this length at most

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PLACED = "tree long, total long, pos long, digest string, doc_id long, claim string"
_TOPS = "tree long, total long, pos long, digest string"
_ABOVE = ("tree", "pos", "path", "subroot", "root")
_PATHS = (
    "tree long, pos long, digest string, path array<struct<left:string,right:string>>,"
    " subroot string, root string"
)
_PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
    " folded_root string"
)


def _netstring(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else byte count, colon and value."""
    return F.sha2(F.concat(*(_netstring(c) for c in fields)).cast("binary"), 256)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _word(number: Column) -> Column:
    return F.shiftright(number, 6)


def _bit(number: Column) -> Column:
    return F.coalesce(number.bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def id_bitmaps(leaves: DataFrame) -> DataFrame:
    """``group, word, bits, rows, repeats``: the words of each group's bitmap that are not empty.

    A null id is the only bit of a word without number, which counts as the smallest.
    ``repeats`` lists the bits whose id occurs more than once, and how many times more.
    """
    more = F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))
    return (
        leaves.groupBy("group", "doc_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("group", "n", _word(F.col("doc_id")).alias("word"), _bit(F.col("doc_id")).alias("bit"))
        .groupBy("group", "word")
        .agg(
            F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"),
            F.sum("n").alias("rows"),
            F.collect_list(more).alias("repeats"),
        )
    )


def _directory(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps with their group's tree and size and the number of leaves ``before`` each word."""
    block = F.shiftright("word", BLOCK_BITS)
    blocks = bitmaps.groupBy("group", block.alias("block")).agg(F.sum("rows").alias("rows"))
    upper = running_totals(
        blocks, [F.col("block").asc_nulls_first()], {"upto": F.col("rows")}, by=["group"]
    )
    groups = running_totals(
        blocks.groupBy("group").agg(F.sum("rows").alias("total")),
        [F.col("group").asc_nulls_first()],
        {"number": F.lit(1)},
    )
    trees = groups.select(F.col("group").alias("g"), (F.col("number") - 1).alias("tree"), "total")
    upper = upper.join(trees, _same(F.col("group"), F.col("g"))).select(
        "g", "tree", "total", F.col("block").alias("b"), (F.col("upto") - F.col("rows")).alias("base")
    )
    earlier = F.expr(
        "sum(rows) OVER (PARTITION BY group, block ORDER BY word NULLS FIRST"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    words = bitmaps.withColumn("block", block).withColumn("inside", F.coalesce(earlier, F.lit(0)))
    meets = _same(F.col("group"), F.col("g")) & _same(F.col("block"), F.col("b"))
    return words.join(upper, meets).select(
        "g", "tree", "total", F.col("word").alias("w"), "bits", "repeats",
        (F.col("base") + F.col("inside")).alias("before"),
    )


def _ranked(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """Every leaf with the rank of its id, ``pos``, and the number ``n`` of leaves of that id."""
    joined = leaves.withColumn("bit", _bit(F.col("doc_id"))).join(
        words, _same(F.col("group"), F.col("g")) & _same(_word(F.col("doc_id")), F.col("w"))
    )
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    lower = F.expr("aggregate(filter(repeats, r -> r.bit < bit), 0L, (a, r) -> a + r.more)")
    own = F.expr("aggregate(filter(repeats, r -> r.bit = bit), 1L, (a, r) -> a + r.more)")
    return joined.select(
        "tree", "total", "doc_id", "digest", "claim", own.alias("n"),
        (F.col("before") + below + lower).cast("long").alias("pos"),
    )


def _placed(ranked: DataFrame) -> DataFrame:
    """Leaves with places of their own: those of one id follow each other by digest.

    Equal rows are counted before they move and then counted out again.
    """
    columns = [c.split()[0] for c in _PLACED.split(", ")]
    single = ranked.where("n = 1").select(columns)
    key = ["tree", "total", "pos", "doc_id"]
    copies = ranked.where("n > 1").groupBy(*key, "digest", "claim").agg(F.count(F.lit(1)).alias("copies"))
    order = [F.col("digest"), F.col("claim").asc_nulls_first()]
    upto = running_totals(copies, order, {"upto": F.col("copies")}, by=key)
    last = F.col("copies") - 1
    counted = upto.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_COPIES}")))).withColumn(
        "__copy",
        F.explode(
            F.sequence(F.col("__lot") * _COPIES, F.least((F.col("__lot") + 1) * _COPIES - 1, last))
        ),
    )
    place = F.col("pos") + F.col("upto") - F.col("copies") + F.col("__copy")
    return single.unionByName(counted.withColumn("pos", place.cast("long")).select(columns))


def _hash(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def climb(nodes: list[str], whole: bool) -> list[list[str]]:
    """``nodes`` and the levels above them: up to a single node, or the fixed number of steps."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= STEPS:
        last = levels[-1]
        levels.append([_hash(last[i : i + ARITY]) for i in range(0, len(last), ARITY)])
    return levels


def siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of a node in its run, level by level."""
    path = []
    for level in levels[:-1]:
        first = slot - slot % ARITY
        path.append(("".join(level[first:slot]), "".join(level[slot + 1 : first + ARITY])))
        slot //= ARITY
    return path


def fold(digest: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = _hash((left, digest, right))
    return digest


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], names: Sequence[str], types: Sequence[pa.DataType], size: int = 4096):
    schema = pa.schema(list(zip(names, types, strict=True)))
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _levels(row: dict) -> tuple[list[dict], list[list[str]]]:
    members = sorted(row["members"], key=lambda m: m["slot"])
    return members, climb([m["digest"] for m in members], row["total"] <= FAN)


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            _, levels = _levels(row)
            above = -(-row["total"] // FAN)
            yield dict(tree=row["tree"], total=above, pos=row["block"], digest=levels[-1][0])

    yield from _batches(rows(), ["tree", "total", "pos", "digest"], [pa.int64()] * 3 + [pa.string()])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            members, levels = _levels(row)
            for slot, member in enumerate(members):
                steps = [dict(left=a, right=b) for a, b in siblings(levels, slot)]
                yield dict(tree=row["tree"], pos=row["block"] * FAN + slot, digest=member["digest"],
                           path=steps + row["path"], subroot=row["subroot"], root=row["root"])

    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    names = ["tree", "pos", "digest", "path", "subroot", "root"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(step), pa.string(), pa.string()]
    yield from _batches(rows(), names, types)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row in _rows(batches):
            members, levels = _levels(row)
            above = [(step["left"], step["right"]) for step in row["path"]]
            for slot, member in enumerate(members):
                path = siblings(levels, slot) + above
                leaf = member["digest"]
                yield dict(doc_id=member["doc_id"], leaf=leaf, subroot=row["subroot"], root=row["root"],
                           proof_sha256=_hash(text for step in path for text in step),
                           folded_root=fold(member["claim"] or leaf, path))

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    yield from _batches(rows(), names, [pa.int64()] + [pa.string()] * 5)


def _reduced(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round from the leaves up, and the last node of each tree."""
    layers = []
    while True:
        payload = [c for c in ("doc_id", "claim") if c in nodes.columns]
        slot = (F.col("pos") % FAN).cast("int").alias("slot")
        blocks = nodes.groupBy("tree", "total", F.expr(f"pos div {FAN}").alias("block")).agg(
            F.collect_list(F.struct(slot, "digest", *payload)).alias("members")
        )
        layers.append(stage(blocks))
        nodes = layers[-1].mapInArrow(_tops, _TOPS)
        if largest <= FAN:
            return layers, nodes
        largest = -(-largest // FAN)


def _below(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with what their own node brings from above."""
    named = above.select(
        F.col("tree").alias("__tree"), F.col("pos").alias("__pos"), "path", "subroot", "root"
    )
    meets = (F.col("tree") == F.col("__tree")) & (F.col("block") == F.col("__pos"))
    return blocks.join(named, meets).drop("__tree", "__pos")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    doc_id: str = "doc_id",
    group: str = "source",
    claims: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf hashes the ``fields`` of a document. Leaves of a group stand by ascending id; every
    three nodes in a row become one, a run at the end may be shorter, until one is left, the
    subroot. Subroots by group (null first, bytewise) give the root the same way.
    ``proof_sha256`` hashes the siblings from the leaf to the root. ``claims`` gives fields
    whose value is to be checked, as columns over ``docs``: ``folded_root`` is what the
    claimed document and the original siblings fold to, and ``verified`` whether that is the
    root.

    A null field is the mark ``-`` in its leaf; a null group is a group, and a null id stands
    before all others. Rows that share an id stand by digest, and equal rows one after the
    other, each with a proof of its own. Without rows there is no row and no root. Columns
    other than ``fields``, id and group play no part, whatever their names.

    Runs jobs: ranks and every round of levels are written to the shared folder.
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    claimed = leaf_digest([(claims or {}).get(c, F.col(c)) for c in fields])
    leaves = docs.select(
        F.col(group).cast("string").alias("group"),
        F.col(doc_id).cast("long").alias("doc_id"),
        leaf.alias("digest"),
        (claimed if claims else F.lit(None).cast("string")).alias("claim"),
    )
    if claims:
        leaves = leaves.withColumn("claim", F.nullif("claim", "digest"))
    leaves = stage(leaves)
    bitmaps = stage(id_bitmaps(leaves))
    ranked = stage(_ranked(leaves, _directory(bitmaps)))
    discard(leaves, bitmaps)
    shape = ranked.agg(F.max("total").alias("most"), F.max("tree").alias("last")).first()
    layers, subroots = _reduced(_placed(ranked), shape["most"] or 0)
    discard(ranked)

    count = (shape["last"] or 0) + 1
    one_tree = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("total"),
        F.col("tree").alias("pos"), "digest",
    )
    upper, root = _reduced(one_tree, count)
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    above = root.select(
        "tree", "pos", no_steps.alias("path"), F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for blocks in reversed(upper):
        above = _below(blocks, above).mapInArrow(_paths, _PATHS).select("digest", *_ABOVE)
    above = above.select(
        F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path",
        F.col("digest").alias("subroot"), "root",
    )
    for blocks in reversed(layers[1:]):
        above = _below(blocks, above).mapInArrow(_paths, _PATHS).select(*_ABOVE)
    proofs = _below(layers[0], above).mapInArrow(_proofs, _PROOFS)
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
