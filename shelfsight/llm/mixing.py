"""Mixing sources to target weights: capped water-filling, then seeded repetition.

``draw_documents`` draws whole documents that add up to the targets; ``mix_documents`` takes
the same share of every document instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.staging import stage
from shelfsight.operators.ranking import running_totals

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """One row per source with the words that the mix takes from it.

    ``sizes`` has source, source_size. Sources in code point order, null last, get the
    weights in turn. They share ``budget`` times all words by weight; a source stops at
    ``max_epochs`` times its size, and what it cannot take is shared again by weight among
    the others, until no source is above its limit. A source without words gets 0.

    The sources are counted by position in range partitions, not in one window. Each round
    of the water-filling is one aggregate of the source table; the driver sees three sums.
    """
    ranked = running_totals(
        sizes, [F.col("source").asc_nulls_last()], {"position": F.lit(1).cast("long")}
    )
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    limit = (F.col("source_size") * max_epochs).cast("double")
    table = stage(ranked.select("source", "source_size", weight.alias("weight"), limit.alias("limit")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * F.lit(level)
        taken, open_weight = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if open_weight == 0:
            break
        higher = (total * budget - taken) / open_weight
        if higher <= level:
            break
        level = higher
    return table.select(
        "source",
        "source_size",
        F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"),
    )


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the key only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


#: Keys that the rows of one source are dealt over where they meet the source's targets.
SALTS = 32
_ADDED = (
    "mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_whole", "mix_part",
)


def _own_names(docs: DataFrame) -> str:
    """A beginning of names for working columns that no column of ``docs`` has."""
    prefix = "__mix"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def _meet(rows: DataFrame, table: DataFrame, key: str, prefix: str) -> DataFrame:
    """``rows`` with the row of ``table`` whose ``key`` is their source, null with null.

    A source may hold most of the rows, so it is dealt over SALTS keys, and its one row of
    ``table`` goes to each of them.
    """
    salt, of = f"{prefix}_salt", f"{prefix}_of_salt"
    dealt = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    same = F.col("source").eqNullSafe(F.col(key)) & (F.col(salt) == F.col(of))
    return dealt.join(table.withColumn(of, every), same, "left").drop(salt, of)


def mix_documents(
    docs: DataFrame,
    seed: int = 7,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """Every row of ``docs`` with how often the mix repeats it, all documents at one rate.

    Adds mix_size (words), mix_source_size, mix_target (of its source), mix_taken (words
    taken, repeats counted), mix_whole (whole repetitions) and mix_part (words of one more,
    partial repetition). A source's rate is target / source_size. A document is taken
    ``rate`` times, its last word settled by a seeded draw per doc_id, so that the words
    taken follow the target closely for small sources too.

    Null texts and texts without words have size 0 and take nothing. A null source is a
    source. Rows with equal doc_id draw alike. An empty table gives an empty table.
    Further columns stay; columns named mix_* are replaced.
    """
    own = _own_names(docs)
    source, size, target = (f"{own}_{n}" for n in ("source", "size", "target"))
    sized = docs.withColumn("mix_size", word_count(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    targets = source_targets(sizes, weights, budget, max_epochs).toDF(source, size, target)
    kept = [c for c in docs.columns if c not in _ADDED]
    rate = F.when(F.col(size) > 0, F.col(target) / F.col(size)).otherwise(0.0)
    taken = F.floor(rate * F.col("mix_size") + uniform(seed, F.col("doc_id"))).cast("long")
    taken = F.least(taken, F.col("mix_size") * max_epochs)
    whole = F.when(F.col("mix_size") > 0, F.expr("mix_taken div mix_size")).otherwise(F.lit(0)).cast("long")
    return (
        _meet(sized, targets, source, own)
        .withColumns({"mix_source_size": F.col(size), "mix_target": F.col(target), "mix_taken": taken})
        .withColumn("mix_whole", whole)
        .withColumn("mix_part", F.col("mix_taken") - F.col("mix_whole") * F.col("mix_size"))
        .select(*kept, *_ADDED)
    )


def draw_documents(
    docs: DataFrame,
    seed: int = 7,
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """Every row of ``docs`` with how often the mix repeats it, in whole documents.

    Adds the columns of ``mix_documents``. Every document of a source is repeated
    mix_target div mix_source_size times. The words that are left are filled with one more
    repetition of whole documents, in the order of md5 over seed, doc_id and md5 of the text,
    until the next one does not fit; of that one only the words that are left are taken. So a
    source gives exactly its target, rounded down, and cuts one document at most.

    Null texts and texts without words take nothing. A null source is a source. Rows that
    are equal in doc_id and text share what falls to them evenly. An empty table gives an
    empty table. Further columns stay; columns named mix_* are replaced.
    """
    kept = [c for c in docs.columns if c not in _ADDED]
    own = _own_names(docs)
    source, size, target, draw, copies, words, through, every, rest, of, last, cut = (
        f"{own}_{n}"
        for n in "source size target draw copies words through every rest of last cut".split()
    )
    # rows equal in doc_id and text draw alike
    named = F.concat_ws(
        ":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary"))
    )
    sized = docs.withColumns({"mix_size": word_count(F.col("text")), draw: F.md5(named.cast("binary"))})
    narrow = stage(
        sized.where(F.col("mix_size") > 0)
        .groupBy("source", draw, "mix_size")
        .agg(F.count(F.lit(1)).alias(copies))
        .withColumn(words, F.col("mix_size") * F.col(copies))
    )
    empty = docs.groupBy("source").agg(F.lit(0).cast("long").alias("source_size"))
    sizes = (
        narrow.groupBy("source").agg(F.sum(words).alias("source_size"))
        .unionByName(empty).groupBy("source").agg(F.sum("source_size").alias("source_size"))
    )
    goal = F.floor(F.col(target)).cast("long")
    has_size = F.col(size) > 0
    targets = source_targets(sizes, weights, budget, max_epochs).toDF(source, size, target)
    targets = stage(
        targets.withColumns(
            {
                every: F.when(has_size, ((goal - goal % F.col(size)) / F.col(size)).cast("long")).otherwise(F.lit(0)),
                rest: F.when(has_size, goal % F.col(size)).otherwise(F.lit(0)),
            }
        )
    )
    run = running_totals(narrow, [F.col(draw), F.col("mix_size")], {through: F.col(words)}, ["source"])
    before = F.col(through) - F.col(words)
    last_drawn = (
        _meet(run, targets, source, own)
        .where((F.col(through) > F.col(rest)) & (before <= F.col(rest)))
        .select(
            F.col("source").alias(of),
            F.col(draw).alias(last),
            F.floor((F.col(rest) - before) / F.col(copies)).cast("long").alias(cut),
        )
    )
    bounds = targets.join(last_drawn, F.col(source).eqNullSafe(F.col(of)), "left")
    has_words = F.col("mix_size") > 0
    once_more = F.when(F.col(draw) < F.col(last), 1).otherwise(0)
    whole = F.when(has_words, F.col(every) + once_more).otherwise(F.lit(0)).cast("long")
    part = F.when(has_words & (F.col(draw) == F.col(last)), F.col(cut)).otherwise(F.lit(0)).cast("long")
    return (
        _meet(sized, bounds, source, own)
        .withColumns(
            {"mix_source_size": F.col(size), "mix_target": F.col(target), "mix_whole": whole, "mix_part": part}
        )
        .withColumn("mix_taken", F.col("mix_whole") * F.col("mix_size") + F.col("mix_part"))
        .select(*kept, *_ADDED)
    )


def emit_mix(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: one row per repetition, ``repetition`` counted from 1.

    A partial repetition is a run of ``mix_part`` words, begun at a seeded word from which
    so many follow, with the white space between them as in the text.
    """
    kept = [c for c in mixed.columns if c not in (*_ADDED, "text", "repetition")]
    last = F.col("mix_whole") + F.when(F.col("mix_part") > 0, 1).otherwise(0)
    rows = mixed.where(last > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1), last.cast("int"))))
    first = uniform(seed + 1, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    begin = F.floor(first * (F.col("mix_size") - F.col("mix_part") + 1)).cast("int")
    listed = F.regexp_extract_all("text", F.lit(f"({GAP}*{WORD})"), F.lit(1))
    run = F.array_join(F.slice(listed, begin + 1, F.col("mix_part").cast("int")), "")
    cut = F.regexp_replace(run, f"^{GAP}+", "")
    text = F.when(F.col("repetition") > F.col("mix_whole"), cut).otherwise(F.col("text"))
    return rows.select(*kept, text.alias("text"), "repetition")
