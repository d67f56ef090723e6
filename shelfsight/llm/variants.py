"""Spelling variants: words one edit apart, found through an index of variable-length grams.

A gram dictionary is pruned by frequency: a gram is lengthened only where it is frequent, so
that rare short grams and long common ones index about equally many words. Each position of
a word (with a mark at both ends) begins one gram; which one depends on the letters it covers
and on nothing else, so an edit changes only the grams across it. The largest number that one
edit can change is the word's bound b: of any b + 1 grams, two words one edit apart share one
at the same place, give or take the edit. Each word is therefore listed under its b + 1 rarest
grams only; lists are merged by gram, length and place, and every pair that meets is verified.

A word of five letters or more keeps at least one gram under any edit, since grams have at
most five letters, so nothing is lost and no word needs a second way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.staging import discard, stage

SHORTEST, LONGEST = 2, 5  # letters of a gram
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A gram is frequent if it occurs more often than one in this many places: the dictionary
#: holds at most this many grams of each length, however many words there are.
DICTIONARY = 1 << 16
_RARE = 64  # no gram is lengthened to make a list shorter than this
_FIRST, _LAST = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = r"([A-Za-zÀ-ÿ]+)"

_INDEX = "gram string, size int, at int, word string, n long"


def _lowered(run: Column) -> Column:
    """Only A to Z change; ``lower`` does that to ASCII words and is much faster."""
    ascii_only = F.octet_length(run) == F.char_length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slip: int = 97) -> DataFrame:
    """``word`` per run of letters; every ``slip``-th, by checksum, lacks one letter.

    A null text has no words; a null id counts as an empty one in the checksum.
    """
    found = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(_RUN), F.lit(1))).alias("run"),
    )
    lowered = found.select("doc", _lowered(F.col("run")).alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    size = F.char_length("run")
    place = (F.col("h") % size).cast("int")
    short = F.concat(F.substr("run", F.lit(1), place), F.substr("run", place + 2, size))
    return hashed.select(F.when(F.col("h") % slip == 0, short).otherwise(F.col("run")).alias("word"))


def word_counts(words: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    counted = words.where(F.char_length("word") >= letters).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _marked(word: str) -> str:
    return f"{_FIRST}{word}{_LAST}"


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for word in batch.column("word").to_pylist():
            text = _marked(word)
            for size in range(SHORTEST, LONGEST + 1):
                counts.update([text[i : i + size] for i in range(len(text) - size + 1)])
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                ["gram", "n"],
            )


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams of distinct words and how often they occur.

    Of each length at most DICTIONARY grams can be this frequent, so they fit the driver and
    every task.
    """
    places = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    counted = words.select("word").mapInArrow(_gram_counts, "gram string, n long")
    frequent = counted.groupBy("gram").agg(F.sum("n").alias("n"))
    rows = frequent.where(F.col("n") > max(_RARE, places // DICTIONARY)).collect()
    return {row.gram: row.n for row in rows}


def decompose(word: str, frequent: dict[str, int]) -> list[str]:
    """The gram that begins at each place of the marked word."""
    text = _marked(word)
    grams = []
    for start in range(len(text) - 1):
        end, most = start + SHORTEST, min(start + LONGEST, len(text))
        while end < most and text[start:end] in frequent:
            end += 1
        grams.append(text[start:end])
    return grams


def affected(grams: list[str]) -> int:
    """The most grams that one edit can change: those across one letter."""
    steps = [0] * (len(grams) + LONGEST + 1)
    for start, gram in enumerate(grams):
        steps[start] += 1
        steps[start + len(gram)] -= 1
    most = across = 0
    for place in range(len(grams)):  # the letters; place 0 is the mark, the last mark is further
        across += steps[place]
        if place:
            most = max(most, across)
    return most


def listed(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """The grams and places a word is listed under: one more than an edit can change."""
    grams = decompose(word, frequent)
    order = sorted((frequent.get(g, 0), g, at) for at, g in enumerate(grams))
    return [(g, at) for _, g, at in order[: affected(grams) + 1]]


def gram_index(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``gram, size, at, word, n``: the lists, ``size`` being the word's length."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                rows += [(g, len(word), at, word, n) for g, at in listed(word, shared.value)]
            if rows:
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "size", "at", "word", "n"])

    return words.select("word", "n").mapInArrow(entries, _INDEX)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: every two words one edit apart, once (runs jobs).

    The longer word of a pair looks up its grams where the other one lists them: at the same
    place, or one further behind an added letter.
    """
    index = stage(gram_index(words, gram_dictionary(words)))

    def key(size, at):
        return F.xxhash64("gram", size, at).alias("key")

    size, at = F.col("size"), F.col("at")
    looks = index.select(
        key(size, at), F.col("word").alias("a"), F.col("n").alias("n_a"), size.alias("size_a")
    )
    offered = index.select(
        F.explode(F.array(key(size, at), key(size + 1, at), key(size + 1, at + 1))).alias("key"),
        F.col("word").alias("b"), F.col("n").alias("n_b"), size.alias("size_b"),
    )
    once = (F.col("size_a") > F.col("size_b")) | (F.col("a") > F.col("b"))
    verified = F.levenshtein("a", "b", 1) == 1
    met = looks.join(offered, "key").where(once & (F.col("size_a") - F.col("size_b") <= 1) & verified)
    return met.select("a", "n_a", "b", "n_b").dropDuplicates(["a", "b"])


def _roots(linked: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form, from the last forms outwards.

    A join by form meets at most the words one edit from it, so no key grows with the input.
    Counts at least double along a way of forms, which bounds the rounds by their logarithm.
    """
    open_ways = linked.where("form IS NOT NULL").select(F.col("word").alias("w"), "form")
    frontier = linked.where("form IS NULL").select("word", F.col("word").alias("root"))
    parts = []
    while True:
        reached = open_ways.join(frontier, F.col("form") == F.col("word"))
        frontier = stage(reached.select(F.col("w").alias("word"), "root"))
        if parts and frontier.isEmpty():
            break
        parts.append(frontier)
        if frontier.isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for words and their counts ``word, n``.

    ``n_near`` counts the words one inserted, deleted or replaced code point away. The form is
    the most frequent of them (of equals the smallest), if it occurs at least twice as often as
    the word; the root is what following the forms ends in. Words need five letters or more
    and must be distinct. A word without near words has none of both and is its own root; no
    words give no rows.
    """
    pairs = stage(near_pairs(words))
    both = pairs.select(F.col("a").alias("w"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("w"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = both.groupBy("w").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    holds = -F.col("best.m") >= 2 * F.col("n")
    linked = stage(
        words.join(best, F.col("word") == F.col("w"), "left").select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(holds, F.col("best.near")).alias("form"),
            F.when(holds, -F.col("best.m")).alias("form_n"),
        )
    )
    discard(pairs)
    roots = _roots(linked).withColumnRenamed("word", "w")
    return linked.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of whole ``documents`` texts, grouped (see ``group_variants``; runs jobs).

    Null and empty texts have no words. Repeated rows count as often as they occur. Columns
    other than doc_id and text play no part, whatever their names.
    """
    return group_variants(stage(word_counts(document_words(docs))))
