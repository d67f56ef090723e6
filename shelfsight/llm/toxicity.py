"""Toxicity behind disguised spellings: noisy-channel restoring, then scoring the restored words.

A word that leetspeak, spacing or repeated letters may disguise is a lattice of readings.
Viterbi picks the likeliest one under a character trigram model, which is counted over all
texts. Words without any of these have one reading and stay. The restored words are scored
by a noisy-or of word beginnings learnt from labelled texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import textscan
from shelfsight.llm.staging import discard, small_batches, stage

THRESHOLD = 0.7
#: Labelled texts that the model is fitted on at most, toxic and clean; the first by hash of doc_id.
TOXIC_SAMPLE, CLEAN_SAMPLE = 6_000, 18_000
#: Word beginnings that are considered at most, by number of toxic texts that hold them.
CANDIDATES = 20_000
#: Toxic texts that a beginning must explain beyond those chosen before it.
LEAST_GAIN = 3
#: Unlike toxic texts that must hold a beginning that is chosen for itself.
LEAST_UNLIKE = 6
PREFIXES = (3, 4, 5, 6, 7)

#: Letters that a sign may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
SEPARATORS = ".-*_ \t\n,/~·"
#: What each step of the channel costs, in natural logarithms.
SWAP, DROP_REPEATED, DROP_SEPARATOR = 1.5, 1.0, 0.7

_SYMBOLS = 64
_PAIRS = _SYMBOLS**2
_LETTER = r"[^\W_]|[" + re.escape("".join(c for c in LEET if not c.isalnum())) + "]"
#: Single letters, or signs for them, with any separators between.
_SPACED = re.compile(
    rf"(?<![^\W_])(?:(?:{_LETTER})[{re.escape(SEPARATORS)}]+){{2,}}(?:{_LETTER})(?![^\W_])"
)
#: Finds every string in which _readings offers a choice.
_SEVERAL = re.compile(
    rf"[{re.escape(''.join(LEET))}]|(?<=.)[{re.escape(SEPARATORS)}](?=.)|([^\W\d_])\1", re.DOTALL
)
_DOUBLED = re.compile(r"([^\W\d_])\1")
#: Signs at a word's edges that are no letter and stand for none.
_PLAIN_EDGES = ".,;:?\"'()[]{}-_*~/"
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def _symbol_table() -> np.ndarray:
    """Letters by code point: a to z are 1 to 26, other Latin letters share the rest, else 0."""
    table = np.zeros(0x251, np.int64)
    for code in range(0x250):
        char = chr(code)
        if "a" <= char <= "z":
            table[code] = code - 96
        elif char.isalpha() and char == char.lower():
            table[code] = 27 + code % (_SYMBOLS - 27)
    return table


_TABLE = _symbol_table()
_LISTED = _TABLE.tolist()


def symbol(char: str) -> int:
    return _LISTED[min(ord(char), 0x250)]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS**3, np.int64)
    for batch in batches:
        for chunk in textscan.chunks(batch.column("text")):
            ends = chunk.offsets[1:-1]
            text = bytes(chunk.data) if len(ends) == 0 else b" ".join(
                chunk.data[a:b].tobytes()
                for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True)
            )
            codes = np.frombuffer(text.decode("utf-8").lower().encode("utf-32-le"), np.uint32)
            s = np.concatenate(([0, 0], _TABLE[np.minimum(codes, 0x250)], [0]))
            total += np.bincount((s[:-2] * _SYMBOLS + s[1:-1]) * _SYMBOLS + s[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["trigram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) over all texts; at most 64**3 counts reach the driver."""
    counts = np.zeros(_SYMBOLS**3)
    rows = docs.select("text").mapInArrow(_count_trigrams, "trigram long, n long")
    for trigram, n in rows.groupBy("trigram").agg(F.sum("n").alias("n")).collect():
        counts[trigram] = n
    three = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + _SYMBOLS)
    p2 = (two + 2 * p1) / (two.sum(1, keepdims=True) + 2)
    p3 = (three + 2 * p2) / (three.sum(2, keepdims=True) + 2)
    return np.log(p3).astype(np.float32)


def _readings(chars: str) -> list[list[tuple[str, float]]]:
    """For each character what it may be read as ("" for dropped) and what that costs."""
    out = []
    for i, char in enumerate(chars):
        options = [(char, 0.0)]
        options += [(letter, SWAP) for letter in LEET.get(char, "")]
        if char in SEPARATORS and 0 < i < len(chars) - 1:
            options.append(("", DROP_SEPARATOR))
        elif i and char == chars[i - 1] and char.isalpha():
            options.append(("", DROP_REPEATED))
        out.append(options)
    return out


def _trimmed(token: str) -> str:
    """A token without the signs at its edges that stand for no letter."""
    begin, end = 0, len(token)
    while begin < end and not (token[begin].isalnum() or token[begin] in LEET):
        begin += 1
    while begin < end and not (token[end - 1].isalnum() or token[end - 1] in LEET):
        end -= 1
    return token[begin:end]


def decode(chars: str, model: list[float]) -> str:
    """The likeliest reading of a lower-case string; ties go to the one with fewer changes.

    ``model`` is the character model row by row. States are the last two symbols. A sign
    that is kept breaks the word as a space does.
    """
    # a state is a * _SYMBOLS + b
    states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for options in _readings(chars):
        known = [(r, symbol(r) if r else -1, cost) for r, cost in options]
        after: dict[int, tuple[float, tuple]] = {}
        for state, (score, path) in states.items():
            for reading, c, cost in known:
                if reading:
                    at = state * _SYMBOLS + c
                    key, value = at % _PAIRS, score - cost + model[at]
                else:
                    key, value = state, score - cost
                held = after.get(key)
                if held is None or value > held[0]:
                    after[key] = (value, (path, reading))
        states = after
    best = max(
        ((score + model[state * _SYMBOLS], path) for state, (score, path) in states.items()),
        key=lambda x: x[0],
    )[1]
    letters = []
    while best:
        best, reading = best
        letters.append(reading)
    return "".join(reversed(letters))


def _single_or_double(word: str, at: int, model: list[float]) -> str:
    """``decode`` of letters whose only choice is to drop the one at ``at``, which repeats."""
    symbols = [_LISTED[min(ord(c), 0x250)] for c in word]
    state, score = 0, 0.0
    for c in symbols[:at]:
        step = state * _SYMBOLS + c
        score += model[step]
        state = step % _PAIRS
    kept, kept_score = state, score
    for c in symbols[at:]:
        step = kept * _SYMBOLS + c
        kept_score += model[step]
        kept = step % _PAIRS
    score -= DROP_REPEATED
    for c in symbols[at + 1 :]:
        step = state * _SYMBOLS + c
        score += model[step]
        state = step % _PAIRS
    keeps = kept_score + model[kept * _SYMBOLS] >= score + model[state * _SYMBOLS]
    return word if keeps else word[:at] + word[at + 1 :]


@dataclass
class Restorer:
    """Restores words. Letters without a choice are read as they stand; the readings of other
    tokens are remembered, and the oldest half of them is forgotten when there are too many."""

    model: np.ndarray
    limit: int = 50_000
    _seen: dict[str, tuple[str, ...]] = field(default_factory=dict)
    _flat: list[float] = field(default_factory=list)

    def __post_init__(self):
        self._flat = self.model.ravel().tolist()

    def __getstate__(self):
        return {"model": self.model, "limit": self.limit, "_seen": {}, "_flat": self._flat}

    def _decoded(self, low: str) -> tuple[str, ...]:
        low = _trimmed(low)
        read = decode(low, self._flat) if _SEVERAL.search(low) else low
        found = (_EDGES.sub("", w) for w in re.split(r"[^\w'-]+", read))
        return tuple(w for w in found if len(w) >= PREFIXES[0])

    def token(self, token: str) -> tuple[str, ...]:
        """The words, lower case and without signs at their edges, that a token is restored to."""
        low = token.lower()
        core = low.strip(_PLAIN_EDGES)
        if core.isalpha():
            doubled = _DOUBLED.search(core)
            if doubled is None:
                return (core,) if len(core) >= PREFIXES[0] else ()
        words = self._seen.get(low)
        if words is None:
            if core.isalpha() and not _DOUBLED.search(core, doubled.start() + 1):
                read = _single_or_double(core, doubled.start() + 1, self._flat)
                words = (read,) if len(read) >= PREFIXES[0] else ()
            else:
                words = self._decoded(low)
            if len(self._seen) >= self.limit:
                for old in list(self._seen)[: self.limit // 2]:
                    del self._seen[old]
            self._seen[low] = words
        return words

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        out: set[str] = set()
        for token in set(text.lower().split()):
            out.update(self.token(token))
        for spelled in _SPACED.findall(text):
            # word by word as the decoder closes them
            read = decode(spelled.lower(), self._flat)
            out.update(w for w in re.findall(r"[^\W\d_]+", read) if len(w) >= PREFIXES[0])
        return out


def features(word: str) -> list[str]:
    """A word's beginnings and, marked, the whole of it."""
    return [word[:n] for n in PREFIXES if n <= len(word)] + [word + "$"]


def _features_of(words: Iterable[str]) -> set[str]:
    out: set[str] = set()
    for word in words:
        out.update(features(word))
    return out


def held_out(doc_id: Column) -> Column:
    """Whether labels of this row are never learnt from."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return crc % 3 == 1


@dataclass
class Model:
    """P(toxic) of each chosen beginning, and of a text with none of them."""

    characters: np.ndarray
    weights: dict[str, float]
    base: float

    def score(self, found: Iterable[str]) -> float:
        clean = 1.0 - self.base
        for feature in found:
            clean *= 1.0 - self.weights[feature]
        return 1.0 - clean


def _train_words(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    restorer = Restorer(model)
    for batch in batches:
        words = [sorted(restorer.words(t or "")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(words, pa.list_(pa.string()))], ["toxic", "words"]
        )


def _count_features(batches: Iterator[pa.RecordBatch], only_toxic: bool) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()

    def rows() -> pa.RecordBatch:
        names = list(toxic.keys() | clean.keys())
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([toxic[n] for n in names], pa.int64()),
                pa.array([clean[n] for n in names], pa.int64()),
            ],
            ["feature", "toxic", "clean"],
        )
        toxic.clear()
        clean.clear()
        return out

    for batch in batches:
        for label, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if label or not only_toxic:
                (toxic if label else clean).update(_features_of(words))
        if len(toxic) + len(clean) > 400_000:
            yield rows()
    yield rows()


def _held_features(batches: Iterator[pa.RecordBatch], known: set[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("words").to_pylist()
        found = [sorted(_features_of(w) & known) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("toxic"),
                pa.array(found, pa.list_(pa.string())),
                pa.array([likeness(w) for w in words], pa.list_(pa.int64())),
            ],
            ["toxic", "found", "likeness"],
        )


_HELD = "toxic int, found array<string>, likeness array<long>"
_MULTIPLIERS = textscan.mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def likeness(words: Iterable[str]) -> list[int]:
    """Eight minima of hashed words; copies of a text, near ones too, share most of them."""
    hashed = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words] or [0], np.uint64)
    return [int((hashed * m >> np.uint64(32)).min()) for m in _MULTIPLIERS]


def choose(
    rows: list[tuple[int, list[str], list[int]]], clean_weight: float
) -> tuple[dict[str, float], float]:
    """Beginnings that tell toxic texts, with P(toxic) of each, and P(toxic) of the rest.

    ``rows`` are label, beginnings and likeness of texts. First greedily those that explain
    the toxic texts: each round takes the one with the most toxic texts that none explains
    yet, less the clean texts that hold it; of equally good ones the longest, since fewer
    other words begin with it, then the first by alphabet. What merely stands beside a toxic
    word, as in copies of one text, is explained by it and gains nothing. Then those that
    many unlike toxic texts and next to no clean ones hold, though others explain them;
    neither beginnings nor extensions of what is chosen.
    """
    holders: dict[str, list[int]] = {}
    clean: Counter = Counter()
    for i, (label, found, _) in enumerate(rows):
        for feature in found:
            if label:
                holders.setdefault(feature, []).append(i)
            else:
                clean[feature] += 1
    open_ = {i for i, row in enumerate(rows) if row[0]}
    gain = {f: len(h) - 2 * clean_weight * clean[f] for f, h in holders.items()}
    order = {f: (f.endswith("$"), -len(f), f) for f in holders}
    weights: dict[str, float] = {}
    while gain:
        feature = min(gain, key=lambda f: (-gain[f], order[f]))
        if gain[feature] < LEAST_GAIN:
            break
        own = [i for i in holders[feature] if i in open_]
        weights[feature] = len(own) / (len(own) + clean_weight * clean[feature] + 1.0)
        for i in own:
            open_.discard(i)
            for other in rows[i][1]:
                if other in gain:
                    gain[other] -= 1
        del gain[feature]
    telling = {f: len(holders[f]) - 20 * clean_weight * clean[f] for f in gain}
    for feature in sorted(gain, key=lambda f: (-telling[f], order[f])):
        own, word = holders[feature], feature.rstrip("$")
        if any(w.startswith(word) or word.startswith(w) for w in (c.rstrip("$") for c in weights)):
            continue
        unlike = max(len({rows[i][2][k] for i in own}) for k in range(len(_MULTIPLIERS)))
        weight = unlike / (unlike + clean_weight * clean[feature] + 1.0)
        enough = unlike >= max(LEAST_UNLIKE, min(0.5 * len(own), 8 * LEAST_UNLIKE))
        if enough and clean_weight * clean[feature] < 0.02 * unlike:
            weights[feature] = weight
    told = [bool(set(found) & weights.keys()) for _, found, _ in rows]
    missed = sum(label and not t for (label, _, _), t in zip(rows, told, strict=True))
    plain = clean_weight * sum(not label and not t for (label, _, _), t in zip(rows, told, strict=True))
    return weights, (missed + 0.5) / (missed + plain + 1.0)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows of ``docs`` that are not held out, up to the sample sizes.

    Rows without doc_id or toxic are left out; of several labels of one doc_id the larger
    counts. Without labels the model has no words and scores everything alike.
    """
    small_batches(docs.sparkSession)
    characters = character_model(docs)
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r.toxic: r.n for r in usable.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    picked = []
    for toxic, limit in ((True, TOXIC_SAMPLE), (False, CLEAN_SAMPLE)):
        part = usable.where((F.col("toxic") > 0) == toxic)
        picked += [(r.doc_id, int(toxic)) for r in part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()]
    if not picked:
        return Model(characters, {}, 0.5)
    # bounded by the sample sizes: 16 bytes for each of at most 24,000 rows
    chosen = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int")
    train = stage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("toxic", "text")
        .mapInArrow(partial(_train_words, model=characters), "toxic int, words array<string>")
    )
    n_toxic = max(1, min(sizes.get(True, 0), TOXIC_SAMPLE))
    n_clean = max(1, min(sizes.get(False, 0), CLEAN_SAMPLE))
    clean_weight = (sizes.get(False, 0) / n_clean) / max(1e-9, sizes.get(True, 0) / n_toxic)
    schema = "feature string, toxic long, clean long"
    frequent = (
        train.mapInArrow(partial(_count_features, only_toxic=True), schema)
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= LEAST_GAIN)
        .orderBy(F.desc("toxic"), "feature")
        .limit(CANDIDATES)
    )
    known = {r.feature for r in frequent.select("feature").collect()}
    held = train.mapInArrow(partial(_held_features, known=known), _HELD)
    # of frequent beginnings only those that toxic texts hold clearly more often
    counts = {
        r.feature: (r.toxic, r.clean)
        for r in held.select("toxic", F.explode("found").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .collect()
    }
    telling = {f for f, (t, c) in counts.items() if t > 2 * clean_weight * c}
    rows = [
        (r.toxic, r.found, r.likeness)
        for r in train.mapInArrow(partial(_held_features, known=telling), _HELD).collect()
    ]
    discard(train)
    weights, base = choose(rows, clean_weight)
    return Model(characters, weights, base)


def _score(batches: Iterator[pa.RecordBatch], model: Model, into: str) -> Iterator[pa.RecordBatch]:
    restorer = Restorer(model.characters)
    seen: dict[str, tuple[str, ...]] = {}
    for batch in batches:
        scores = []
        for text in batch.column("text").to_pylist():
            found: set[str] = set()
            for word in restorer.words(text or ""):
                own = seen.get(word)
                if own is None:
                    own = tuple(f for f in features(word) if f in model.weights)
                    if len(seen) >= restorer.limit:
                        seen.clear()
                    seen[word] = own
                if own:
                    found.update(own)
            scores.append(model.score(sorted(found)))
        columns = [batch.column(n) for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(scores, pa.float64())], [*batch.schema.names, into]
        )


def score_texts(docs: DataFrame, model: Model, into: str = "toxicity") -> DataFrame:
    """``docs`` with a column ``into``, 0 to 1, from the whole text alone.

    Null and empty texts have no words and get the score of texts without any toxic one.
    Rows, repeated ones too, and further columns stay; a column named ``into`` is replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(partial(_score, model=model, into=into), f"{schema}, `{into}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold."""
    scored = score_texts(docs, fit(docs, labels), "__toxicity")
    return scored.where(F.col("__toxicity") < threshold).select(*docs.columns)
