"""Token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is compiled into two deterministic transducers.

* The *splitter* reads character classes and marks where the tokenizer's pattern begins a
  piece. It has a dozen states, so a stretch of text acts on it as a map from entry state to
  exit state. Stretches are read for all entry states at once, their maps are composed by a
  parallel prefix scan, and each stretch is then read again from the one state it begins in.
* The *counter* reads a piece byte by byte. Its transitions carry how the number of tokens
  changes. Its states are found when a text first needs them.

The counter rests on two facts about BPE: the tokens of a prefix of a piece are the tokens of
a shorter prefix and one more, and two tokens may stand side by side exactly if BPE, given
their bytes, leaves the two. So a state needs, for each suffix that may still grow into a
token, which token ended before it and how many tokens there were.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import textscan
from shelfsight.llm.staging import small_batches

# Classes of characters. The letters of English contractions have their own.
_CLASSES = ("letter", "stmd", "rv", "l", "e", "number", "space", "white", "quote", "other", "end")
LETTER, STMD, RV, ELL, E, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(len(_CLASSES))
_LETTERS = (LETTER, STMD, RV, ELL, E)
# What has been read: nothing open, a run of one class, a whole contraction, a quotation mark
# that opens a piece, the first letter of a two-letter contraction, white space (one or
# more; whether the last is a space).
_STATES = ("none", "letters", "numbers", "others", "done", "mark", "mark_rv", "mark_l",
           "one_space", "one_white", "more_space", "more_white")
NONE, LETTERS, NUMBERS, OTHERS, DONE, MARK, MARK_RV, MARK_L, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE = range(
    len(_STATES)
)
_HERE, _BEFORE = 1, 2  # a piece begins at this character, at the one before
_STRETCH = 128  # characters of a stretch
_MOST_STATES = 1 << 19  # the counter starts afresh between batches beyond this
_TRIED = 8  # a suffix that so few tokens continue is dropped if none of them fits
_FEW = 16  # pieces so few are read one after the other

_COUNTED = "doc_id long, n_bytes long, n_tokens long"


def _opened(c: int) -> int:
    if c in _LETTERS:
        return LETTERS
    return {NUMBER: NUMBERS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: MARK, OTHER: OTHERS, END: NONE}[c]


def _split_step(state: int, c: int) -> tuple[int, int]:
    """Next state and the beginnings of pieces that the character ``c`` settles."""
    white = c in (SPACE, WHITE)
    fresh = (_opened(c), 0 if c == END else _HERE)
    if state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE):
        if white:
            return (MORE_SPACE if c == SPACE else MORE_WHITE), 0
        if c == END:
            return NONE, 0
        if state in (ONE_SPACE, MORE_SPACE):  # the last space goes with what follows
            joined = OTHERS if c == QUOTE else _opened(c)
            return joined, _BEFORE if state == MORE_SPACE else 0
        return fresh[0], _HERE | (_BEFORE if state == MORE_WHITE else 0)
    if state == MARK and c in (STMD, RV, ELL):
        return {STMD: DONE, RV: MARK_RV, ELL: MARK_L}[c], 0
    if (state, c) in ((MARK_RV, E), (MARK_L, ELL)):
        return DONE, 0
    if state in (MARK_RV, MARK_L):  # no contraction: the letter began a piece
        after, marks = _split_step(LETTERS, c)
        return after, marks | _BEFORE
    stays = (
        (state == LETTERS and c in _LETTERS)
        or (state == NUMBERS and c == NUMBER)
        or (state in (OTHERS, MARK) and c in (OTHER, QUOTE))
    )
    if stays:
        return (OTHERS if state == MARK else state), 0
    return fresh


_NEXT = np.array([[_split_step(q, c)[0] for c in range(len(_CLASSES))] for q in range(len(_STATES))], np.intp)
_MARKS = np.array([[_split_step(q, c)[1] for c in range(len(_CLASSES))] for q in range(len(_STATES))], np.uint8)


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Row i of the result is the composition of the maps 0 to i; maps[i, q] is the exit state."""
    out = maps.copy()
    step = 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def split_marks(classes: np.ndarray) -> np.ndarray:
    """Per character the marks of the splitter, read from state NONE."""
    n, width = len(classes), len(_CLASSES)
    rows = -(-n // _STRETCH)
    padded = np.full(rows * _STRETCH, END, np.intp)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(rows, _STRETCH).T)
    following, marks = _NEXT.ravel(), _MARKS.ravel()

    states = np.tile(np.arange(len(_STATES)), (rows, 1))
    for column in columns:
        states = following[states * width + column[:, None]]
    entry = np.zeros(rows, np.intp)
    entry[1:] = prefix_scan(states)[:-1, NONE]

    found = np.empty((_STRETCH, rows), np.uint8)
    for i, column in enumerate(columns):
        at = entry * width + column
        found[i] = marks[at]
        entry = following[at]
    return found.T.ravel()[:n]


@dataclass(frozen=True)
class Spec:
    """What tasks need of a tokenizer: bounded by its vocabulary."""

    name: str
    tokens: dict[bytes, int]
    merges: dict[tuple[int, int], tuple[int, int]]  # pair -> rank, merged token
    classes: np.ndarray  # of every code point
    specials: tuple[bytes, ...]


def _byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _character_classes() -> np.ndarray:
    """Classes of all code points, as the library's own patterns see them."""
    from tokenizers import Regex, normalizers

    points = np.delete(np.arange(0x110000, dtype=np.uint32), np.s_[0xD800:0xE000])
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, c in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        replaced = normalizers.Replace(Regex(pattern), "\0").normalize_str(text)
        changed = np.frombuffer(replaced.encode("utf-32-le"), "<u4") != points
        classes[points[changed]] = c
    for letters, c in (("stmd", STMD), ("rv", RV), ("l", ELL), ("e", E), (" ", SPACE), ("'", QUOTE)):
        classes[[ord(x) for x in letters]] = c
    return classes


@lru_cache(maxsize=4)
def compile_tokenizer(path: str) -> Spec:
    """The tables of a byte-level BPE file of the ``tokenizers`` library, split by its usual pattern."""
    from tokenizers import Tokenizer

    text = Path(path).read_text(encoding="utf-8")
    spec = json.loads(text)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (
        model.get("type", "BPE") in ("BPE", 3)
        and spec["normalizer"] is None
        and (pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True)) == ("ByteLevel", False, True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    )
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    tokenizer = Tokenizer.from_file(path)
    letters = _byte_letters()
    added = {t["content"] for t in spec["added_tokens"]}
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    tokens = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if t not in added}
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
    specials = tuple(sorted((t.encode() for t in added), key=lambda t: (-len(t), t)))
    name = sha256(text.encode()).hexdigest()
    return Spec(name, tokens, merges, _character_classes(), specials)


class Counter:
    """The transducer over bytes; transitions are worked out when first taken and then kept."""

    def __init__(self, spec: Spec):
        self.tokens, self.merges = spec.tokens, spec.merges
        self.bytes_of = {i: t for t, i in spec.tokens.items()}
        self.growing: dict[bytes, list[int]] = {}  # the tokens that each true prefix may become
        for token, i in spec.tokens.items():
            for length in range(1, len(token)):
                self.growing.setdefault(token[:length], []).append(i)
        self.hopes: dict[tuple[bytes, int], bool] = {}
        self.never = len(spec.merges) + 1
        self.spines: dict[int, tuple | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.clear()

    def clear(self) -> None:
        # a state: the longest suffix that may grow, and per suffix its length, the token
        # before it (-1: none) and the number of tokens before it less those up to here
        first = (b"", ((0, -1, 0),))
        self.states, self.number = [first], {first: 0}
        self.taken: dict[int, tuple[int, int]] = {}
        self.size = 0
        self._room(1 << 16)

    def _room(self, slots: int) -> None:
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.keys = np.full(slots, -1, np.int64)
        self.follow, self.change = np.zeros(slots, np.int32), np.zeros(slots, np.int32)

    # --- BPE itself

    def _spine(self, token: int) -> tuple[list, list] | None:
        """Symbols at the left and right edge of a token while BPE builds it, each with the
        rank at which it is merged away; None if BPE does not build the token."""
        if token not in self.spines:
            parts = [(self.tokens[bytes([b])],) for b in self.bytes_of[token]]
            while len(parts) > 1:
                ranks = [self.merges.get((a[0], b[0]), (self.never,))[0] for a, b in zip(parts, parts[1:])]
                rank = min(ranks)
                if rank == self.never:
                    break
                at = ranks.index(rank)
                a, b = parts[at : at + 2]
                parts[at : at + 2] = [(self.merges[a[0], b[0]][1], a, b, rank)]
            edges = None
            if len(parts) == 1 and parts[0][0] == token:
                edges = ([], [])
                for side, edge in ((1, edges[0]), (2, edges[1])):
                    node, until = parts[0], self.never
                    while True:
                        edge.append((node[0], until))
                        if len(node) == 1:
                            break
                        node, until = node[side], node[3]
                    edge.reverse()
            self.spines[token] = edges
        return self.spines[token]

    def _fit(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens side by side."""
        key = (left, right)
        if key not in self.fits:
            ends, starts = self._spine(left)[1], self._spine(right)[0]
            i = j = 0
            while True:
                (a, until_a), (b, until_b) = ends[i], starts[j]
                across = self.merges.get((a, b), (self.never,))[0]
                # of equal ranks the merge further left comes first
                if across < until_a and across <= until_b and across != self.never:
                    self.fits[key] = False
                    break
                if until_a == until_b == self.never:
                    self.fits[key] = True
                    break
                if until_a <= until_b:
                    i += 1
                else:
                    j += 1
        return self.fits[key]

    def _hope(self, prefix: bytes, last: int) -> bool:
        """Whether a token that begins with ``prefix`` may follow ``last``; many are not tried."""
        may = self.growing[prefix]
        if last < 0 or len(may) > _TRIED:
            return True
        key = (prefix, last)
        if key not in self.hopes:
            self.hopes[key] = any(self._spine(t) and self._fit(last, t) for t in may)
        return self.hopes[key]

    # --- states

    def _take(self, key: int) -> tuple[int, int]:
        """The transition ``256 * state + byte``: next state and change in the number of tokens."""
        known = self.taken.get(key)
        if known is not None:
            return known
        suffix, ends = self.states[key >> 8]
        grown = suffix + bytes([key & 255])
        live, token, before = [], -1, 0
        for length, last, count in ends:
            own = grown[len(grown) - length - 1 :]
            if own in self.growing and self._hope(own, last):
                live.append((length + 1, last, count))
            found = self.tokens.get(own, -1)
            if found >= 0 and token < 0 and self._spine(found) and (last < 0 or self._fit(last, found)):
                token, before = found, count
        change = before + 1
        ends = (*((n, t, c - change) for n, t, c in live), (0, token, 0))
        state = (grown[len(grown) - ends[0][0] :], ends)
        number = self.number.setdefault(state, len(self.states))
        if number == len(self.states):
            self.states.append(state)
        self.taken[key] = (number, change)
        return number, change

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.intp)

    def _store(self, keys: np.ndarray) -> None:
        """Put transitions that are missing into the table, in rounds that settle clashes."""
        if 4 * (self.size + len(keys)) > len(self.keys):
            known = np.concatenate((self.keys[self.keys >= 0], keys))
            self._room(max(len(self.keys) * 2, 1 << (8 * len(known)).bit_length()))
            self.size, keys = 0, known
        values = np.array([self._take(k) for k in keys.tolist()], np.int32).reshape(-1, 2)
        self.size += len(keys)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            at = slots[left]
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[left[free]]
            won = self.keys[at] == keys[left]
            self.follow[at[won]], self.change[at[won]] = values[left[won], 0], values[left[won], 1]
            left = left[~won]
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        while True:
            slots = self._slots(keys)
            there = self.keys[slots]
            wrong = np.flatnonzero(there != keys)
            missing = []
            while len(wrong):
                empty = there[wrong] < 0
                missing.append(keys[wrong[empty]])
                wrong = wrong[~empty]
                slots[wrong] = (slots[wrong] + 1) & (len(self.keys) - 1)
                there[wrong] = self.keys[slots[wrong]]
                wrong = wrong[there[wrong] != keys[wrong]]
            absent = np.concatenate(missing) if missing else keys[:0]
            if not len(absent):
                return slots
            self._store(textscan.distinct(absent))

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of the pieces data[start:end], all read in step."""
        if len(self.states) > _MOST_STATES:
            self.clear()
        order = np.argsort(start - end, kind="stable")
        begin, sizes = start[order], (end - start)[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        longest = int(sizes[0]) if len(sizes) else 0
        step = 0
        while step < longest:
            n = int(np.searchsorted(-sizes, -step, "left"))  # pieces longer than step
            if n <= _FEW:
                break
            slots = self._find((state[:n] << 8) | data[begin[:n] + step])
            state[:n] = self.follow[slots]
            total[:n] += self.change[slots]
            step += 1
        for i in range(len(order)):
            if sizes[i] <= step:
                break
            at, sum_ = int(state[i]), int(total[i])
            for byte in data[begin[i] + step : begin[i] + sizes[i]].tolist():
                at, change = self._take((at << 8) | byte)
                sum_ += change
            total[i] = sum_
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


def _segments(data: np.ndarray, offsets: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut into parts whose tokens add up, and which text each part belongs to.

    A long text is cut before white space that follows a visible ASCII character, where a
    piece always begins; without such a place it stays whole.
    """
    bounds, owner = [0], []
    for text, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while high - low > 2 * limit:
            here = data[low + limit : high]
            cut = ((here == 0x20) | (here == 0x0A)) & (data[low + limit - 1 : high - 1] - 0x21 < 0x5E)
            at = int(np.argmax(cut))
            if not cut[at]:
                break
            low += limit + at
            bounds.append(low)
            owner.append(text)
        bounds.append(high)
        owner.append(text)
    return np.array(bounds), np.array(owner, np.int64)


def _count_part(counter: Counter, spec: Spec, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text of a part."""
    raw = data.tobytes()
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    widths = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
    byte_at = np.zeros(len(points) + 1, np.int64)
    np.cumsum(widths, out=byte_at[1:])
    classes = spec.classes[points]
    total = np.zeros(len(offsets) - 1, np.int64)
    if spec.specials and any(s in raw for s in spec.specials):
        pattern = re.compile(b"|".join(map(re.escape, spec.specials)))
        for text in range(len(total)):
            for hit in pattern.finditer(raw, offsets[text], offsets[text + 1]):
                total[text] += 1
                low, high = np.searchsorted(byte_at, hit.span())
                classes[low:high] = END
    ends = np.searchsorted(byte_at, offsets[1:])
    classes = np.insert(classes, ends, END)
    where = np.insert(byte_at[:-1], ends, offsets[1:])
    marks = split_marks(classes)
    begins = (marks & _HERE) > 0
    begins[:-1] |= (marks[1:] & _BEFORE) > 0
    at = np.flatnonzero(begins | (classes == END))
    first = np.flatnonzero(begins[at])
    start, end = where[at[first]], where[at[first + 1]]
    tokens = counter.count(data, start, end)
    text = np.searchsorted(offsets, start, "right") - 1
    return total + np.bincount(text, tokens, len(total)).astype(np.int64)


_COUNTERS: dict[str, Counter] = {}


def token_counts(column: pa.Array, spec: Spec, limit: int = textscan.CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text of an Arrow column."""
    counter = _COUNTERS.get(spec.name)
    if counter is None:
        _COUNTERS.clear()
        counter = _COUNTERS[spec.name] = Counter(spec)
    sizes, tokens = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    for chunk in textscan.chunks(column, limit):
        sizes[chunk.first : chunk.first + len(chunk)] = np.diff(chunk.offsets)
        bounds, owner = _segments(chunk.data, chunk.offsets, limit)
        low = 0
        while low < len(owner):
            high = max(int(np.searchsorted(bounds, bounds[low] + 2 * limit, "right")) - 1, low + 1)
            part = chunk.data[bounds[low] : bounds[high]]
            counts = _count_part(counter, spec, part, bounds[low : high + 1] - bounds[low])
            np.add.at(tokens, chunk.first + owner[low:high], counts)
            low = high
    return sizes, tokens


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``path`` is a byte-level BPE file of the ``tokenizers`` library; it is read in the driver,
    and tables bounded by its vocabulary go to the tasks. Counts are those of encoding
    without added tokens at the ends; special strings inside a text are tokens of their own.

    A null or empty text has no bytes and no tokens. Null and repeated ids keep their rows.
    An empty table gives no row. Other columns play no part, whatever their names. A very long
    text is read in parts that are cut where a piece begins.
    """
    spark = docs.sparkSession
    small_batches(spark)
    spec = spark.sparkContext.broadcast(compile_tokenizer(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, tokens = token_counts(batch.column("text"), spec.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(tokens)],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return texts.mapInArrow(counted, _COUNTED).withColumn("over_limit", F.col("n_tokens") > limit)
