"""Sorting one bucket of suffixes by their bytes, long ties by the ranks of a difference cover."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable
from functools import cache

import numpy as np


@cache
def difference_cover(window: int) -> tuple[int, tuple[int, ...]]:
    """Modulus v and cover D: any two numbers can be moved by the same k < v into D.

    D is where a linear recurrence of order three over the integers modulo a prime q is 0;
    for a primitive one that is a perfect difference set of q + 1 numbers modulo
    q**2 + q + 1. The modulus is the largest that leaves a sample a quarter of the window.
    """
    if window < 5:
        return 1, (0,)
    for q in (13, 11, 7, 5, 3, 2):
        v = q * q + q + 1
        if v - 1 > 0.75 * window:
            continue
        for a, b, c in itertools.product(range(q), range(q), range(1, q)):
            s = [0, 0, 1]
            while len(s) < v:
                s.append((a * s[-1] + b * s[-2] + c * s[-3]) % q)
            cover = tuple(n for n in range(v) if s[n] == 0)
            if len(cover) == q + 1 and len({(i - j) % v for i in cover for j in cover}) == v:
                return v, cover
    return 1, (0,)


@cache
def _moves(v: int, cover: tuple[int, ...]) -> np.ndarray:
    """By two remainders: the least k that moves both into the cover."""
    inside = np.isin(np.arange(v), cover)
    number = np.arange(v)
    moved = inside[(number[:, None] + number) % v]
    return np.argmax(moved[:, None, :] & moved[None, :, :], axis=2).astype(np.int32)


class _Words:
    """Eight bytes from any position on as one number that sorts like them."""

    def __init__(self, data: np.ndarray):
        self.end = len(data)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self.words = np.ndarray(len(data) + 8, ">u8", padded, strides=(1,))

    def take(self, at: np.ndarray, turn: int, length: np.ndarray | int) -> np.ndarray:
        """Bytes 8 * turn and on of the strings of ``length`` bytes at ``at``; zeros behind them."""
        word = self.words[np.minimum(at + 8 * turn, self.end)].astype(np.uint64)
        gone = 8 - np.clip(np.asarray(length) - 8 * turn, 0, 8)
        if not gone.any():
            return word
        kept = np.array([(1 << 64) - (1 << 8 * g) if g < 8 else 0 for g in range(9)], np.uint64)
        return word & kept[gone]


def _sort(count: int, keys: Iterable[Callable[[np.ndarray], np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Sort numbers below ``count`` by one key after the other, each within the ties left.

    Gives the order, the place at which each place's tie begins, and the places that are tied.
    """
    order, group, tied = np.arange(count), np.zeros(count, np.int64), np.arange(count)
    for key in keys:
        if len(tied) < 2:
            break
        values = key(order[tied])
        by = np.lexsort((values, group[tied]))
        order[tied], values = order[tied][by], values[by]
        own = group[tied]
        first = np.ones(len(tied), bool)
        first[1:] = (own[1:] != own[:-1]) | (values[1:] != values[:-1])
        begin = np.flatnonzero(first)
        sizes = np.diff(np.append(begin, len(tied)))
        group[tied] = np.repeat(tied[begin], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
    return order, group, tied


def _merge(at: np.ndarray, group: np.ndarray, rank: np.ndarray, v: int, moves: np.ndarray) -> np.ndarray:
    """Sort the suffixes ``at`` within their groups, which share their first v bytes.

    Suffixes of one remainder by v are ordered by the rank of their first sample. Remainders
    are then merged two by two, all groups at once: two suffixes are compared by the ranks of
    the samples that the same move takes them to. Suffixes whose windows are equal end up next
    to each other, in any order among themselves.
    """
    rest = at % v
    by = np.lexsort((rank[at + moves[rest, rest]], rest, group))
    at, rest = at[by], rest[by]
    own = group << (v - 1).bit_length()
    for level in range((v - 1).bit_length()):
        key = own + (rest >> level)
        first = np.searchsorted(key, key ^ 1, "left")
        low, high = first.copy(), np.searchsorted(key, key ^ 1, "right")
        right = (rest >> level) % 2 == 1
        live = np.flatnonzero(low < high)
        open_ = live
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            k = moves[rest[open_], rest[middle]]
            a, b = rank[at[open_] + k], rank[at[middle] + k]
            after = (b < a) | (right[open_] & (b == a))
            low[open_] = np.where(after, middle + 1, low[open_])
            high[open_] = np.where(after, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        # a left suffix moves on by what comes before it from the right, a right one moves back
        # by what comes behind it from the left
        end = np.searchsorted(key, key[live] ^ 1, "right")
        place = live + low[live] - np.where(right[live], end, first[live])
        by = live[np.argsort(place, kind="stable")]
        at[live], rest[live] = at[by], rest[by]
    return at


def repeated(data: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """For every whole window of each text, in order, whether its bytes also begin elsewhere.

    Text i is ``data[offsets[i]:offsets[i + 1]]``. Suffixes are sorted by as many bytes as the
    cover has remainders. Those that still tie are ordered by the ranks of cover samples, which
    are sorted once by all bytes of a window; neighbours are then compared byte by byte.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(ends - np.arange(len(data)) >= window)
    twice = np.zeros(len(at), bool)
    if len(at) < 2:
        return twice
    v, cover = difference_cover(window // 3)
    words, turns, short = _Words(data), -(-window // 8), -(-v // 8)

    def windows(turn: int) -> Callable[[np.ndarray], np.ndarray]:
        return lambda chosen: words.take(at[chosen], turn, window)

    order, group, tied = _sort(len(at), map(windows, range(min(short, turns))))
    if len(tied) == 0:
        return twice
    group, chosen = group[tied], at[order[tied]]
    if short < turns:
        size = len(data) + 1
        change = np.bincount(chosen, minlength=size) - np.bincount(chosen + v, minlength=size)
        inside = np.isin(np.arange(v), cover)
        asked = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        sample = asked[inside[asked % v]]
        left = np.minimum(ends[sample] - sample, window)

        def samples(turn: int) -> Callable[[np.ndarray], np.ndarray]:
            return lambda some: words.take(sample[some], turn, left[some])

        keys = itertools.chain(map(samples, range(turns)), [lambda some: left[some]])
        by, ranks, _ = _sort(len(sample), keys)
        rank = np.zeros(len(data), np.int64)
        rank[sample[by]] = ranks
        chosen = _merge(chosen, group, rank, v, _moves(v, cover))
    same = np.flatnonzero(group[1:] == group[:-1])
    for turn in range(short, turns):
        one, two = chosen[same], chosen[same + 1]
        same = same[words.take(one, turn, window) == words.take(two, turn, window)]
    found = np.zeros(len(data), bool)
    found[chosen[same]] = True
    found[chosen[same + 1]] = True
    return found[at]
