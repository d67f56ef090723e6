import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfsight.llm import suffix, textscan
from shelfsight.llm.suffix import remove_repeats
from shelfsight.llm.suffix_sort import difference_cover, repeated
from shelfsight.llm.textblocks import TextBlock


def brute(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + window] for _, t in texts for i in range(len(t) - window + 1))
    out = []
    for doc_id, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("window", [200, 60, 20, 7, 2])
def test_every_difference_is_covered(window):
    v, cover = difference_cover(window)
    assert {(i - j) % v for i in cover for j in cover} == set(range(v))
    assert v <= window


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [1, 4 << 20])
def test_same_as_comparing_all_windows(documents, seed, block_bytes):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(150, 600))) for _ in range(6)]
    rows = []
    for i in range(25):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(pool)
            low = rng.randrange(len(p) // 2)
            parts.append(p[low : low + rng.randrange(120, 500)])
            parts.append("".join(rng.choice("xyz") for _ in range(rng.randrange(80))))
        rows.append((i, "".join(parts)))
    rows += [(90, None), (91, ""), (92, "z" * 700), (None, pool[0]), (93, pool[0]), (93, pool[0]), (94, "k" * 200), (95, "m" * 199)]
    docs = documents(rows, ["1 as block", "2 as size"])
    assert result(remove_repeats(docs, block_bytes=block_bytes)) == brute(rows, 200)


def test_other_windows_and_empty_table(documents):
    rows = [(1, "abcabcabc"), (2, "xxabcxx"), (3, "ab")]
    for window in (2, 3, 8):
        assert result(remove_repeats(documents(rows), window)) == brute(rows, window)
    assert remove_repeats(documents(rows).limit(0)).count() == 0


def test_long_text(documents, made):
    text = made(60_000, 1)
    rows = [(1, text), (2, made(300, 2) + text[1000:2000])]
    assert result(remove_repeats(documents(rows))) == brute(rows, 200)


def cut_copies(seed, alphabet, count=14):
    rng = random.Random(seed)
    pool = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 600))) for _ in range(4)]
    texts = []
    for _ in range(count):
        p = rng.choice(pool)
        low = rng.randrange(len(p))
        tail = bytes(rng.choice(alphabet) for _ in range(rng.randrange(5)))
        texts.append(p[low : low + rng.randrange(1, 500)] + tail)
    return texts


@pytest.mark.parametrize("window", [1, 2, 8, 9, 17, 31, 64, 200])
@pytest.mark.parametrize("alphabet", [b"a", b"a\0", b"ab", b"abcdefgh"])
def test_sorted_suffixes_tell_repeats(window, alphabet):
    for seed in range(4):
        texts = cut_copies(seed, alphabet)
        seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
        expected = [seen[t[i : i + window]] > 1 for t in texts for i in range(len(t) - window + 1)]
        offsets = np.cumsum([0, *map(len, texts)])
        assert repeated(np.frombuffer(b"".join(texts), np.uint8), offsets, window).tolist() == expected


def test_long_ties_of_many_suffixes(made):
    shared = made(900, 3).encode()
    texts = [shared[i % 300 : i % 300 + 400] + made(60, 10 + i).encode() for i in range(300)]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    offsets = np.cumsum([0, *map(len, texts)])
    found = repeated(np.frombuffer(b"".join(texts), np.uint8), offsets, 200)
    assert found.tolist() == [seen[t[i : i + 200]] > 1 for t in texts for i in range(len(t) - 199)]


def test_hashes_that_collide_remove_nothing(monkeypatch):
    """With one hash for all strings every window is a candidate of one bucket; bytes decide."""
    monkeypatch.setattr(textscan, "window", lambda sums, start, end: np.zeros(len(start), np.uint64))
    texts = cut_copies(5, b"abcdefgh", 30)
    block = TextBlock(np.arange(len(texts)), np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), np.uint8))
    runs = suffix._Runs(block, 60, 8)
    lengths = np.array([len(t) for t in runs.texts], np.int64)
    asked = pa.table(
        {
            "bucket": [0],
            "block": [1],
            "n": [len(runs.texts)],
            "lengths": [suffix.squeeze(lengths.tobytes())],
            "twice": [suffix.squeeze(np.packbits(runs.times > 1).tobytes())],
            "texts": [suffix.squeeze(b"".join(runs.texts))],
        }
    )
    found = suffix._told(suffix._sorted_bucket(asked, 60), 0, 1)[runs.windows]
    seen = Counter(t[i : i + 60] for t in texts for i in range(len(t) - 59))
    assert found.tolist() == [seen[t[i : i + 60]] > 1 for t in texts for i in range(len(t) - 59)]
