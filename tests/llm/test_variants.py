import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from shelfsight.llm import variants as v


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(counts):
    out = {}
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        out[word] = (word, form[word], root, counts[word], len(near[word]), counts.get(form[word]))
    return sorted(out.values())


def grouped(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(map(tuple, v.group_variants(words).collect()))


def made_words(n, alphabet, seed):
    """Words and edits of them, so that many are near each other."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9))) for _ in range(n)}
    for word in list(words):
        for _ in range(3):
            at, letter = rng.randrange(len(word) + 1), rng.choice(alphabet)
            words |= {word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :]}
    return {w: rng.choice([3, 3, 4, 6, 9, 20, 100]) for w in sorted(words) if len(w) >= 5}


@pytest.mark.parametrize("alphabet, rare", [("ab", 1), ("abcdé÷", 64), ("abcdefghij", 2)])
def test_same_as_all_pairs(spark, monkeypatch, alphabet, rare):
    monkeypatch.setattr(v, "_RARE", rare)
    counts = made_words(120, alphabet, rare)
    assert grouped(spark, counts) == by_hand(counts)


def test_any_edit_leaves_a_listed_gram(monkeypatch):
    """The bound itself, on every edit of random words under random dictionaries."""
    rng = random.Random(7)
    for _ in range(150):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(5, 8)))
        grams = {"".join(rng.choice("\x02abc\x03") for _ in range(rng.randint(2, 4))) for _ in range(60)}
        frequent = {g: rng.randint(1, 9) for g in grams}
        assert v.affected(v.decompose(word, frequent)) < len(v.decompose(word, frequent))
        own = set(v.listed(word, frequent))
        for at in range(len(word) + 1):
            for other in (word[:at] + "b" + word[at:], word[:at] + "c" + word[at + 1 :]):
                if not one_edit(word, other):
                    continue
                shift = len(other) - len(word)
                theirs = set(v.listed(other, frequent))
                assert any((g, p + s) in theirs for g, p in own for s in {0, shift}), (word, other)


def test_words_with_one_gram_in_common_everywhere(spark):
    counts = {f"prefixes{a}{b}suffixes": 3 + (a == b) * 9 for a in "abcdefghijkl" for b in "abcdefghijkl"}
    assert grouped(spark, counts) == by_hand(counts)


def test_chains_ties_and_very_long_words(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "zzzzz": 5,
              "x" * 3000: 3, "x" * 3001: 7, "x" * 2999 + "y": 7, "tieaa": 4, "tieab": 8, "tieac": 8}
    assert grouped(spark, counts) == by_hand(counts)


def words_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def test_words_of_documents(documents):
    rng = random.Random(4)
    vocabulary = ["Straße", "ÉTUDE", "été", "Garden", "gardens", "GARDEN", "a×b÷cd", "naïveté", "don't", "x1y2zzzzz"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=200))) for i in range(150)]
    rows += [(None, "nullish words nullish words nullish"), (3, None), (4, ""), rows[0], rows[0], (5, "long" * 90_000)]
    docs = documents(rows, ["1 AS word", "'x' AS run", "2 AS n", "3 AS doc"])
    want = words_by_hand(rows)
    got = {r.word: r.n for r in v.word_counts(v.document_words(docs)).collect()}
    assert got == want and any(len(w) < 6 for w in want)
    assert sorted(map(tuple, v.spelling_variants(docs).collect())) == by_hand(want)


def test_empty_tables(documents):
    for docs in (documents([]), documents([None, "", "one two"])):
        out = v.spelling_variants(docs)
        assert out.collect() == [] and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_the_dictionary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(v, "_RARE", 0)
    monkeypatch.setattr(v, "DICTIONARY", 10)
    words = spark.range(300).select(F.concat(F.lit("w"), F.translate(F.hex("id"), "0123456789", "ghijklmnop"),
                                             F.lit("end")).alias("word"), F.lit(3).alias("n"))
    sizes = Counter(len(g) for g in v.gram_dictionary(words))
    assert sizes and max(sizes.values()) <= 10
