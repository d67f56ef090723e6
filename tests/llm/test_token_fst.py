import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfsight.llm import token_fst as t

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def spec():
    return t.compile_tokenizer(PATH)


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


def counted(spec, texts, limit=1 << 21):
    return t.token_counts(pa.array(texts, pa.string()), spec, limit)[1].tolist()


def random_texts(n, alphabet, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(length))) for _ in range(n)]


@pytest.mark.parametrize(
    "alphabet",
    [
        list("ab'strevlmd "),
        ["'", "'s", "'r", "'re", "'l", "'ll", "'t", "'v", "'S", "a", "1", " ", "  ", "\n", "\t", "!", " "],
        [" ", "\n", "\r\n", "　", " ", "\u0085", "\x1c", "x", "9", "-", "​"],
        list("the ing of and "),
        ["-", "=", "_", " ", "--------", "    "],
        ["<|endoftext|>", "<|", "|>", "endoftext", " ", "a", "\n"],
        list("é×½́中文\U0001f600\U00020000ก٠Ⅰe 'l\x00�"),
        [chr(c) for c in range(1, 0x3000, 7)],
    ],
)
def test_same_as_the_library_on_random_texts(spec, alphabet):
    texts = random_texts(400, alphabet, 60, len(alphabet))
    assert counted(spec, texts) == library(texts)


def test_every_kind_of_character(spec):
    points = [c for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1 {chr(c)}x!{chr(c)}" for c in points]
    assert counted(spec, texts) == library(texts)


def test_words_of_the_tables(spec, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = dict(zip((r.doc_id for r in docs.collect()), library(r.text or "" for r in docs.collect()), strict=True))
    got = t.count_tokens(docs, PATH).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_very_long_texts_in_parts(spec):
    words = " ".join(random_texts(30_000, "etaoinshrdlu", 12, 1))
    texts = [words, "a" * 30_000, " " * 30_000, "\n \n" * 9_000 + "x", "'" * 20_000, "ab1 " * 9_000, "中" * 9_000]
    want = library(texts)
    assert counted(spec, texts) == want
    assert counted(spec, texts, limit=500) == want


def test_parts_begin_only_where_pieces_do(spec):
    texts = random_texts(200, ["'", "'l", "'ll", "a", " ", "  ", "\n", ".", "é", "1", "<|endoftext|>"], 90, 5)
    assert counted(spec, texts, limit=3) == library(texts)


def test_starting_afresh_changes_nothing(spec, monkeypatch):
    texts = random_texts(300, "aeiou stn'", 40, 6)
    monkeypatch.setattr(t, "_MOST_STATES", 50)
    assert counted(spec, texts, limit=300) == library(texts)


def test_maps_of_stretches_compose_like_reading_on():
    rng = np.random.default_rng(3)
    classes = rng.integers(0, len(t._CLASSES), 1500)
    state, want = t.NONE, []
    for c in classes:
        state, mark = t._split_step(state, int(c))
        want.append(mark)
    assert t.split_marks(classes).tolist() == want
    maps = rng.integers(0, 7, (50, 7))
    inner, own = np.arange(7), t.prefix_scan(maps)
    for i in range(50):
        inner = maps[i][inner]
        assert own[i].tolist() == inner.tolist()


def test_nulls_repeats_and_clashing_names(documents):
    rows = [(1, None), (1, ""), (None, "two words"), (2, "x"), (2, "x")]
    more = ["7 AS n_tokens", "'c' AS n_bytes", "1 AS over_limit"]
    got = t.count_tokens(documents(rows, more), PATH, limit=1)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, 0, 0, False), (1, 0, 0, False), (None, 9, 2, True), (2, 1, 1, False), (2, 1, 1, False)], key=str
    )
    assert t.count_tokens(documents([]), PATH).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        t.compile_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
