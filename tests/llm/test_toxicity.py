import random
import zlib

import numpy as np
import pytest

from shelfsight.llm.queries import QUERIES
from shelfsight.llm.toxicity import Restorer, character_model, choose, drop_toxic, fit, score_texts

WORDS = "the small garden has many green plants and an idiot scum stupid moron walks along this river".split()


@pytest.fixture
def corpus(documents):
    rng = random.Random(3)
    return documents([" ".join(rng.choice(WORDS) for _ in range(60)) for _ in range(200)])


def test_disguises_are_read(corpus):
    restorer = Restorer(character_model(corpus))
    text = "an 1d10t and st*u*p*i*d m o r o n, sc.u.m  iidiiioot $tup1d!! garden"
    assert {"idiot", "stupid", "moron", "scum", "garden"} <= restorer.words(text)
    plain = "plain words, with 12 numbers & signs ### stay"
    assert restorer.words(plain) == {"plain", "words", "with", "numbers", "signs", "stay"}


def test_counts_are_of_all_texts(documents):
    model = character_model(documents(["abab", None, "", "abac"]))
    assert model[1, 2].argmax() == 1 and model[2, 1, 2] < model[2, 1, 3] + 1
    assert model[2, 1, 3] > model[2, 1, 4] + 1
    assert np.exp(model).sum(2) == pytest.approx(1, abs=1e-3)


def test_words_beside_a_toxic_one_are_not_learnt():
    copies = [(1, ["bad", "by"], [1] * 8)] * 30 + [(1, ["bad", f"o{i}"], [i] * 8) for i in range(30)]
    weights, base = choose(copies + [(0, ["fine"], [0] * 8)] * 300, 1.0)
    assert set(weights) == {"bad"} and weights["bad"] > 0.9 and base < 0.01


def test_toxic_words_that_others_explain_are_learnt():
    rows = [(1, ["bad", "worse"], [i] * 8) for i in range(20)] + [(1, ["bad"], [99] * 8)]
    weights, _ = choose(rows + [(0, [], [0] * 8)] * 300, 1.0)
    assert set(weights) == {"bad", "worse"}


def labelled(documents, spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrs')}{rng.choice('aeiou')}k{rng.randrange(9)}" for _ in range(40)]
        if toxic:
            words[rng.randrange(40)] = rng.choice(["lowei", "vequ"]) + rng.choice("abcdefgh") + "n"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents):
    docs, labels = labelled(documents, spark)
    scored = {r.doc_id: r.toxicity for r in score_texts(docs, fit(docs, labels)).collect()}
    out = [i for i in scored if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(out) > 60
    assert all((scored[i] >= 0.7) == (i % 5 == 0) for i in out)


def test_nulls_empty_unlabelled_and_further_columns(spark, documents):
    docs, labels = labelled(documents, spark)
    model = fit(docs, labels.union(spark.createDataFrame([(None, 1, 1), (1, 1, None), (10**12, 1, 1)], labels.schema)))
    odd = documents([None, "", (None, "loweian x"), (7, "loweian " + "word " * 50_000), (7, "fine")], ["1 as toxicity", "2 as toxic"])
    rows = score_texts(odd, model).collect()
    assert len(rows) == 5 and sum(r.toxicity >= 0.7 for r in rows) == 2
    assert score_texts(odd.limit(0), model).count() == 0
    blind = fit(docs, labels.limit(0))
    assert {r.toxicity for r in score_texts(odd, blind).collect()} == {0.5}
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 240


def test_query_on_the_table(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    out = [(rows[r.doc_id].predicted, r.toxic) for r in labels if rows[r.doc_id].held_out]
    clean = [p for p, t in out if not t]
    assert len(clean) > 10 and sum(clean) / len(clean) < 0.1
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())


def test_every_lattice_with_several_readings_is_read(corpus):
    restorer = Restorer(character_model(corpus))
    for text in ("(1d10t),", "an 1d1ot.", "iddiot", "5tup1d)", "i  d  i  o  t", "i\td\ti\to\tt", "i\nd\ni\no\nt", "i, d, i, o, t", "1 d ! 0 t"):
        assert "idiot" in restorer.words(text) or "stupid" in restorer.words(text), text
    assert "stupid" in restorer.words("'stuppid',")


def every_reading(chars, model):
    """The best score over all ways through a lattice, and the texts that have it."""
    from itertools import product

    from shelfsight.llm import toxicity as tox

    best, texts = -np.inf, set()
    for way in product(*tox._readings(chars)):
        score, a, b = 0.0, 0, 0
        for reading, cost in way:
            score -= cost
            if reading:
                c = tox.symbol(reading)
                score += model[a, b, c]
                a, b = b, c
        score += model[a, b, 0]
        text = "".join(r for r, _ in way)
        if score > best + 1e-9:
            best, texts = score, {text}
        elif abs(score - best) <= 1e-9:
            texts.add(text)
    return texts


def test_the_decoder_finds_the_best_of_all_readings(corpus):
    from shelfsight.llm.toxicity import decode

    model = character_model(corpus).astype(float)
    rng = random.Random(9)
    for _ in range(150):
        chars = "".join(rng.choice("idto1103.-aam$!") for _ in range(rng.randint(1, 7)))
        assert decode(chars, model.ravel().tolist()) in every_reading(chars, model), chars


def test_plain_and_doubled_letters_read_as_if_decoded(corpus):
    restorer = Restorer(character_model(corpus))
    rng = random.Random(10)
    words = [*WORDS, "iddiot", "stuppid", "Straße", "éé", "naïve", "ΟΔΟΣ", "don't", "x²", "a·b", "12", ""]
    for _ in range(3000):
        word = rng.choice(words)
        if word and rng.random() < 0.5:
            at = rng.randrange(len(word))
            word = word[:at] + word[at] * rng.randint(1, 3) + word[at:]
        token = rng.choice(["", "(", "!", "\"", "-"]) + rng.choice([word, word.upper()]) + rng.choice(["", ",", "!", "…", ").", "'"])
        assert restorer.token(token) == restorer._decoded(token.lower()), token


def test_memory_forgets_the_oldest(corpus):
    small, large = (Restorer(character_model(corpus), limit=n) for n in (4, 50_000))
    text = " ".join(f"{w}{w[-1]}{i}d10t" for i, w in enumerate(WORDS))
    assert small.words(text) == large.words(text) and len(small._seen) <= 4
