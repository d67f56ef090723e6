import math
from collections import Counter

import pytest

from shelfsight.llm.lm import score_texts


def brute(rows, order=3, alpha=0.4):
    texts = [(t or "").split() for _, t in rows]

    def grams(words):
        return Counter(tuple(words[i - k : i]) for k in range(1, order + 1) for i in range(k, len(words) + 1))

    every = sum((grams(w) for w in texts), Counter())
    total, out = sum(map(len, texts)), []
    for (doc_id, _), words in zip(rows, texts, strict=True):
        other = every - grams(words)
        rest, score = max(total - len(words), 1), 0.0
        for p in range(1, len(words) + 1):
            longest = min(order, p)
            for k in range(longest, 0, -1):
                gram = tuple(words[p - k : p])
                if other[gram]:
                    below = other[gram[:-1]] if k > 1 else rest
                    score += math.log(other[gram] / below) + (longest - k) * math.log(alpha)
                    break
            else:
                score += -math.log(rest) + longest * math.log(alpha)
        out.append((doc_id, len(words), round(score, 6)))
    return sorted(out, key=str)


def scores(df):
    return sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_bytes", [1, 200, 8 << 20])
def test_same_as_counting_by_hand(documents, block_bytes):
    rows = [(1, "a b c a b c d"), (2, "a b c x"), (3, "b c a b"), (4, ""), (5, None), (6, "lonely"),
            (2, "a b c x"), (None, "a b a b a b")]
    docs = documents(rows, ["1 as block", "2 as n"])
    assert scores(score_texts(docs, block_bytes=block_bytes)) == brute(rows)
    assert score_texts(docs.limit(0)).count() == 0


def test_text_without_words_has_no_mean(documents):
    row = score_texts(documents([None])).first()
    assert (row.n_words, row.log_score, row.mean_log_score) == (0, 0.0, None)


def test_long_text(documents, made):
    text = made(120_000, 1)
    rows = {r.doc_id: r for r in score_texts(documents([text, text])).collect()}
    assert rows[0].n_known == rows[0].n_words == 120_000
    assert rows[0].log_score == rows[1].log_score
