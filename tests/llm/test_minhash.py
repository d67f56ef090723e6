import random
import re

from shelfsight.llm.minhash import banding, components, keep_one, least_agreement, near_duplicates


def brute(rows, k, percent):
    sets = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    part = {d: d for d in sets}

    def root(d):
        while part[d] != d:
            d = part[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    return {(d, len(sets[d]), root(d), root(d) == d) for d in ids}


def near_copies(seed, n, words=60):
    rng = random.Random(seed)
    base = [f"b{seed}_{i}" for i in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_same_as_comparing_all_pairs(documents):
    texts = [t for s in range(6) for t in near_copies(s, 12)] + ["a", "A", "a b", "", None, "x y z"] * 2
    rows = list(enumerate(texts))
    for k in (2, 5):
        got = {tuple(r) for r in near_duplicates(documents(rows), k).collect()}
        assert got == brute(rows, k, 80)


def test_chains_of_links_in_one_bucket_are_not_lost(documents):
    # each text shifts by some words: only neighbours are similar
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 6 : i * 6 + 100])) for i in range(40)]
    got = {tuple(r) for r in near_duplicates(documents(rows), 2).collect()}
    assert got == brute(rows, 2, 80)


def test_repeated_rows_missing_ids_and_further_columns(documents):
    docs = documents([(5, "a b c"), (5, "a b c"), (None, "a b c"), (3, "a b c"), (9, None)], ["1 as a", "2 as bucket"])
    got = sorted(map(str, (tuple(r) for r in near_duplicates(docs, 2).collect())))
    assert got == sorted(map(str, [(5, 2, 3, False), (5, 2, 3, False), (None, 2, None, True), (3, 2, 3, True), (9, 0, 9, True)]))
    assert near_duplicates(docs.limit(0)).count() == 0
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "9", "None"]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 300)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(1, 101)} | {(1000 + i, 1000) for i in range(1, 300)}


def test_bands_and_agreement_follow_the_threshold():
    assert banding(80) == (32, 4) and least_agreement(80) == 80
    for percent in range(20, 101, 5):
        bands, rows = banding(percent)
        assert bands * rows <= 128 and (1 - (percent / 100) ** rows) ** bands <= 1e-7
    assert banding(0) == (128, 1) and least_agreement(0) == 0 and least_agreement(100) == 128


def test_other_thresholds_lose_no_link(documents):
    rng = random.Random(4)
    rows = []
    for s in range(8):
        base = [f"w{s}_{i}" for i in range(120)]
        for _ in range(8):
            # two copies that keep some 60 to 90 % of the words share 35 to 85 % of the pairs
            copy = list(base)
            for _ in range(rng.randrange(2, 26)):
                copy[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    for percent in (40, 60, 90):
        got = {tuple(r) for r in near_duplicates(documents(rows), 2, percent).collect()}
        assert got == brute(rows, 2, percent)


def test_many_copies_of_one_text_and_many_texts_of_one_leader(documents):
    rows = [(i, "the same old text again and again") for i in range(300)]
    rows += [(1000 + i, None if i % 2 else " ") for i in range(300)]
    rows += [(2000 + i, t) for i, t in enumerate(near_copies(9, 120, words=90))]
    got = {tuple(r) for r in near_duplicates(documents(rows), 2).collect()}
    assert got == brute(rows, 2, 80)
