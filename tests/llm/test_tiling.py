from shelfsight.llm.tiling import RESULT, find_leaks, remove_leaks

ITEM = "the quick brown fox jumps over the lazy dog while the small cat sleeps under an old tree"


def leaks(spark, documents, texts, items, **kw):
    table = spark.createDataFrame(items, "item_id long, text string")
    return sorted(tuple(r) for r in find_leaks(documents(texts), table, **kw).collect())


def test_copies_moved_passages_and_clean_texts(spark, documents, made):
    w = ITEM.split()
    moved = " ".join([*w[9:], made(9, 1), *w[:9]])
    half = " ".join(w[:8]) + " " + made(30, 2)
    texts = [made(40, 3) + " " + ITEM.upper() + " " + made(5, 4), moved, half, made(50, 5)]
    got = leaks(spark, documents, texts, [(7, ITEM), (8, made(20, 6))])
    assert [(r[0], r[1], r[3], r[6]) for r in got] == [(0, 7, 1, 1.0), (1, 7, 2, 1.0)]


def test_join_gives_the_same_as_broadcast(spark, documents, made):
    texts = [f"{made(9, i)} {ITEM if i % 3 == 0 else ''} {'one two three' if i % 4 == 0 else ''}" for i in range(20)]
    items = [(1, ITEM), (2, "one two three"), (3, "solo"), (4, None), (5, "")]
    one = leaks(spark, documents, texts, items)
    assert one and one == leaks(spark, documents, texts, items, broadcast_bytes=0)


def walked(doc, item, least):
    """Greedy tiling, one longest match at a time, by trying all positions."""
    gone_d, gone_i, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and i + n not in gone_i and d + n not in gone_d):
                    n += 1
                if (n, -i, -d) > (best[0], -best[1], -best[2]):
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return tiles
        tiles.append(n)
        gone_i |= set(range(i, i + n))
        gone_d |= set(range(d, d + n))


def test_same_tiles_as_trying_all_positions(spark, documents):
    import random

    rng = random.Random(4)
    items = [(i, " ".join(rng.choice("abc") for _ in range(25))) for i in range(4)]
    texts = [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(5)]
    got = {r[:2]: (r[3], r[4]) for r in leaks(spark, documents, texts, items, threshold=0.0001)}
    for d, text in enumerate(texts):
        for i, item in items:
            tiles = walked(text.split(), item.split(), 5)
            assert got.get((d, i), (0, 0)) == (len(tiles), sum(tiles))


def test_nulls_empty_tables_and_long_texts(spark, documents, made):
    docs = documents([None, "", (None, ITEM), (3, made(60_000, 1) + " " + ITEM), (3, ITEM)], ["1 as item_id"])
    items = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, None)], "item_id long, text string")
    assert sorted(str(r.doc_id) for r in find_leaks(docs, items).collect()) == ["3"] * 4 + ["None"] * 2
    assert [r.doc_id for r in remove_leaks(docs, items).orderBy("doc_id").collect()] == [None, 0, 1]
    assert find_leaks(docs.limit(0), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0
    assert find_leaks(docs, items.limit(0)).columns == [c.split()[0] for c in RESULT.split(", ")]


def test_both_paths_agree_on_odd_tables(spark, documents, made):
    phrase = "as we all know very well"
    texts = [None, "", (None, ITEM), (None, ITEM), (3, ITEM + " " + phrase), (3, ITEM), (3, made(9, 1)), (4, phrase)]
    texts += [(10 + i, f"{phrase} {made(20, i)} {ITEM.upper() if i % 2 else ''}") for i in range(8)]
    items = [(1, ITEM), (1, ITEM), (None, ITEM), (2, phrase + " " + made(20, 50)), (None, None), (5, ""), (6, made(3, 1)),
             (7, "x y x y x y x y x y z"), (8, phrase)]
    texts += [(30, "x y x y x y x y q"), (31, made(60_000, 9) + " " + ITEM)]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [sorted(map(str, find_leaks(documents(texts), table, broadcast_bytes=b).collect())) for b in (1 << 20, 0)]
    assert rows[0] == rows[1] and len(rows[0]) > 20


def test_joined_path_finds_what_any_threshold_asks(spark, documents):
    import random

    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 30)))) for i in range(12)]
    texts = [" ".join(rng.choice("abcd") for _ in range(80)) for _ in range(8)]
    for threshold in (0.05, 0.5, 1.0):
        one = leaks(spark, documents, texts, items, threshold=threshold)
        assert one == leaks(spark, documents, texts, items, threshold=threshold, broadcast_bytes=0)
