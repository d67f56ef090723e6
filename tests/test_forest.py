"""The forest against a plain recursive walk, and the settings that it promises."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsight.operators import forest as fo

FEATURES = ["u", "v", "w", "z", "constant"]


def made(n, seed, levels=12):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, len(FEATURES))).astype(float)
    x[:, 4] = 1.0
    y = (x[:, 0] + x[:, 1] + rng.normal(0, 4, n) > levels).astype(int)
    return x, y


def frame(spark, x, y):
    rows = [(f"k{i}", *map(float, r), int(label)) for i, (r, label) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["key", *FEATURES, "label"]).repartition(3)


def draws(n, tree):
    out = []
    for i in range(n):
        digest = hashlib.md5(f"k{i}".encode()).hexdigest()
        a, b = int(digest[:15], 16) % fo.PRIME, int(digest[16:31], 16) % fo.PRIME
        out.append(sum((a * (tree + 1) + b) % fo.PRIME >= bound for bound in fo.POISSON))
    return np.array(out)


def walk(x, y, k, weights, way, depth, settings):
    """(rows, feature, bin, left, right) or (rows, zeros, ones), one node after the other."""
    zeros, ones = int(k[y == 0].sum()), int(k[y == 1].sum())
    leaf = (len(y), zeros, ones)
    if len(y) < settings.split or not zeros or not ones or depth == settings.depth:
        return leaf
    order = fo._feature_order(way, x.shape[1])[0]
    for first in range(0, len(order), settings.tried):
        best = None
        for f in order[first : first + settings.tried]:
            for cut in sorted(set(x[:, f])):
                left = x[:, f] <= cut
                if left.sum() < settings.leaf or (~left).sum() < settings.leaf:
                    continue
                z, o = int(k[left & (y == 0)].sum()), int(k[left & (y == 1)].sum())
                gain = fo._gain(np.array([z]), np.array([o]), zeros, ones, weights)[0]
                if best is None or gain > best[0]:
                    best = (gain, int(f), int(cut), left)
        if best:
            _, f, cut, left = best
            sides = [
                walk(x[s], y[s], k[s], weights, fo._child(way, i), depth + 1, settings)
                for i, s in enumerate((left, ~left))
            ]
            return (len(y), f, cut, *sides)
    return leaf


def nested(forest, tree):
    low = forest.start[tree]

    def node(n):
        at = low + n
        if forest.feature[at] < 0:
            return (int(forest.rows[at]), int(forest.zeros[at]), int(forest.ones[at]))
        return (int(forest.rows[at]), int(forest.feature[at]), int(forest.bin[at]),
                node(forest.left[at]), node(forest.right[at]))

    return node(0)


@pytest.fixture(scope="module")
def fitted(spark):
    x, y = made(260, 1)
    return x, y, fo.fit_forest(frame(spark, x, y), FEATURES, F.col("key"), num_trees=7, max_depth=6, seed=3)


def test_same_as_a_plain_walk(fitted):
    x, y, forest = fitted
    binned = fo._binned(x.T, forest.edges)
    settings = fo.Settings(7, 6, 5, 2, 2, 3)
    for tree in range(7):
        k = draws(len(y), tree)
        inside = k > 0
        want = walk(binned[inside], y[inside], k[inside], forest.weights[tree], fo._root_way(3, tree), 0, settings)
        assert nested(forest, tree) == want


def test_histograms_and_tasks_make_the_same_trees(spark, fitted):
    x, y, forest = fitted
    for local in (1, 20, 120):
        other = fo.fit_forest(
            frame(spark, x, y), FEATURES, F.col("key"), num_trees=7, max_depth=6, seed=3, local_rows=local
        )
        assert [nested(other, t) for t in range(7)] == [nested(forest, t) for t in range(7)]


def test_weights_are_drawn_for_each_tree(spark, fitted):
    x, y, forest = fitted
    rows = fo.tree_weights(frame(spark, x, y), 7, "label", F.col("key")).orderBy("tree").collect()
    for row in rows:
        k = draws(len(y), row.tree)
        zeros, ones = k[y == 0].sum(), k[y == 1].sum()
        assert (row.rows, row.zeros, row.ones) == ((k > 0).sum(), zeros, ones)
        assert row.weight_0 * zeros == pytest.approx(row.weight_1 * ones) == pytest.approx(k.sum() / 2)
    assert len({row.weight_1 for row in rows}) == 7
    assert forest.weights.tolist() == [[r.weight_0, r.weight_1] for r in rows]


def test_no_split_below_five_rows_and_no_leaf_below_two(spark):
    x, y = made(400, 5, levels=60)
    forest = fo.fit_forest(frame(spark, x, y), FEATURES, F.col("key"), num_trees=5, max_depth=40)
    split = forest.feature >= 0
    assert forest.rows[split].min() >= 5 and forest.rows.min() >= 2
    other = fo.fit_forest(frame(spark, x, y), FEATURES, F.col("key"), num_trees=5, max_depth=40, min_split=4)
    assert other.rows[other.feature >= 0].min() == 4


def test_scores_are_means_of_weighted_leaf_shares(spark, fitted):
    x, y, forest = fitted
    df = frame(spark, x, y)
    got = {r.key: r.score for r in fo.score(forest, df).collect()}
    one = replace(forest, start=forest.start[:2], weights=forest.weights[:1])

    def share(tree, row):
        node = nested(forest, tree)
        while len(node) > 3:
            node = node[3] if row[node[1]] <= node[2] else node[4]
        zeros, ones = np.array(node[1:]) * forest.weights[tree]
        return ones / (zeros + ones)

    binned = fo._binned(x.T, forest.edges)
    for i in range(0, 260, 13):
        assert got[f"k{i}"] == pytest.approx(np.mean([share(t, binned[i]) for t in range(7)]))
    assert one.scores(list(x.T))[0] == pytest.approx(share(0, binned[0]))
    auc = np.mean([a > b for a in [got[f"k{i}"] for i in np.flatnonzero(y == 1)]
                   for b in [got[f"k{i}"] for i in np.flatnonzero(y == 0)]])
    assert auc > 0.8


def test_draws_have_the_shares_of_a_poisson():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, fo.PRIME, (2, 200_000))
    k = fo._drawn(a, b, 17)
    assert k.mean() == pytest.approx(1, abs=0.01) and (k == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)


def test_rows_are_ordered_by_counting_digits():
    rng = np.random.default_rng(5)
    for nodes in (1, 300, 1 << 17):
        node, value = rng.integers(0, nodes, 50_000), rng.integers(0, 256, 50_000).astype(np.uint8)
        by = fo._by_node_and_bin(node, value)
        assert (by == np.argsort(node * fo.BINS + value, kind="stable")).all()
    assert len(fo._by_node_and_bin(np.zeros(0, np.int64), np.zeros(0, np.uint8))) == 0


def test_sums_of_draws_without_products_and_of_other_labels(spark):
    rng = np.random.default_rng(5)
    a, b = (np.append(rng.integers(0, fo.PRIME, 3000), [0, fo.PRIME - 1]) for _ in range(2))
    sums = np.zeros((3, 50), np.int64)
    fo._add_draws(sums, 2, a, b)
    fo._add_draws(sums, None, a[:100], b[:100])
    for tree in range(50):
        drawn = fo._drawn(a, b, tree)
        assert sums[:, tree].tolist() == [np.sum(drawn > 0) + np.sum(drawn[:100] > 0), 0, drawn.sum()]
    # a row without label is drawn but weighs nothing; one without key is not drawn
    rows = spark.createDataFrame(
        [("k0", 1), ("k1", 0), ("k2", None), (None, 1)], "key string, label int"
    )
    weights = fo.tree_weights(rows, 9, "label", F.col("key"))
    got = {r.tree: (r.rows, r.zeros, r.ones, r.weight_0, r.weight_1) for r in weights.collect()}
    assert sorted(got) == list(range(9))
    for tree in range(9):
        k = draws(3, tree).tolist()
        total = k[0] + k[1]
        assert got[tree] == (sum(v > 0 for v in k), k[1], k[0],
                             total / (2 * k[1]) if k[1] else 0.0, total / (2 * k[0]) if k[0] else 0.0)
    assert fo.tree_weights(rows.limit(0), 3, "label", F.col("key")).count() == 0


def test_whole_trees_are_grown_where_their_rows_are_drawn(spark, monkeypatch):
    # nodes on both sides of the sizes at which rows are summed, picked and grown together
    x, y = made(900, 7, levels=40)
    data = frame(spark, x, y).localCheckpoint()
    edges = fo._edges(data, FEATURES)
    blocks = fo._blocks(data, FEATURES, "label", F.col("key"), edges)
    settings = fo.Settings(5, 8, 5, 2, 2, 3)
    tops = {}
    for row in fo.tree_weights(data, 5, "label", F.col("key")).collect():
        tops[row.tree] = fo._Top((row.weight_0, row.weight_1))
        tops[row.tree].add(row.zeros, row.ones, row.rows, 0, int(fo._root_way(3, row.tree)[0]))
    grown = fo._grow_whole(blocks, tops, len(FEATURES), settings)
    subtrees = {(r.tree, r.node): {c: np.frombuffer(r[c], k) for c, k in fo._NODE.items()} for r in grown.collect()}
    forest = fo._assembled(tuple(FEATURES), edges, tops, subtrees)
    binned = fo._binned(x.T, edges)
    for tree in range(5):
        k = draws(len(y), tree)
        inside = np.flatnonzero(k)
        want = walk(binned[inside], y[inside], k[inside], forest.weights[tree], fo._root_way(3, tree), 0, settings)
        assert nested(forest, tree) == want
        for chunk, small, sparse in ((28, 5, 1), (300, 100, 3), (2000, 1000, 8)):
            monkeypatch.setattr(fo, "_CHUNK", chunk)
            monkeypatch.setattr(fo, "_SMALL", small)
            monkeypatch.setattr(fo, "_SPARSE", sparse)
            packed = fo._packed(y[inside].astype(np.uint8), k[inside].astype(np.uint8))
            alone = fo.grow(
                np.ascontiguousarray(binned.T), inside, packed, forest.weights[tree], fo._root_way(3, tree), 0, settings
            )
            assert nested(fo._assembled(tuple(FEATURES), edges, {0: tops[tree]}, {(0, 0): alone}), 0) == want
        monkeypatch.undo()


def test_cuts_are_values_at_exact_ranks_and_close_to_them_in_large_stretches(spark, monkeypatch):
    rows = spark.createDataFrame([(float(i % 1000), None if i % 3 else 5.0) for i in range(6000)], "u double, v double")
    ranks = np.unique(np.ceil(np.arange(1, 256) / 256 * 6000).astype(int))
    exact = np.unique(np.sort(np.arange(6000) % 1000)[ranks - 1])
    found = fo._edges(rows.repartition(4), ["u", "v"])
    assert found[0].tolist() == exact[exact < 999].tolist() and found[1].tolist() == []
    values, times = fo._counts(np.random.default_rng(1).normal(0, 1, 50_000))
    assert len(values) == fo._RANKS and times.sum() == 50_000 and times.max() == 5
    values, times = fo._counts(np.array([2.0, 1.0, 2.0]))
    assert (values.tolist(), times.tolist()) == ([1.0, 2.0], [1, 2])


def test_rows_move_once_for_a_group_of_trees(spark):
    x, y = made(2000, 9)
    data = frame(spark, x, y)
    blocks = fo._blocks(data, FEATURES, "label", F.col("key"), fo._edges(data, FEATURES))
    top = fo._Top((1.0, 1.0))
    top.add(5, 5, 10, 0, 1)
    grown = fo._grow_whole(blocks, dict.fromkeys(range(40), top), len(FEATURES), fo.Settings(40, 2, 5, 2, 2, 3))
    groups = min(40, fo._GROUPS_A_CORE * spark.sparkContext.defaultParallelism)
    assert grown.rdd.getNumPartitions() == groups < 40 and grown.count() == 40


def test_no_more_passes_where_a_task_holds_a_tree(spark, monkeypatch):
    # 140,000 drawn rows of a tree were split by passes over all rows before
    data = spark.range(240_000).selectExpr(
        "cast(id as string) AS key", *(f"cast(id % {i + 3} as double) AS {f}" for i, f in enumerate(FEATURES)),
        "cast(id % 7 < 3 as int) AS label")
    passes = []
    split = fo._split_large
    monkeypatch.setattr(fo, "_split_large", lambda *args: passes.append(1) or split(*args))
    forest = fo.fit_forest(data, FEATURES, F.col("key"), num_trees=2, max_depth=3)
    assert not passes and len(forest.weights) == 2 and forest.rows.max() > 1 << 17
