import numpy as np
import pytest

from shelfsight.llm import multi_index
from shelfsight.llm.multi_index import Codebook, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    fine = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, v in fine:
        if q in queries:
            best = sorted((-float(v @ x), i) for i, x in fine if i != q)[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(spark, rows, step):
    table = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], SCHEMA)
    queries = table.where(f"vec_id % {step} = 0").select("vec_id")
    got = found(nearest(table, queries, 20))
    want = brute([(i, np.float32(v)) for i, v in rows], {i for i, _ in rows if i % step == 0}, 20)
    assert got.keys() == want.keys()
    for q, best in got.items():
        exact = dict(brute([(i, np.float32(v)) for i, v in rows], {q}, len(rows))[q])
        assert all(score == pytest.approx(exact[i], rel=1e-12) for i, score in best)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values()))


def test_recall_on_clusters_and_on_noise(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    clustered = [(i, centres[i % 20] + 0.1 * rng.normal(size=16)) for i in range(1500)]
    noise = [(i, rng.normal(size=17)) for i in range(800)]
    assert recall(spark, clustered, 60) >= 0.9
    assert recall(spark, noise, 40) >= 0.9


def test_recall_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert recall(spark, rows, 20) >= 0.9


def test_cells_come_in_falling_order(spark):
    rng = np.random.default_rng(2)
    book = Codebook(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)), 1.0)
    query = rng.normal(size=6)
    cells = book.walk(query, np.ones(35, int), np.inf)
    sums = ((book.first @ query[:3])[:, None] + book.second @ query[3:]).ravel()
    assert sorted(cells) == list(range(35))
    assert np.all(np.diff(sums[cells]) <= 1e-12)
    assert len(book.walk(query, np.ones(35, int), 4)) == 4


def test_identical_vectors_fill_several_shards(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "SHARD", 50)
    rows = [(i, [1.0, 0.0, 0.0, 1.0], 0) for i in range(400)] + [(1000 + i, [0.0, 1.0, float(i), 0.0], 0) for i in range(9)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = found(nearest(table, table.where("vec_id in (7, 1008)").select("vec_id")))
    assert [i for i, _ in got[7]] == [i for i in range(21) if i != 7]
    assert [i for i, _ in got[1008]][:3] == [1007, 1006, 1005]


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (20, [2.0, 1.0], 1), (1, None, 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1),
            (4, [0.0, 0.0], 1), (5, [None, 1.0], 1), (6, [1.0], 1), (None, [1.0, 1.0], 1), (40, [], 1), (60, None, 1)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as shard", "2 as cell")
    queries = table.where("vec_id % 20 = 0").select("vec_id")
    assert found(nearest(table, queries)) == {0: [(20, 4.0)], 20: [(0, 4.0)]}
    assert nearest(table.limit(0), queries).count() == 0
    assert nearest(table, queries.limit(0)).count() == 0
