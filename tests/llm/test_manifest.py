import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from shelfsight.llm import manifest as m
from shelfsight.llm.queries import tampered_text


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*(field(v) for v in (row.doc_id, row.source, row.lang, row.n_chars)), field(text))


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def by_hand(rows):
    """Sort, hash, and recompute the root of a changed leaf by building the way up again."""
    groups = {}
    for row in rows:
        groups.setdefault(row.source, []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        own = sorted(
            groups[source],
            key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)),
        )
        trees[source] = (own, up([leaf(r, r.text) for r in own]))
    top = up([trees[s][1][-1][0] for s in order])
    out = []
    for number, source in enumerate(order):
        own, levels = trees[source]
        for place, row in enumerate(own):
            changed = row.text
            if row.doc_id is not None and crc32(str(row.doc_id).encode()) % 2 == 0 and changed:
                changed = changed.replace("\n", "")
            digest, proof = leaf(row, changed), ""
            for tree, at in ((levels, place), (top, number)):
                for level in tree[:-1]:
                    first = at - at % 3
                    run = level[first : first + 3]
                    proof += "".join(run[: at - first] + run[at - first + 1 :])
                    run[at - first] = digest
                    digest, at = h(*run), at // 3
            root = top[-1][0]
            out.append((row.doc_id, leaf(row, row.text), levels[-1][0], root, h(proof), digest, digest == root))
    return sorted(out, key=str)


def found(docs):
    return sorted(map(tuple, m.manifest(docs, claims={"text": tampered_text()}).collect()), key=str)


@pytest.mark.parametrize("n, sources", [(1, 1), (3, 1), (4, 4), (700, 2), (900, 40)])
def test_same_as_by_hand(documents, n, sources):
    rng = random.Random(n)
    ids = rng.sample(range(-300, 200_000), n)
    docs = documents([(i, f"text {i}\n\nend", f"s{rng.randrange(sources) ** 2}") for i in ids])
    assert found(docs) == by_hand(docs.collect())


def test_nulls_ties_and_repeated_rows(documents):
    rows = [(5, "a\nb", "x"), (5, "a\nb", "x"), (5, None, "x"), (5, "", "x"), (None, "n", "x"),
            (None, "n", "x"), (None, None, None), (7, "é" * 200_000 + "\n", None), (64, "q", "x"),
            (63, "q", "x"), (-1, "q", "x"), (2**62, "far", "x"), (5, "a\nb", None)]
    docs = documents([r if r[2] else (*r[:2], None) for r in rows])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 6, F.col("lang")))
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") != 64, F.col("n_chars")))
    assert found(docs) == by_hand(docs.collect())


def test_many_copies_of_one_row(documents, monkeypatch):
    monkeypatch.setattr(m, "_COPIES", 7)
    docs = documents([(9, "same\n", "x")] * 60 + [(10, "other", "x")])
    assert found(docs) == by_hand(docs.collect())


def test_empty_table_and_clashing_names(documents):
    assert m.manifest(documents([]), claims={"text": tampered_text()}).collect() == []
    rows = [(1, "a\n", "x"), (2, "b", "y")]
    more = ["1 AS pos", "'t' AS tree", "2 AS digest", "3 AS `group`", "'c' AS claim", "4 AS bit"]
    assert found(documents(rows, more)) == by_hand(documents(rows).collect())


def test_without_claims_everything_verifies(documents):
    docs = documents([(i, f"t{i}\n") for i in range(20)])
    out = m.manifest(docs, fields=["doc_id", "text"]).collect()
    assert all(r.verified and r.folded_root == r.root for r in out) and len(out) == 20


def test_ranks_come_from_bitmaps(documents):
    leaves = documents([(i, "") for i in (0, 3, 3, 63, 64, 200)]).selectExpr("source AS group", "doc_id")
    words = {r.word: r for r in m.id_bitmaps(leaves).collect()}
    assert {w: (bin(r.bits % 2**64).count("1"), r.rows) for w, r in words.items()} == {
        0: (3, 4), 1: (1, 1), 3: (1, 1)
    }
    assert [(r.bit, r.more) for r in words[0].repeats] == [(3, 1)]
