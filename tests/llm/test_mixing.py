import corpus_pipeline
from pyspark.sql import functions as F

from shelfsight.llm.mixing import draw_documents, emit_mix, mix_documents, source_targets


def targets(spark, sizes, **kw):
    table = spark.createDataFrame(sizes, "source string, source_size long")
    return {r.source: r.target for r in source_targets(table, **kw).collect()}


def test_excess_goes_to_the_others_by_weight(spark):
    # 150 % of 220 is 330; a and b stop at twice their size
    assert targets(spark, [("a", 10), ("b", 10), ("c", 200)]) == {"a": 20, "b": 20, "c": 290}


def test_clamping_in_rounds(spark):
    got = targets(spark, [("a", 40), ("b", 40), ("c", 400), (None, 120)])
    assert got["a"] == 80 and got["b"] == 80
    assert abs(sum(got.values()) - 900) < 1e-9
    assert got[None] == 240 and got["c"] == 500


def test_sources_without_words_and_no_sources(spark):
    assert targets(spark, [("a", 0), ("b", 10)])["a"] == 0
    assert targets(spark, []) == {}


def test_taken_follows_the_target_and_reruns_agree(spark, documents, made):
    docs = documents([(i, made(i % 50, i), "ab"[i % 2]) for i in range(200)])
    mixed = mix_documents(docs)
    rows = mixed.collect()
    assert sorted(rows) == sorted(mixed.collect())
    for source in "ab":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.mix_taken for r in own) - own[0].mix_target) < len(own)
        assert all(r.mix_taken <= 2 * r.mix_size for r in own)


def test_nulls_empty_ties_and_clashing_names(spark, documents):
    docs = documents([(1, None, None), (1, None, None), (2, "", "a"), (None, "x y", "a"), (3, "x y", "a")],
                     ["1 as mix_size", "2 as position"])
    rows = mix_documents(docs).collect()
    assert len(rows) == 5
    assert {r.mix_taken for r in rows if r.mix_size == 0} == {0}
    assert mix_documents(docs.limit(0)).count() == 0


def test_the_mix_holds_what_was_taken(documents, made):
    docs = documents([(i, made(10 + i, i), "abc"[i % 3]) for i in range(30)])
    mixed = mix_documents(docs).cache()
    out = emit_mix(mixed)
    words = out.groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n"))
    want = {r.doc_id: r.mix_taken for r in mixed.collect() if r.mix_taken}
    assert {r.doc_id: r.n for r in words.collect()} == want


def test_whole_documents_are_drawn_and_one_is_cut(documents, made):
    docs = documents([(i, made(10 + i % 9, i).replace(" ", "\n", 1), "a" if i < 30 else "bcde"[i % 4]) for i in range(90)])
    drawn = draw_documents(docs, weights=(1, 9, 9, 9, 1)).cache()
    rows = drawn.collect()
    assert sorted(rows) == sorted(draw_documents(docs, weights=(1, 9, 9, 9, 1)).collect())
    own = [r for r in rows if r.source == "a"]
    assert own[0].mix_target < own[0].mix_source_size  # less than once: some whole, some not at all
    assert sum(r.mix_whole == 1 for r in own) > 1 and sum(r.mix_taken == 0 for r in own) > 1
    for source in "abcde":
        own = [r for r in rows if r.source == source]
        assert sum(r.mix_taken for r in own) == int(own[0].mix_target)
        assert sum(r.mix_part > 0 for r in own) <= 1 and all(r.mix_part < r.mix_size for r in own)
    texts = {r.doc_id: r.text for r in rows}
    out = emit_mix(drawn).collect()
    assert all(r.text in texts[r.doc_id] for r in out)  # cut ones are runs of the text, line ends kept
    assert sum(r.text != texts[r.doc_id] for r in out) <= 5
    assert sum(len(r.text.split()) for r in out) == sum(r.mix_taken for r in rows)


def test_drawing_nulls_copies_and_nothing(documents):
    docs = documents([(1, None, None), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "x y z", None), (4, " ", "b")])
    rows = draw_documents(docs).collect()
    assert len(rows) == 6 and {r.mix_taken for r in rows if r.mix_size == 0} == {0}
    assert sum(r.mix_taken for r in rows if r.source is None) == int(next(r for r in rows if r.source is None).mix_target)
    assert draw_documents(docs.limit(0)).count() == 0


def test_the_pipeline_emits_whole_documents(spark, documents, made):
    docs = documents([(i, made(40, i), "a" if i < 30 else "b") for i in range(40)])
    texts = {r.text for r in docs.collect()}
    out = [r.text for r in corpus_pipeline.mix(spark, docs, "").collect()]
    assert sum(t not in texts for t in out) <= 2


def test_working_names_do_not_clash(documents, made):
    extra = ["1 as __mix_size", "2 as __source", "3 as mix_part", "4 as __mix__salt"]
    rows = [(i, made(5 + i, i), "ab"[i % 2]) for i in range(12)]
    for mix in (draw_documents, mix_documents):
        plain = sorted((r.doc_id, r.mix_taken) for r in mix(documents(rows)).collect())
        named = mix(documents(rows, extra)).collect()
        assert sorted((r.doc_id, r.mix_taken) for r in named) == plain
        assert {(r["__mix_size"], r["__source"], r["__mix__salt"]) for r in named} == {(1, 2, 4)}


def test_a_very_long_text_is_drawn_or_cut_once(documents, made):
    docs = documents([(1, made(60_000, 1), "a"), (2, made(70, 2), "a"), (3, made(50_000, 3), "b")])
    rows = draw_documents(docs).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source]
        assert sum(r.mix_taken for r in own) == int(own[0].mix_target)
