import re

import corpus_pipeline
from shelfsight.llm.minhash import near_duplicates
from shelfsight.llm.tiling import find_leaks
from shelfsight.llm.toxicity import fit, score_texts


def test_stages_by_hand(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    seen = {}
    stages = [
        (n, lambda s, d, p, n=n, f=f: seen.setdefault(n, f(s, d, p).cache())) for n, f in corpus_pipeline.STAGES
    ]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in seen.items()}
    rows = {r.doc_id: r for r in docs.collect()}

    toxic = {r.doc_id for r in score_texts(docs, fit(docs, labels)).collect() if r.toxicity >= 0.7}
    assert ids["toxicity"] == rows.keys() - toxic
    left = docs.where(docs.doc_id.isin(list(ids["toxicity"])))
    assert ids["near_duplicates"] == {r.doc_id for r in near_duplicates(left).collect() if r.kept}
    left = left.where(docs.doc_id.isin(list(ids["near_duplicates"])))
    leaks = {r.doc_id for r in find_leaks(left, benchmark).collect()}
    assert leaks and ids["decontamination"] == ids["near_duplicates"] - leaks
    assert ids["pii"] == ids["decontamination"]
    for name in ("toxicity", "near_duplicates", "decontamination", "pii"):
        assert seen[name].dtypes == docs.dtypes
    clean = {r.doc_id: r for r in seen["pii"].collect()}
    assert any(r.text != rows[i].text for i, r in clean.items())
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert not any(mail.search(r.text) for r in clean.values())
    assert all(r.n_chars == len(r.text) for r in clean.values())
    assert {r.doc_id for r in out} <= ids["pii"]
    assert all(r.text == clean[r.doc_id].text for r in out if r.repetition == 1 and len(r.text) > len(clean[r.doc_id].text) - 1)


def test_stages_take_empty_tables_nulls_and_further_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(5)
    odd = docs.selectExpr("doc_id", "if(doc_id % 2 = 0, null, text) as text", "lang", "cast(null as string) as source", "n_chars", "1 as pii", "2 as toxicity", "3 as toxic")
    for table in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, sf_dir)
            if name != "mixing":
                assert out.columns == table.columns
            out.collect()
