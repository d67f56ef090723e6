"""The registered queries of the package: name -> query, name -> DuckDB text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm import (
    hosts, lm, manifest, minhash, mixing, multi_index, page_text, pii, suffix, tiling, token_fst,
    toxicity, variants,
)
from shelfsight.llm.oracles import ORACLES  # noqa: F401
from shelfsight.llm.staging import importable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score_texts(_table(spark, sf_dir, "documents"))
    return scored.select(
        "doc_id",
        "n_words",
        "n_known",
        F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 6).alias("mean_log_score"),
    )


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(_table(spark, sf_dir, "pages"))


def op3_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge(_table(spark, sf_dir, "pages"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.nearest(vectors, vectors.where("vec_id % 20 = 0").select("vec_id"), 20)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    score = F.col("toxicity")
    return toxicity.score_texts(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.draw_documents(docs).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
    )


def op8_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), k=2)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [i for i, k in enumerate(pii.KINDS) if k.base]
    only_base = F.filter("pii", lambda s: s["kind"].isin(*base))

    def count(number):
        return F.size(F.filter("pii", lambda s: s["kind"] == number)).cast("long")

    return pii.find_personal_data(docs).select(
        "doc_id",
        *(count(i).alias(f"n_{pii.KINDS[i].name}") for i in base),
        F.sha2(pii.listed(only_base).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
    )


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def tampered_text() -> Column:
    """The text of every second document without its line ends, by the checksum of its id."""
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(changes, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(_table(spark, sf_dir, "documents"), claims={"text": tampered_text()})


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_fst.count_tokens(_table(spark, sf_dir, "documents"), path)


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_score, op2_html, op3_suffix, op4_urls, op5_ann,
        op6_toxicity, op7_mixing, op8_tiling, op9_minhash, op10_pii,
        op11_variants, op12_manifest, op13_tokens,
    )
}
