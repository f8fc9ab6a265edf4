"""The queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtrend.llm import align, bpe, decontaminate, html_text, jaccard, packing, pii, repeats, token_store, toxicity, url_rules, vectors, whitening
from jobtrend.llm.common import table
from jobtrend.llm.sql import OP5_SQL, OP10_SQL


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"]).select("row.*", "found.*")


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "found.n_bytes", "found.n_removed", "found.n_spans", "found.kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select("row.doc_id", "found.*")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_and_read(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "row.doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        "found.contaminated",
    )


def op6_rotation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), keep=["doc_id"])
    n = lambda kind: F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("row.doc_id", *map(n, pii.KINDS), F.sha2(pii.joined(F.col("found.base")), 256).alias("base_sha256"), pii.joined(F.col("found.all")).alias("spans"))


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES)).select("row.page_id", "found.*")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"], decoded=True)
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    found = align.align(table(spark, sf_dir, "documents")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times")
    return align.with_counts(found)


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_suffix_array": op2_suffix_array,
    "op3_toxicity": op3_toxicity,
    "op4_token_store": op4_token_store,
    "op5_decontamination": op5_decontamination,
    "op6_rotation_codes": op6_rotation_codes,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_pii": op8_pii,
    "op9_best_two_fit": op9_best_two_fit,
    "op10_url_rules": op10_url_rules,
    "op11_whitening": op11_whitening,
    "op12_bpe": op12_bpe,
    "op13_alignment": op13_alignment,
}
ORACLE = {"op5_decontamination": OP5_SQL, "op10_url_rules": OP10_SQL}
