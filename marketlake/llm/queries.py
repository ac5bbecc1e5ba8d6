"""The registered query of each operator: production parameters, the whole table, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import codes, exact, langid, lines, mixing, negatives, packing, passages, simhash, tokenfile, toxicity, weighted, wrapper
from marketlake.llm.common import stored, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.decide(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query
def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.summary(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "prediction.lang_pred", "prediction.score")


@query
def op7_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weighted.fingerprints(table(spark, sf_dir, "documents"))
    return found.withColumns({name: weighted.as_text(F.col(name)) for name in ("fingerprint", "edited_fingerprint")})


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.grade(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "toxicity.severity", "toxicity.p_toxic", "toxicity.grade", (F.col("toxicity.p_toxic") >= toxicity.TOXIC).alias("toxic"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "dedup.lines", "dedup.deleted", F.sha2("dedup.text", 256).alias("kept_sha256"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.encoded(table(spark, sf_dir, "documents"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, coded = codes.fit(table(spark, sf_dir, "embeddings"))
    found = codes.with_label_errors(stored(coded, "codes"))
    sha256 = F.lit(codes.digest(history) if history else None).cast("string")
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", sha256.alias("codebooks_sha256"))
