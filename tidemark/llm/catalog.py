"""Registered queries of the training-data operators, and their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (centroids, decontam, filter_audit, langid, ngram_join, packing, pii, sharding, suffix_dedup, tokencount, topk,
                          toxicity, warc)
from tidemark.llm import audit_sql, centroid_sql
from tidemark.llm.common import held_out, in_training_fold, scratch_path, table
from tidemark.session import ensure_conf


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    path = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, min_payload_bytes=0)
    h = F.col("header")
    refers = warc.page_of(warc.header_field(h, "WARC-Refers-To"))
    return warc.read_archive(spark, path).select(
        warc.page_of(warc.header_field(h, "WARC-Record-ID")).try_cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        warc.base32_sha1(F.col("payload")).alias("payload_digest"),
        warc.header_field(h, "WARC-Type").alias("record_type"),
        refers.try_cast("long").alias("refers_to"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=400,
                                      keep="none")
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      F.octet_length("kept").cast("long").alias("n_kept"),
                      F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))    # U+FFFD for cut characters


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs.select("doc_id", "text"), labels.where(in_training_fold(F.col("doc_id"))))
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model, into="tox")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox.score").alias("score"),
                         (F.col("tox.score") >= 0.7).cast("int").alias("predicted"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(in_training_fold(F.col("doc_id"))))
    out = langid.predict(docs.select("doc_id", "text"), model, into="lid")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("lid.lang").alias("lang_pred"),
                      F.col("lid.score").alias("score"), F.col("lid.ambiguous").alias("ambiguous"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, into="p").select("doc_id", F.col("p.text").alias("text"),
                                                   F.size("p.found").alias("n_replaced"),
                                                   F.array_join("p.found", ",").alias("kinds"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokencount.section_tokens(docs, rule="most", into="s").select("doc_id", F.explode("s").alias("s"))
    return out.select("doc_id", "s.section", "s.start_char", "s.end_char",
                      F.col("s.n_tokens").cast("long").alias("n_tokens"), "s.n_crossing")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_benchmark(docs, table(spark, sf_dir, "benchmark"), into="hits")
    h = F.col("hits")
    names = F.array_join(F.array_sort(F.transform(h["items"], lambda i: i.cast("string"))), ",")
    return found.select("doc_id", h["n_words"].alias("n_words"), h["n_hit"].alias("n_hit"),
                        F.size(h["items"]).cast("long").alias("n_items"),
                        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
                        decontam.contaminated(h).alias("contaminated"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(filter_audit.mask_counts(filter_audit.masks(docs), table(spark, sf_dir, "labels")))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256.0, salt="2:")
    digest = F.sha2(F.array_join(F.transform("centroid", lambda c: c.cast("string")), ","), 256)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    out = sharding.shuffle_into_shards(docs, shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_ngram_join, op3_suffix_dedup, op4_toxicity, op5_packing, op6_language_id, op7_top_k, op8_pii,
                                   op9_token_counts, op10_decontamination, op11_filter_audit, op12_centroids,
                                   op13_sharding)}

ORACLE: dict[str, str] = {"op11_filter_audit": audit_sql.SQL, "op12_centroids": centroid_sql.SQL}
