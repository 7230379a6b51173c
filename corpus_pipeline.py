"""Corpus preparation: language ID, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontam, langid, ngram_join, packing, pii
from tidemark.llm.common import in_training_fold, scratch_path, table
from tidemark.session import ensure_conf

#: A text is kept when one language holds at least half of the decoding weight.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language (null, no letter) or in none for sure go. Learns from the
    training fold of its own input; rows with a null id are judged like any other."""
    model = langid.train(docs.where(in_training_fold(F.col("doc_id"))))
    judged = langid.predict(docs, model, into="_lid")
    sure = (F.col("_lid.lang") != "und") & (F.col("_lid.score") >= MIN_LANGUAGE_SCORE)
    return judged.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays of each group of near duplicates; rows that
    repeat its id and text are one document. Rows without an id stay."""
    groups = ngram_join.near_duplicates(docs)
    stay = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where(F.col("doc_id").isNotNull()).join(stay, "doc_id", "left_semi")
    named = named.withColumn("_h", F.xxhash64("text")).dropDuplicates(["doc_id", "_h"])
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    found = decontam.find_benchmark(docs, table(spark, sf_dir, "benchmark"), into="_hits")
    return found.where(~decontam.contaminated(F.col("_hits"))).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and names are pseudonymised in the text; n_chars follows."""
    ensure_conf(spark)
    safe = pii.pseudonymise(docs, into="_p").withColumn("text", F.col("_p.text"))
    if "n_chars" in docs.columns:
        changed = F.size("_p.found") > 0
        kind = docs.schema["n_chars"].dataType
        safe = safe.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return safe.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 1024 tokens: one row per piece."""
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("packing", pack_sequences)]

#: SQL can't express the learned and tokenising stages; no test compares run() or its stages with brute force yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
