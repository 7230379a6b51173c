"""Texts that once ended a job: long runs of blanks, letters, digits and labels."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, packing, pii, tokencount

RUNS = {"blanks": " " * 1_000_000, "blanks in words": "a" + " \n\t" * 400_000 + "b", "letters": "a" * 1_000_000,
        "labels": "x a@" + "a." * 500_000 + "com y", "digits": "7" * 1_000_000, "line": "word " * 1_000_000}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(RUNS.values())], "doc_id long, text string").repartition(3)


def test_personal_data_in_long_runs(spark, docs):
    out = {r["doc_id"]: r for r in pii.pseudonymise(docs, into="p").select("doc_id", "p.text", "p.found").collect()}
    assert [out[i]["text"] for i in range(len(RUNS))] == list(RUNS.values()) and not any(r["found"] for r in out.values())


def test_addresses_with_many_labels(spark):
    texts = ["mail bob@" + "a." * 100 + "com now", "mail bob@x.com-y and b.c@d-e.co.uk.", "x a@" + "a." * 6000 + "com y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [r["found"] for r in pii.pseudonymise(df, into="p").orderBy("doc_id").select("p.found").collect()]
    assert got == [["email"], ["email", "email"], []]


def test_tokens_of_long_runs(spark, docs):
    from tokenizers import Tokenizer
    import public_tokenizers
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode, sizes = bpe.encoder(bpe.default_ranks())
    for text in RUNS.values():
        ids = encode(text)
        assert ids == whole.encode(text, add_special_tokens=False).ids and int(sizes[ids].sum()) == len(text.encode())
    packed = packing.pack(docs)
    per = {r["doc_id"]: r for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert all(per[i]["n"] == per[i]["t"] == len(encode(t)) + 1 for i, t in enumerate(RUNS.values()))
    sections = tokencount.section_tokens(docs, rule="most", into="s")
    counted = sections.select(F.explode("s.n_tokens").alias("n")).agg(F.sum("n")).first()[0]
    assert counted == sum(len(encode(t)) for t in RUNS.values())
