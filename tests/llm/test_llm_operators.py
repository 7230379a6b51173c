"""Operators against brute force on small fixtures: nulls, empty tables, repeated rows, clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, ngram_join, packing, pii, suffix_dedup, tokencount, topk, toxicity, warc

DOC = "doc_id long, text string, extra string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = words(rng, 60)
    passage = words(rng, 120)
    out = [base, base, base.replace(" ", "  ", 1).upper(), base + " zz yy", words(rng, 300), "", None, "one two",
           "One TWO", "é ü ß 1234", passage + " " + words(rng, 40), words(rng, 30) + " " + passage, base]
    return [(k, t, "x") for k, t in enumerate(out)] + [(12, base, "x"), (None, "one two", "x")]


def test_components_equal_brute_force(spark, texts):
    got = {}
    for r in ngram_join.near_duplicates(spark.createDataFrame(texts, DOC)).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"]))
    sets = []
    for d, t, _ in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append((d, {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    comp = {k: {k} for k in range(len(sets))}
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y) and comp[a] is not comp[b]:
                comp[a] |= comp[b]
                for k in comp[a]:
                    comp[k] = comp[a]
    for k, (d, s) in enumerate(sets):
        least = min((sets[j][0] for j in comp[k] if sets[j][0] is not None), default=None)
        assert (len(s), least) in got[d], (d, got[d], len(s), least)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeated_strings_equal_brute_force(spark, texts, keep):
    length, rows = 80, [t for t in texts if t[0] is not None][:13]
    seen: dict = {}
    for d, t, _ in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            seen.setdefault(b[k:k + length], []).append((d, k))
    want = {}
    for d, t, _ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            at = seen[b[k:k + length]]
            if len(at) > 1 and (keep == "none" or at[0] != (d, k)):
                gone[k:k + length] = True
        want[d] = bytes(x for x, g in zip(b, gone) if not g)
    for block in (4_000_000, 300):                             # 300: anchors are split over blocks
        out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOC), length, keep, block_bytes=block)
        assert {r["doc_id"]: bytes(r["kept"]) for r in out.collect()} == want


def test_packing_covers_every_id_without_padding(spark, texts):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(d, x, "x") for d, x, _ in texts if d is not None][:13] + [(100 + k, "ab " * k, "x") for k in range(40)]
    pieces, sequences = {}, {}
    for r in packing.pack(spark.createDataFrame(rows, DOC), window=64).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, x, _ in rows:
        ids, at = t.encode(x or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 64 and at & (at - 1) == 0                 # a power of two: nothing to pad


@pytest.mark.parametrize("rule", tokencount.RULES)
def test_section_tokens_add_up(spark, rule):
    from tokenizers import Tokenizer
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(0, "a\n\n\nbé c\n", "x"), (1, "", "x"), (2, None, "x"), (3, "\n \n x" * 9, "x"), (3, "one", "x")]
    out = tokencount.section_tokens(spark.createDataFrame(rows, DOC), rule=rule).select("text", "sections").collect()
    for r in out:
        text, s = r["text"] or "", r["sections"]
        assert [x["start_char"] for x in s] == [0] + [x["end_char"] for x in s][:-1]
        assert s[-1]["end_char"] == len(text)
        assert abs(sum(x["n_tokens"] for x in s) - len(t.encode(text, add_special_tokens=False).ids)) < 1e-9


def test_added_tokens_have_the_ids_of_the_tokenizers_file(spark):
    from tokenizers import Tokenizer
    import public_tokenizers
    from tidemark.llm import bpe
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = ["a%sb" % mark, mark, mark * 3, "a %s\n\n %s b\n" % (mark, mark), "é%sé <|endoftext|" % mark, "x" + mark[:-1], mark + "\n" + mark,
             "\n%s  \n" % mark + "word " * 90 + mark]
    encode, sizes = bpe.encoder(bpe.default_ranks())
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert encode(x) == ids and sizes[np.array(ids)].sum() == len(x.encode())
    df = spark.createDataFrame([(k, x, "x") for k, x in enumerate(texts)], DOC)
    pieces = {}
    for r in packing.pack(df, window=64).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for k, x in enumerate(texts):
        ids = t.encode(x, add_special_tokens=False).ids + [0]
        assert sum(r["length"] for r in pieces[k]) == len(ids)
        for r in pieces[k]:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for rule in tokencount.RULES:
        for r in tokencount.section_tokens(df, rule=rule).collect():
            assert abs(sum(s["n_tokens"] for s in r["sections"]) - len(t.encode(r["text"], add_special_tokens=False).ids)) < 1e-9


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vecs = [(k, [float(x) for x in rng.normal(0, 0.2, 8)]) for k in range(120)]
    vecs[7] = (7, None)
    vecs[9] = (9, [float("nan")] * 8)
    vecs[11] = (11, [None] * 8)
    vecs += [(200, vecs[0][1]), (201, vecs[0][1])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), k=5, block_rows=16, wave_bytes=200).collect()]
    ok = {k: np.floor(64 * np.array(v)).astype(int) for k, v in vecs if k not in (7, 9, 11)}
    want = []
    for q in ok:
        if q % 20 == 0:
            best = sorted((-int(ok[q] @ v), k) for k, v in ok.items() if k != q)[:5]
            want += [(q, n + 1, k, -s) for n, (s, k) in enumerate(best)]
    assert sorted(got) == sorted(want)


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    item, short = words(rng, 30), "tiny Item"
    w = item.split()
    docs = [(0, words(rng, 50) + ". " + " ".join(w[3:18]).upper() + "! tail", "x"), (1, "a TINY-item b", "x"), (2, None, "x"),
            (3, " ".join(w[:12]), "x"), (4, "", "x"), (5, "xtiny item", "x"), (5, item + " " + item, "x")]
    bench = [(7, item), (8, short), (9, None), (10, "..."), (7, item)]
    for block in (4_000_000, 100):
        out = decontam.find_benchmark(spark.createDataFrame(docs, DOC),
                                      spark.createDataFrame(bench, "item_id long, text string"), block_chars=block)
        got = [(r["doc_id"], r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"]) for r in out.collect()]
        assert sorted(got) == [(0, 66, 15, [7]), (1, 4, 2, [8]), (2, 0, 0, []), (3, 12, 0, []), (4, 0, 0, []),
                               (5, 2, 0, []), (5, 60, 60, [7])]
    spans = {r["text"]: r["hits"]["spans"] for r in out.where("doc_id = 1").collect()}
    assert [("a TINY-item b"[lo:hi]) for lo, hi in spans["a TINY-item b"]] == ["TINY-item"]
    empty = decontam.find_benchmark(spark.createDataFrame(docs, DOC), spark.createDataFrame([], "item_id long, text string"))
    assert empty.where("hits.n_hit > 0").count() == 0


def test_archive_round_trip(spark, tmp_path):
    pages = [(3, "http://a/ b", "<p>é</p>"), (1, None, "<p>é</p>"), (2, "u", None), (5, "u\r\nX: y", ""), (None, "n", "<p>é</p>"),
             (4, "z", "solo"), (1, None, "<p>é</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archive(df, str(tmp_path / "a"))
    back = warc.read_archive(spark, str(tmp_path / "a"))
    h = F.col("header")
    rows = sorted(((warc_id, kind, ref, bytes(p).decode()) for warc_id, kind, ref, p in back.select(
        warc.page_of(warc.header_field(h, "WARC-Record-ID")), warc.header_field(h, "WARC-Type"),
        warc.page_of(warc.header_field(h, "WARC-Refers-To")), "payload").collect()))
    assert rows == [("1", "response", "", "<p>é</p>"), ("1", "response", "", "<p>é</p>"), ("2", "response", "", ""),
                    ("3", "revisit", "1", "<p>é</p>"), ("4", "response", "", "solo"), ("5", "revisit", "2", ""),
                    ("null", "revisit", "1", "<p>é</p>")]
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 3
    warc.export_warc(back, str(tmp_path / "w"))
    files = warc.import_warc(spark, str(tmp_path / "w"))
    assert files.count() == 7
    import base64
    got = {r[0] for r in back.select(warc.base32_sha1(F.col("payload"))).collect()}
    assert got == {base64.b32encode(hashlib.sha1(x.encode()).digest()).decode() for x in ("<p>é</p>", "", "solo")}


def test_pseudonyms_keep_format_and_links(spark):
    card, ip, date, mail = "4418452524842581", "42.144.35.254", "2024-02-29", "bosbt.42@mail8.example.com"
    rows = [(0, "pay %s or +1 (988) 555-2485." % card, "x"), (1, "%s from %s at %s on %s" % (card, mail, ip, date), "x"),
            (2, "plain 12 text 4418452524842582", "x"), (3, None, "x"), (4, "", "x"), (5, "999.1.1.1 2024-02-30", "x")]
    out = {r["doc_id"]: r["private"] for r in pii.pseudonymise(spark.createDataFrame(rows, DOC)).collect()}
    first = re.search(r"\d{16}", out[0]["text"]).group()
    assert first != card and first in out[1]["text"] and card not in out[1]["text"]
    digits = [int(c) for c in first][::-1]
    assert sum(
        digits[::2] + [sum(divmod(2 * d, 10)) for d in digits[1::2]]) % 10 == 0
    assert re.fullmatch(r"pay \d{16} or \+1 \(\d{3}\) \d{3}-\d{4}\.", out[0]["text"])
    assert out[1]["found"] == ["card", "email", "ipv4", "date"]
    assert not any(x in out[1]["text"] for x in (ip, date, mail))
    assert [out[k]["text"] for k in (2, 3, 4, 5)] == [rows[2][1], None, "", rows[5][1]]


def test_grouped_cards_link_to_ungrouped_ones(spark):
    card = "4111111111111111"
    texts = ["pay 4111 1111 1111 1111 now", "pay 4111-1111-1111-1111 now", "pay (4111 1111 1111 1111) now", "pay %s now" % card,
             "pay 4111 1111 1111 1111 123 now", "tel +1 555 123 4567, 4111 1111 1111 1111 10.0.0.1",
             "call (555) 123-4567 4111-1111-1111-1111 2024-02-29", "amex 3782 822463 10005 or 378282246310005"]
    no_card = ["of 4111 1111 1111 1112 x", "call 555-123-4567 2024 x", "run %s x" % ("9" * 4000), "run %s x" % ("1 " * 4000)]
    rows = [(k, t, "x") for k, t in enumerate(texts + no_card)]
    out = [r["private"] for r in sorted(pii.pseudonymise(spark.createDataFrame(rows, DOC)).collect())]
    new = re.search(r"\d{16}", out[3]["text"]).group()
    assert new != card and sum(map(int, new[1::2] + "".join(str(2 * int(c) // 10 + 2 * int(c) % 10) for c in new[::2]))) % 10 == 0
    fours = [new[k:k + 4] for k in range(0, 16, 4)]
    assert [out[k]["text"] for k in (0, 1, 2, 4)] == [
        "pay %s now" % " ".join(fours), "pay %s now" % "-".join(fours), "pay (%s) now" % " ".join(fours),
        "pay %s 123 now" % " ".join(fours)]
    assert " ".join(fours) in out[5]["text"] and "-".join(fours) in out[6]["text"]
    assert [o["found"] for o in out[:8]] == [["card"]] * 5 + [["phone", "card", "ipv4"], ["phone", "card", "date"], ["card", "card"]]
    a, b = re.fullmatch(r"amex ([\d ]+) or (\d+)", out[7]["text"]).groups()
    assert a.replace(" ", "") == b != "378282246310005"
    assert [o["found"] for o in out[8:]] == [["phone"], ["phone"], [], []]
    assert re.fullmatch(r"call \d{3}-\d{3}-\d{4} 2024 x", out[9]["text"]) and "123-4567" not in out[9]["text"]
    assert [o["text"] for o in out[10:]] == no_card[2:]


def test_phone_numbers_in_every_context(spark):
    plain = "555-123-4567"
    around = [("", " call"), ("tel:", ""), ("a\n", "\n"), ("\t", "\t"), ("(", ")"), ("[", "]"), ('"', '"'), ("call ", "."),
              ("no.", ""), ("x=", ";")]
    rows = [(k, a + plain + b, "x") for k, (a, b) in enumerate(around)]
    rows += [(20, "+15551234567", "x"), (21, "or +1 555 123 4567", "x"), (22, "+49 30 1234567", "x"), (23, "(+493012345678)", "x"),
             (24, "+33 1 23 45 67 89.", "x")]
    kept = [(30, "x555-123-4567", "x"), (31, "+1234567", "x"), (32, "+1234567890123456", "x"), (33, "1 + 12345678", "x")]
    out = {r["doc_id"]: r["private"] for r in pii.pseudonymise(spark.createDataFrame(rows + kept, DOC)).collect()}
    new = out[0]["text"][:12]
    assert re.fullmatch(r"\d{3}-\d{3}-\d{4}", new) and new != plain
    assert [out[k]["text"] for k in range(len(around))] == [a + new + b for a, b in around]
    assert all(out[k]["found"] == ["phone"] for k, _, _ in rows)
    assert re.sub(r"\D", "", out[21]["text"]) == out[20]["text"][1:] != "15551234567"
    assert all(re.sub(r"\d", "0", out[k]["text"]) == re.sub(r"\d", "0", t) and out[k]["text"] != t for k, t, _ in rows)
    assert [out[k]["text"] for k, _, _ in kept] == [t for _, t, _ in kept]


def test_digit_permutation_is_one_to_one(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    out = df.select(pii.permute_string(F.col("s"), 10, F.lit("k"), "t").alias("p"))
    assert out.distinct().count() == 1000 and out.where("length(p) <> 3").count() == 0


def test_language_codes_and_rejections(spark, sf):
    docs = spark.read.parquet(sf + "/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = langid.train(docs.where(fold))
    held = langid.predict(docs.where(~fold), model).select("lang", "lid.lang").collect()
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    odd = spark.createDataFrame([(0, None, "x"), (1, "", "x"), (2, "12 !! 3", "x")], DOC)
    assert {(r["lid"]["lang"], r["lid"]["score"]) for r in langid.predict(odd, model).collect()} == {("und", 0.0)}
    assert langid.train(docs.where("false")) is None
    codes = langid.codewords(9)
    assert min(((codes[a] != codes[b]).sum() for a in range(9) for b in range(a))) >= 8


def test_toxicity_tolerates_inserted_characters(spark, sf):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet(
        "/root/testdata/sf0.1/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = toxicity.train(docs, labels.where(fold))
    probe = [(0, "you id.i.ot there", "x"), (1, "what an i d i o t", "x"), (2, "an idixot", "x"), (3, "calm and kind words", "x"),
             (4, None, "x"), (5, "", "x"), (6, "calm " * 200_000 + "idiot", "x")]
    out = {r["doc_id"]: r["toxicity"]["score"] for r in toxicity.score_texts(
        spark.createDataFrame(probe, DOC), model).collect()}
    assert all(out[k] >= 0.7 for k in (0, 1, 2, 6)) and all(out[k] < 0.7 for k in (3, 4, 5)), out
    held = toxicity.score_texts(docs.join(labels.where(~fold), "doc_id"), model).select("toxic", "toxicity.score").collect()
    assert sum((s >= 0.7) == (y == 1) for y, s in held) >= 0.95 * len(held)   # many of its non-English labels follow no word


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    assert ngram_join.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert packing.pack(none).count() == 0
    assert tokencount.section_tokens(none).count() == 0
    assert pii.pseudonymise(none).count() == 0
