"""Filter audit, centroid clustering and sharding against brute force, and their defined cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, centroids, filter_audit, sharding
from tidemark.llm.common import free_names


def write(spark, tmp_path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(3).write.parquet("%s/%s.parquet" % (tmp_path, name))
    return str(tmp_path)


# ---------------------------------------------------------------- filter audit

def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
    return out


def audit_brute(docs, labels):
    least, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, quality, poison in labels:
        good |= {i} if quality == 1 else set()
        toxic |= {i} if poison == 1 else set()
    flagged = defaultdict(list)
    for i, text, lang in docs:
        own = fails(text or "") + "E" * (i is not None and i > least[text or ""])
        flagged[lang or ""].append((own, i in good and i is not None, i in toxic and i is not None))
    out = set()
    for part, rows in flagged.items():
        removed = Counter()
        made = []
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[0]]
                removed[f] += len(here)
                redundant = sum(f in r[0] for r in rows) - len(here)
                left = [r for r in left if f not in r[0]]
                made.append((part, order, step, len(left), len(here), redundant, sum(r[0] == f for r in rows),
                             sum(r[1] for r in here), sum(r[2] for r in here)))
        out |= {m + (removed[m[1][m[2] - 1]],) for m in made}
    return out


DOCS = "doc_id long, text string, lang string, source string, part string"
LABELS = "doc_id long, quality int, toxic int, n long"


def odd_documents():
    rng = random.Random(3)
    long_words = ["w%d" % i for i in range(400)]
    texts = ["", None, "a", "A B C", "x y " * 60, "café " * 120, "İÉ \U0001f600" * 50, "a | b", "  \t\n\x0b\x0c\r ",
             " ".join(long_words), " ".join(long_words) + "#", "Z" * 1000, "aa", "aaa", "aab",
             " ".join(long_words * 3), "\x85   x\x1cy"]
    docs = []
    for i in range(300):
        docs.append((rng.randrange(200), rng.choice(texts), rng.choice(["en", "de", None, ""])))
    docs += [(None, "a", "en"), (None, "only here", "fr"), (None, None, None), (5, "a", "en"), (5, "a", "en")]
    docs += [(1000 + i, "one group of copies " * 30, "en") for i in range(200)]
    labels = [(rng.randrange(1300), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(400)] + [(None, 1, 1)]
    return docs, labels


def audit_query(spark, tmp_path, docs, labels):
    sf = write(spark, tmp_path, documents=([(*d, "src", "clash") for d in docs], DOCS),
               labels=([(*x, 9) for x in labels], LABELS))
    return catalog.op11_filter_audit(spark, sf)


def test_filter_audit_equals_brute_force(spark, tmp_path):
    docs, labels = odd_documents()
    out = audit_query(spark, tmp_path, docs, labels)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == audit_brute(docs, labels)


def test_filter_audit_with_tries_emptied_often(spark, tmp_path, monkeypatch):
    """A trie emptied after every text gives the same rows: the ranges settle what it could not see."""
    monkeypatch.setattr(filter_audit, "TRIE_BYTES", 1)
    docs, labels = odd_documents()
    assert {tuple(r) for r in audit_query(spark, tmp_path, docs, labels).collect()} == audit_brute(docs, labels)


def test_filter_audit_of_long_texts_and_shared_prefixes(spark, tmp_path):
    shared = "the same first words " * 50_000                           # 1 MB
    docs = [(i, shared + str(i // 2), "en") for i in range(8)] + [(20, " " * 1_000_000, "en"), (21, "a" * 5_000_000, "en"),
                                                                  (22, "a" * 5_000_000, "de")]
    assert {tuple(r) for r in audit_query(spark, tmp_path, docs, []).collect()} == audit_brute(docs, [])


def test_filter_audit_of_nothing(spark, tmp_path):
    assert audit_query(spark, tmp_path, [], []).collect() == []


def test_trie_holds_what_was_put():
    rng = random.Random(5)
    trie, want = filter_audit.Trie(), {}
    for i in range(3000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(9)))
        trie.put(text, i, "", 0, 1)
        want.setdefault(text, []).append(i)
    got = [(text, least, len(counts)) for text, least, _, counts in trie.terminals()]
    assert got == [(t, min(i), len(i)) for t, i in sorted(want.items())]


def test_copies_leave_their_task_once(spark):
    docs = spark.createDataFrame([(i, "copy", "en") for i in range(5000)], "doc_id long, text string, lang string").repartition(4)
    given = docs.select("doc_id", F.col("lang").alias("part"), F.col("text").cast("binary").alias("text"))
    sent = given.mapInArrow(filter_audit._local, "doc_id long, part string, mask int, n long, text binary")
    assert sent.where("text is not null").count() <= 4


# ---------------------------------------------------------------- centroids

def cluster_brute(vectors, k=40, rounds=5, dims=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda p: hashlib.sha256(b"2:%d" % p[0]).hexdigest()          # noqa: E731
    cents = [v for _, v in sorted((p for p in kept if p[0] is not None), key=lambda p: (key(p), p[1]))[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))         # noqa: E731

    def nearest():
        return [min((dist(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
    for _ in range(rounds):
        at = nearest()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, at) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    at = nearest()
    per = Counter()
    for d, j in at:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return Counter((i, j, d, per[j], sum(per.values()), sha[j]) for (i, _), (d, j) in zip(kept, at))


VECTORS = "vec_id long, embedding array<float>, label int, cluster string"


def embeddings_query(spark, tmp_path, vectors):
    sf = write(spark, tmp_path, embeddings=([(i, v, 1, "clash") for i, v in vectors], VECTORS))
    return catalog.op12_centroids(spark, sf)


def single(x):
    import numpy as np
    return float(np.float32(x))


def test_centroids_equal_brute_force(spark, tmp_path):
    rng = random.Random(1)
    vectors = [(i, [single(rng.gauss(0, 0.1)) for _ in range(64)]) for i in range(150)]
    same = vectors[3][1]
    vectors += [(500 + i, same) for i in range(80)] + [(7, same), (7, same)]      # one hot vector, repeated ids
    vectors += [(None, same), (600, None), (601, []), (602, same[:63]), (603, [None] + same[1:]), (604, [float("nan")] + same[1:]),
                (605, [float("inf")] + same[1:]), (606, [single(x * 3e4) for x in same]), (607, [-0.0] * 64)]
    out = embeddings_query(spark, tmp_path, vectors)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(tuple(r) for r in out.collect()) == cluster_brute(vectors)


def test_centroids_of_few_and_no_vectors(spark, tmp_path):
    few = [(i, [single(i)] * 64) for i in range(3)]
    assert Counter(tuple(r) for r in embeddings_query(spark, tmp_path / "few", few).collect()) == cluster_brute(few)
    assert embeddings_query(spark, tmp_path / "none", []).collect() == []


@pytest.mark.parametrize("reach", [3, 40_000, 2 ** 28, 2 ** 40])
def test_lookup_tables_are_exact_at_any_size(reach):
    import numpy as np
    rng = random.Random(reach)
    v = [[rng.randrange(-reach, reach) for _ in range(5)] for _ in range(50)]
    cents = [[rng.randrange(-reach, reach) for _ in range(5)] for _ in range(7)]
    got = centroids.distances(np.array(v, np.int64), cents)
    assert got.tolist() == [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in cents] for x in v]


def test_too_large_components_fail_with_a_message(spark):
    df = spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\*\\*62"):
        centroids.cluster(df, 2, 1, 4).collect()


# ---------------------------------------------------------------- sharding

def test_shards_are_exact_and_hold_every_row(spark, tmp_path):
    docs = [(i % 300 if i % 7 else None, "copy" if i % 3 else "t%d é" % i, None, "s", "p") for i in range(1003)]
    docs += [(9000, None, "en", "s", "p"), (9001, "", "en", "s", "p")]
    sf = write(spark, tmp_path, documents=(docs, DOCS))
    out = catalog.op13_sharding(spark, sf)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = out.collect()
    sizes = Counter(r["shard"] for r in rows)
    assert sorted(sizes) == list(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, i) for s in range(24) for i in range(sizes[s])]
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}


def test_sharding_of_few_and_no_rows(spark, tmp_path):
    sf = write(spark, tmp_path, documents=([], DOCS))
    assert catalog.op13_sharding(spark, sf).collect() == []
    few = sharding.shuffle_into_shards(spark.range(3), 24).collect()
    assert sorted(r["id"] for r in few) == [0, 1, 2] and {r["slot"] for r in few} == {0}
    assert sorted(r["shard"] for r in few) == [0, 1, 2]
    one = sharding.shuffle_into_shards(spark.range(50), 1).collect()
    assert sorted(r["slot"] for r in one) == list(range(50))


def test_shards_as_files(spark, tmp_path):
    df = spark.range(400).select(F.col("id").alias("shard"), F.col("id").cast("string").alias("Slot"),
                                 F.lit("text").alias("shard_in"))
    sharding.write_shards(df, str(tmp_path / "out"), 5, seed=4)
    parts = [sharding.read_shard(spark, str(tmp_path / "out"), s) for s in range(5)]
    assert parts[0].columns == ["shard_in_in", "Slot_in", "shard_in", "slot", "shard"]
    assert all([r["slot"] for r in p.collect()] == list(range(80)) for p in parts)
    assert sorted(r["shard_in_in"] for p in parts for r in p.collect()) == list(range(400))
    again = sharding.shuffle_into_shards(df, 5, seed=4)
    assert {(r["shard_in_in"], r["shard"], r["slot"]) for p in parts for r in p.collect()} == {
        (r["shard_in_in"], r["shard"], r["slot"]) for r in again.collect()}


def test_matrix_has_the_sizes_of_blocks_and_shards(spark):
    counts = [(b, (b * 37) % 11 * 5) for b in range(23) if (b * 37) % 11]
    df = spark.createDataFrame(counts, "block long, n long")
    got = {r["block"]: r["takes"] for r in sharding.communication_matrix(df, 7, 23, 1).collect()}
    assert {b: sum(t) for b, t in got.items()} == dict(counts)
    total = sum(n for _, n in counts)
    assert [sum(col) for col in zip(*got.values())] == [total // 7 + (j < total % 7) for j in range(7)]


@pytest.mark.parametrize("good, bad, draws", [(7, 12, 9), (1, 30, 4), (40, 3, 41), (5, 5, 10), (0, 9, 3), (900, 1100, 700)])
def test_draws_follow_the_hypergeometric_law(spark, good, bad, draws):
    n = 8000
    u = sharding.unit(F.lit(good), F.lit(draws), F.col("id"))
    got = Counter(r[0] for r in spark.range(n).select(
        sharding.hypergeometric(F.lit(good), F.lit(bad), F.lit(draws), u)).collect())
    all_ways = math.comb(good + bad, draws)
    want = {h: n * math.comb(good, h) * math.comb(bad, draws - h) / all_ways
            for h in range(max(0, draws - bad), min(good, draws) + 1)}
    assert set(got) <= set(want)
    cells = [(got[h], e) for h, e in want.items() if e >= 5]
    rest = n - sum(e for _, e in cells), n - sum(g for g, _ in cells)
    chi = sum((g - e) ** 2 / e for g, e in cells)
    assert chi < len(cells) + 4 * math.sqrt(2 * len(cells)) + 8 and abs(rest[0] - rest[1]) < 60


def test_places_do_not_depend_on_where_rows_came_from(spark):
    rows = spark.range(4000).withColumnRenamed("id", "row")
    got = sharding.place(rows, 4, seed=3).collect()
    for mine in (lambda r: r["row"] < 2000, lambda r: r["row"] % 2, lambda r: r["row"] % 4 == r["shard"]):
        cells = Counter((r["shard"], r["slot"] // 250) for r in got if mine(r))
        each = sum(cells.values()) / 16
        assert len(cells) == 16 and all(abs(n - each) < 5 * math.sqrt(each) for n in cells.values())


def test_no_python_in_the_plan(spark):
    plan = sharding.shuffle_into_shards(spark.range(100), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_free_names():
    assert free_names(["a", "Shard", "shard_in"], ("shard",), "_in") == ["a", "Shard_in_in", "shard_in"]


def test_turns_deal_each_fragment_once():
    """Each turn of op2's first shuffle carries about half of the n-grams, and both carry them all once."""
    import types

    import numpy as np
    import pyarrow as pa

    from tidemark.llm import ngram_join
    rng = random.Random(2)
    texts = [" ".join(str(rng.randint(0, 9999)) for _ in range(80)) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(texts)], ["doc_id", "text"])
    heavy = types.SimpleNamespace(value=np.zeros(0, np.uint64))
    keys = list(range(16))

    def rows(*turn):
        return [r for b in ngram_join._segment(5, heavy, keys, *turn)([batch]) for r in b.to_pylist()]
    key = lambda r: (r["kind"], r["frag"], r["doc_id"] or 0)                   # noqa: E731
    whole, parts = rows(), [rows(t, ngram_join.TURNS) for t in range(ngram_join.TURNS)]
    assert sorted(sum(parts, []), key=key) == sorted(whole, key=key)
    size = [sum(len(r["data"]) for r in x if r["kind"] == 1) for x in (whole, *parts)]
    assert len(parts) > 1 and max(size[1:]) < 0.65 * size[0]
    assert not any(r["kind"] != 1 for r in parts[1])
