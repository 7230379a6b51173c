"""Longest previous factors against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import suffix_dedup


def factors_brute(data, length):
    n = len(data)

    def shared(i, j):
        k = 0
        while max(i, j) + k < n and data[i + k] == data[j + k] and k < length:
            k += 1
        return k
    return [max([shared(i, j) for j in range(i)], default=0) for i in range(n)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.integers(8, 40))
def test_factors_equal_brute_force(data, length):
    lpf, sources, _ = suffix_dedup.previous_factors(np.array(data, np.int16), length)
    assert lpf.tolist() == factors_brute(data, length)
    best = [max([factors_brute_pair(data, i, s[i], length) for s in sources if s[i] >= 0], default=0) for i in range(len(data))]
    assert best == lpf.tolist() and all(s[i] < i for s in sources for i in range(len(data)))


def factors_brute_pair(data, i, j, length):
    k = 0
    while i + k < len(data) and data[i + k] == data[j + k] and k < length:
        k += 1
    return k


@pytest.mark.parametrize("values", [range(3000), range(3000, 0, -1), [*range(1, 2001), 0, *range(2001, 3000)],
                                    random.Random(3).sample(range(5000), 5000), [7], []])
def test_previous_smaller_of_any_order(values):
    values = np.array(values, np.int64)
    for jumps in (0, 2, 12):
        got = suffix_dedup.previous_smaller(values, jumps)
        stack, want = [], []
        for i, v in enumerate(values):
            while stack and values[stack[-1]] > v:
                stack.pop()
            want.append(stack[-1] if stack else -1)
            stack.append(i)
        assert got.tolist() == want


def removed_brute(docs, length, keep):
    """{doc_id: (spans, sha256 of the bytes left)} by a table of all windows; ids are in order."""
    seen: dict = {}
    for d, t in docs:
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i:i + length], []).append((d, i))
    out = {}
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            places = seen[t[i:i + length]]
            if len(places) > 1 and (keep == "none" or places[0] != (d, i)):
                gone[i:i + length] = b"\1" * length
        left = bytes(c for c, g in zip(t, gone) if not g)
        out[d] = (sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("block", [2_000, 4_000_000])
def test_removal_with_split_anchors_and_copies(spark, keep, block):
    """Near copies around one passage (one anchor, many contents), many exact copies, runs of one letter,
    repeats within a text, and a text longer than one piece."""
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))        # noqa: E731
    core, copy = text(300), text(700)
    docs = [text(150) + core + text(150) for _ in range(40)] + [copy] * 30 + ["z" * 900, "z" * 100, "", "é" * 400]
    docs += [text(200) + docs[0][100:420] + text(50) + copy[:250] + copy[:250], text(270_000) + core + text(90)]
    rows = list(enumerate(docs))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
           for r in suffix_dedup.remove_repeats(df, length=100, keep=keep, block_bytes=block).collect()}
    assert got == removed_brute([(d, t.encode()) for d, t in rows], 100, keep)


def blocks_of(docs, length, keep, monkeypatch):
    """(bytes put in suffix order, removed ranges) of one anchor's segments in texts that share one gram."""
    import pyarrow as pa
    rows = []
    for d, data in enumerate(docs):
        for anchor, _, a, b, p in zip(*suffix_dedup.segments(data, length)):
            rows.append((int(anchor.view(np.int64)), 0, False, d, d, int(a), int(p - a), 1, data[a:b + length]))
    rows.sort(key=lambda r: r[0])
    names = ["anchor", "salt", "salted", "uid", "doc_id", "a", "at", "c", "seg"]
    ordered, whole = [], suffix_dedup.repeated_starts
    monkeypatch.setattr(suffix_dedup, "repeated_starts",
                        lambda parts, *rest: (ordered.append(sum(map(len, parts))), whole(parts, *rest))[1])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    found = [r for b in suffix_dedup._block_scan(length, 4_000_000, keep)([batch]) for r in b.to_pylist()]
    gone = [bytearray(len(d)) for d in docs]
    for r in found:
        gone[r["uid"]][r["lo"]:r["hi"]] = b"\1" * (r["hi"] - r["lo"])
    return sum(ordered), [bytes(c for c, g in zip(d, x) if not g) for d, x in zip(docs, gone)]


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("length", [64, 100, 400])
def test_only_what_may_be_equal_is_put_in_suffix_order(keep, length, monkeypatch):
    """Texts that share a phrase shorter than ``length`` have no equal windows: nothing to order. Of those that
    share more, at every place of the phrase, no window is lost."""
    rng = random.Random(7)
    text = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))         # noqa: E731
    phrase = text(length * 3 // 4)
    apart = [text(rng.randint(0, length)) + phrase + text(length) for _ in range(40)]
    assert blocks_of(apart, length, keep, monkeypatch) == (0, apart)
    docs = list(apart)
    for _ in range(60):
        d = rng.choice(docs)
        lo = rng.randint(0, len(d) - length)
        docs.append(text(rng.randint(0, 30)) + d[lo:lo + length + rng.randint(0, 20)] + text(rng.randint(0, 30)))
    ordered, left = blocks_of(docs, length, keep, monkeypatch)
    want = removed_brute(list(enumerate(docs)), length, keep)
    assert ordered and [hashlib.sha256(x).hexdigest() for x in left] == [want[d][1] for d in range(len(docs))]


def test_query_returns_the_text_that_is_left(spark, tmp_path):
    """The kept text as a column, so that what is gone can be seen: passages of 400 bytes and more go from
    every text, shorter ones stay, whole characters aside."""
    from tidemark.llm import catalog
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))        # noqa: E731
    long, short = text(400), " ".join(text(6).replace(" ", "z") for _ in range(52))
    docs = ["1" + text(50) + "2" + long + "3", "4" + long + "5" + text(70), "6" + short + "7", "8" + short + "9",
            "é" + "ü" * 250, "ö" + "ü" * 250, "", None]
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in catalog.op3_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [got[k]["text"] for k in (0, 1)] == [docs[0].replace(long, ""), docs[1].replace(long, "")]
    assert [got[k]["text"] for k in (2, 3, 6, 7)] == [docs[2], docs[3], "", ""] and len(short) < 400
    assert [got[k]["text"] for k in (4, 5)] == ["é", "ö"]
    for k, d in enumerate(docs):
        r = got[k]
        assert r["n_kept"] == r["n_bytes"] - r["n_removed"] and (r["text"] == (d or "")) == (r["n_removed"] == 0)
        assert r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
