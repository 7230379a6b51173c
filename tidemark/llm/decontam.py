"""Benchmark decontamination with an Aho-Corasick automaton (operator 10).

Words are maximal runs of bytes other than ASCII non-alphanumerics, A-Z lower-cased
(digits, letters and all non-ASCII characters). A window is ``window`` consecutive words of a benchmark item; an
item with fewer words (but not none) is one window. The windows of all items, normalised
to single spaces, form one automaton; each document is normalised once, scanned once,
and the matches are mapped back to character offsets of the original text.

Defined cases: null texts have no words; a null item id marks words but names no item;
an empty benchmark hits nothing; repeated items count once (item ids are a set); each
document row is judged by itself, whatever its id; extra columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import arrow_scan

#: Lower-cased word bytes stay, everything else becomes a blank.
WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
                   for c in range(256))

HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def benchmark_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(window text, its word count, ids of the items holding it), one row per distinct window."""
    def cut(batches: Iterator) -> Iterator:
        import pandas as pd
        for pdf in batches:
            out = []
            for i, text in zip(pdf["i"], pdf["t"]):
                w = words_of(text) if text is not None else []
                for k in range(max(1, len(w) - window + 1) if w else 0):
                    part = w[k:k + window]
                    out.append((None if pd.isna(i) else int(i), (b" %s " % b" ".join(part)).decode("latin-1"),
                                len(part)))
            yield pd.DataFrame(out, columns=["item_id", "w", "n"]).astype({"item_id": "Int64"})
    rows = (benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
            .mapInPandas(cut, "item_id long, w string, n int"))
    return rows.groupBy("w", "n").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def _blocks(windows: DataFrame, block_chars: int) -> list:
    """The windows in broadcast blocks of at most ``block_chars`` characters each (a
    window longer than that is a block alone); the driver holds one block at a time."""
    sc, blocks, part, size = windows.sparkSession.sparkContext, [], [], 0
    for r in windows.toLocalIterator():
        if part and size + len(r["w"]) > block_chars:
            blocks.append(sc.broadcast(part))
            part, size = [], 0
        part.append((r["w"], r["n"], tuple(r["items"])))
        size += len(r["w"])
    if part:
        blocks.append(sc.broadcast(part))
    return blocks


def _spans(text: str, hit) -> list[list[int]]:
    """Character spans [start, end) of the maximal runs of hit words in the original text."""
    import re
    out: list[list[int]] = []
    last = -2
    for k, m in enumerate(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)):
        if hit[k]:
            if last == k - 1:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            last = k
    return out


def find_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "item_id",
                   text_col: str = "text", item_col: str = "text", into: str = "hits", block_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with a struct column ``into`` (n_words, n_hit, items, spans).

    The scan is one pass over the documents with no shuffle. One block of windows (the
    usual case) is one automaton, built once per Python worker; a larger benchmark is
    cut into blocks and the normalised batch is scanned with each in turn, so memory
    stays at one automaton of about 35 bytes per block character."""
    blocks = _blocks(benchmark_windows(benchmark, window, id_col, item_col), block_chars)

    def automaton(block):
        import ahocorasick
        a = ahocorasick.Automaton()
        for k, (w, n, _) in enumerate(block.value):
            a.add_word(w, (k, n))
        a.make_automaton()
        return a

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        held = automaton(blocks[0]) if len(blocks) == 1 else None
        kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                          ("spans", pa.list_(pa.list_(pa.int32())))])
        for col in batches:
            counts, found = [], {}          # found: row -> [hit flags, item ids]
            for b, block in enumerate(blocks or [None]):
                a = held or (automaton(block) if block is not None else None)
                for r in range(len(col)):
                    text = col[r].as_py()
                    w = words_of(text) if text is not None else []
                    if b == 0:
                        counts.append(len(w))
                    if a is None or not w:
                        continue
                    flat = (b" %s " % b" ".join(w)).decode("latin-1")
                    got = list(a.iter(flat))
                    if not got:
                        continue
                    ends = np.cumsum([len(x) + 1 for x in w])      # the blank after each word
                    hit, items = found.setdefault(r, [np.zeros(len(w), bool), set()])
                    for end, (k, n) in got:
                        last = int(np.searchsorted(ends, end))
                        hit[last - n + 1:last + 1] = True
                        items.update(block.value[k][2])
            yield pa.array([
                {"n_words": n, "n_hit": int(found[r][0].sum()), "items": sorted(found[r][1]),
                 "spans": _spans(col[r].as_py(), found[r][0])} if r in found
                else {"n_words": n, "n_hit": 0, "items": [], "spans": []} for r, n in enumerate(counts)], kind)

    return docs.withColumn(into, arrow_scan(scan, HITS)(F.col(text_col)))


def contaminated(hits) -> F.Column:
    """The contamination rule: at least one twentieth of a document's words is hit."""
    return (hits["n_hit"] > 0) & (hits["n_hit"] * 20 >= hits["n_words"])
