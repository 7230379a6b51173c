"""Token counts by offset-mapped attribution (operator 9).

Each document is encoded once, as a whole. A byte-level token spells its bytes, so the
running sum of token lengths gives every token's byte span, and the UTF-8 lead bytes map
it to characters. The spans are interval-joined to the document's sections (two sorted
lists, one binary search per token edge). A token that crosses section boundaries is
allocated by ``rule``:

* ``"first"``: to the section of its first byte;
* ``"most"``: to the section holding most of its bytes (ties: the earlier one);
* ``"share"``: to each section by its share of the bytes (fractions that add up to 1).

Sections are the lines of a text, each with its line end, so they partition the text and
the counts of a document add up to its token count under every rule.

Defined cases: null or empty texts have one empty section (0) of no tokens; repeated
rows are counted row by row; extra columns pass through; texts of any length are
encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.bpe import default_ranks, encoder
from tidemark.llm.common import arrow_scan

RULES = ("first", "most", "share")
SECTIONS = T.ArrayType(T.StructType([
    T.StructField("section", T.IntegerType()), T.StructField("start_char", T.IntegerType()),
    T.StructField("end_char", T.IntegerType()), T.StructField("n_tokens", T.DoubleType()),
    T.StructField("n_crossing", T.IntegerType())]))


def attribute(ids, sizes, data: bytes, rule: str):
    """(start char, end char, tokens, crossing tokens) arrays, one entry per section."""
    import numpy as np
    raw = np.frombuffer(data, np.uint8)
    cuts = np.flatnonzero(raw == 10) + 1
    if len(cuts) and cuts[-1] == len(raw):
        cuts = cuts[:-1]
    starts = np.concatenate(([0], cuts))                     # byte bounds of the sections
    ends = np.concatenate((cuts, [len(raw)]))
    lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    e = np.cumsum(sizes[np.asarray(ids, np.int64)], dtype=np.int64)
    s = np.concatenate(([0], e[:-1]))
    if not len(e):
        s = e
    first = np.searchsorted(starts, s, "right") - 1
    last = np.searchsorted(starts, e - 1, "right") - 1
    cross = np.flatnonzero(first != last)
    n = len(starts)
    crossing = np.zeros(n, np.int32)
    if rule == "first" or not len(cross):
        tokens = np.bincount(first, minlength=n).astype(float)
        for t in cross:
            crossing[first[t]:last[t] + 1] += 1
    else:
        inside = np.ones(len(e), bool)
        inside[cross] = False
        tokens = np.bincount(first[inside], minlength=n).astype(float)
        for t in cross:                                      # few: tokens over a line end
            k = np.arange(first[t], last[t] + 1)
            part = np.minimum(ends[k], e[t]) - np.maximum(starts[k], s[t])
            crossing[k] += 1
            if rule == "share":
                tokens[k] += part / part.sum()
            else:
                tokens[k[np.argmax(part)]] += 1
    return lead[starts], lead[ends], tokens, crossing


def section_tokens(docs: DataFrame, text_col: str = "text", rule: str = "first", into: str = "sections",
                   ranks_path: str | None = None) -> DataFrame:
    """``docs`` with an array column ``into``: section, start_char, end_char, n_tokens,
    n_crossing. One pass, no shuffle; memory is one document's tokens at a time."""
    if rule not in RULES:
        raise ValueError("rule must be one of %s" % (RULES,))
    ranks = ranks_path or default_ranks()

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        encode, sizes = encoder(ranks)
        kind = pa.list_(pa.struct([("section", pa.int32()), ("start_char", pa.int32()), ("end_char", pa.int32()),
                                   ("n_tokens", pa.float64()), ("n_crossing", pa.int32())]))
        for col in batches:
            parts, offsets = [], [0]
            for v in col:
                text = v.as_py() or ""
                parts.append(attribute(encode(text), sizes, text.encode("utf-8", "replace"), rule))
                offsets.append(offsets[-1] + len(parts[-1][0]))
            whole = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in range(4)]
            number = (np.concatenate([np.arange(len(p[0])) for p in parts]) if parts else np.zeros(0))
            rows = pa.StructArray.from_arrays(
                [pa.array(x.astype(t)) for x, t in zip([number, *whole], ("i4", "i4", "i4", "f8", "i4"))],
                fields=list(kind.value_type))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows).cast(kind)

    return docs.withColumn(into, arrow_scan(scan, SECTIONS)(F.col(text_col)))
