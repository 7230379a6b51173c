"""Filter interaction audit (operator 11): what five quality filters remove, alone and in
every order.

Radix text tries find the filter on copies. Every task first puts its texts into a compressed
trie, the smallest id at each terminal: a row whose id is not the smallest of its text there is
a copy for certain and travels on as a few numbers, so of any text at most one row per
id still in question leaves a task's trie, however many copies there are. The texts of those are
range-partitioned by their prefix (its first ``PREFIX`` bytes; where many texts share those, the key goes
on with a hash of the whole text, so that Spark's range bounds, which follow the data, can part
them), sorted by that key, and put into tries again: equal texts meet in one range, and a terminal's
smallest id is the smallest of the whole table. Traversing a trie gives the flags. A trie is
emptied when it holds ``TRIE_BYTES`` of text and the key moves on, so memory does not grow with the range.

Each row then is a mask of the filters it fails; masks are counted per part before anything
else, and all orders of the filters are read off these counts (at most 32 per part).

Defined cases: a null text is empty; a null language is part ``''``; a null id fails filter E
never and makes no other row fail it; rows that repeat id and text are no copies of each other; labels that
repeat an id count if any of them does, null labels do not; an empty table gives no rows. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

#: Bytes of a text that order the ranges; texts alike in them are ordered by a hash.
PREFIX = 64
#: Bytes of text that a trie takes before it is emptied.
TRIE_BYTES = 32_000_000

FILTERS = "ABCDE"
COPY = 16

#: Fixed values of the filters: words, distinct share, upper-case share, characters.
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"
UPPER = bytes(range(0x41, 0x5B))
CONTINUATION = bytes(range(0x80, 0xC0))         # UTF-8 bytes that begin no code point


def text_mask(text: bytes) -> int:
    """Which of filters A to D a text fails: bits 1, 2, 4, 8."""
    words = text.split()                        # bytes split at 0x20 and 0x09 to 0x0D alone
    points = len(text.translate(None, CONTINUATION))
    upper = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < MIN_WORDS) | 2 * (100 * len(set(words)) < DISTINCT_PERCENT * len(words))
            | 4 * (100 * upper > UPPER_PERCENT * points) | 8 * (len(text.translate(None, SYMBOLS)) < len(text)))


class Trie:
    """A compressed trie of byte strings. A terminal holds the smallest id put there, the
    mask of its text, and how many rows came per (id, part)."""

    def __init__(self) -> None:
        self.root = [b"", {}, None]             # label, children by first byte, terminal
        self.size = 0

    def put(self, text: bytes, row_id, part: str, mask, n: int) -> None:
        node, at, end = self.root, 0, len(text)
        self.size += end + 200
        while at < end:
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:], {}, None]
            label = child[0]
            if not text.startswith(label, at):  # the label parts from the text: cut it there
                cut = _common(label, text, at)
                upper = [label[:cut], {label[cut]: child}, None]
                child[0] = label[cut:]
                node[1][text[at]] = child = upper
            at += len(child[0])
            node = child
        if node[2] is None:
            node[2] = [None, text_mask(text) if mask is None else mask, {}]
        end = node[2]
        if row_id is not None and (end[0] is None or row_id < end[0]):
            end[0] = row_id
        end[2][row_id, part] = end[2].get((row_id, part), 0) + n

    def terminals(self) -> Iterator:
        """(text, smallest id, mask, counts by (id, part)), texts in byte order."""
        path: list[bytes] = []
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            del path[depth:]
            path.append(node[0])
            if node[2] is not None:
                yield b"".join(path), *node[2]
            for first in sorted(node[1], reverse=True):
                stack.append((node[1][first], depth + 1))


def _common(label: bytes, text: bytes, at: int) -> int:
    """The length of the longest prefix of ``label`` that ``text`` has at ``at``."""
    lo, hi = 0, len(label)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if text.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _columns(batch) -> Iterator:
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))


def _table(rows: list, kinds):
    import pyarrow as pa
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.types)], kinds.names)


def _local(batches: Iterator) -> Iterator:
    """Rows (doc_id, part, mask, n, text): the text only where the id is the smallest of it here."""
    import pyarrow as pa
    kinds = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()),
                       ("text", pa.binary())])

    def emptied(trie):
        rows, size = [], 0
        for text, least, mask, counts in trie.terminals():
            for (row_id, part), n in counts.items():
                if row_id is None or row_id != least:
                    rows.append((row_id, part, mask | COPY * (row_id is not None), n, None))
                else:
                    rows.append((row_id, part, mask, n, text))
                    size += len(text)
            if size > 4_000_000 or len(rows) > 10_000:
                yield _table(rows, kinds)
                rows, size = [], 0
        yield _table(rows, kinds)

    trie = Trie()
    for batch in batches:
        for row_id, part, text in _columns(batch):
            trie.put(text, row_id, part, None, 1)
            if trie.size > TRIE_BYTES:
                yield from emptied(trie)
                trie = Trie()
    yield from emptied(trie)


def _global(batches: Iterator) -> Iterator:
    """Rows (doc_id, part, mask, n) with filter E settled, from rows sorted by (prefix, spread)."""
    import pyarrow as pa
    kinds = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])

    def emptied(trie):
        return _table([(row_id, part, mask | COPY * (row_id != least), n)
                       for _, least, mask, counts in trie.terminals() for (row_id, part), n in counts.items()], kinds)

    trie, before = Trie(), None
    for batch in batches:
        done = []
        for row_id, part, mask, n, text, prefix, spread in _columns(batch):
            if text is None:                    # settled in its first trie
                done.append((row_id, part, mask, n))
                continue
            if trie.size > TRIE_BYTES and (prefix, spread) != before:
                yield emptied(trie)
                trie = Trie()
            before = prefix, spread
            trie.put(text, row_id, part, mask, n)
        yield _table(done, kinds)
    yield emptied(trie)


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask, n): the filters that a document fails (A 1, B 2, C 4, D 8, E 16), and how many rows
    are alike in all of these."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = given.mapInArrow(_local, "doc_id long, part string, mask int, n long, text binary")
    prefix = F.coalesce(F.substring("text", 1, PREFIX), F.lit("").cast("binary"))
    spread = F.when(F.col("text").isNotNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id", "part"))
    keyed = rows.withColumns({"prefix": prefix, "spread": spread})
    ranges = keyed.repartitionByRange("prefix", "spread").sortWithinPartitions("prefix", "spread")
    return ranges.mapInArrow(_global, "doc_id long, part string, mask int, n long")


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): rows per mask, those of quality 1 and those that are toxic."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    n = F.col("n")
    return flagged.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_counts``."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = parts.select("part", "masks", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    at = {f: F.instr("filter_order", f) for f in FILTERS}
    earlier = sum((F.when(at[f] < F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    own = sum((F.when(at[f] == F.col("step"), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    rows = rows.withColumns({"earlier": earlier, "own": own})

    def count(where, what="n", weight=lambda m: F.lit(1)) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + F.when(
            where(m["mask"]), m[what] * weight(m["mask"])).otherwise(0).cast("long"))

    before, mine = F.col("earlier"), F.col("own")
    gone = lambda m: m.bitwiseAND(before) != 0                                  # noqa: E731
    fails = lambda m: m.bitwiseAND(mine) != 0                                   # noqa: E731
    here = lambda m: fails(m) & ~gone(m)                                        # noqa: E731
    # of the 120 orders, an equal share has this filter first among those that the row fails
    turns = lambda m: F.floor(F.lit(120) / F.bit_count(m))                      # noqa: E731
    return rows.select(
        "part", "filter_order", "step", count(lambda m: ~gone(m) & ~fails(m)).alias("kept"),
        count(here).alias("removed"), count(lambda m: fails(m) & gone(m)).alias("redundant"),
        count(lambda m: m == mine).alias("unique_fails"), count(here, "good").alias("good_lost"),
        count(here, "toxic").alias("toxic_lost"), count(fails, "n", turns).alias("shapley"))
