"""Sequence packing by non-negative least squares over a length histogram (operator 5).

1. Every document is encoded once; its ids end with the separator id 0. Whole windows are
   cut off as they come; what is left is a tail of 0 < r < window ids. (doc, tail length,
   checksums) is the only thing stored.
2. The tails' length histogram (window - 1 counts, whatever the corpus size) is fitted by
   x >= 0 counts of shallow combinations (two or three lengths that fill a window
   exactly): accelerated projected gradient on the least-squares problem, error-diffusion
   rounding clipped to the lengths still there, and another round on what remains.
3. Tails are sorted by length; a tail's rank within its length tells its combination,
   copy and place, by arithmetic on the broadcast plan (bounded by the combinations).
4. Residual tails are cut into powers of two and packed greedily, longest first: such
   pieces never straddle a window, and the last, partial window is cut into
   powers of two as well, which need no padding.

Defined cases: a null or empty text is the separator alone; repeated rows are packed as
rows of their own; null ids are kept; a document of any length is encoded whole; empty input
gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.bpe import default_ranks, encoder
from tidemark.llm.common import arrow_scan, saved

CODED = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("full", T.ArrayType(T.LongType())),
    T.StructField("tail", T.IntegerType()), T.StructField("crc", T.LongType()),
    T.StructField("bits", T.ArrayType(T.LongType()))])

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _powers(length: int) -> list[int]:
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def encoded(docs: DataFrame, text_col: str, window: int, ranks_path: str) -> DataFrame:
    """A struct column ``coded``: token count, checksum of every whole window, tail length,
    its checksum, and the checksums of the tail cut into powers of two."""
    def scan(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        encode, _ = encoder(ranks_path)
        kind = pa.struct([("n", pa.int64()), ("full", pa.list_(pa.int64())), ("tail", pa.int32()),
                          ("crc", pa.int64()), ("bits", pa.list_(pa.int64()))])
        for col in batches:
            out = []
            for v in col:
                ids = encode(v.as_py() or "")
                ids.append(0)
                raw = memoryview(np.array(ids, "<u4").tobytes())
                whole = len(ids) // window * window
                at, bits = whole, []
                for p in _powers(len(ids) - whole):
                    bits.append(zlib.crc32(raw[4 * at:4 * (at + p)]))
                    at += p
                out.append({"n": len(ids), "full": [zlib.crc32(raw[4 * k:4 * (k + window)])
                                                    for k in range(0, whole, window)],
                            "tail": len(ids) - whole, "crc": zlib.crc32(raw[4 * whole:]), "bits": bits})
            yield pa.array(out, kind)
    return docs.withColumn("coded", arrow_scan(scan, CODED)(F.col(text_col)))


def combinations(window: int, depth: int):
    """All multisets of 2..depth lengths that fill the window exactly, as rows of ``depth``
    lengths padded with 0. Depth 2 and 3 are supported."""
    import numpy as np
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([window - a, a, np.zeros_like(a)], 1)
    if depth < 3:
        return pairs
    b, c = np.meshgrid(np.arange(1, window // 2 + 1), np.arange(1, window // 3 + 1), indexing="ij")
    first = window - b - c
    ok = (first >= b) & (b >= c)
    return np.concatenate([pairs, np.stack([first[ok], b[ok], c[ok]], 1)])


def solve_counts(hist, combos, rounds: int = 4, steps: int = 150):
    """Whole repeat counts per combination, never using more of a length than there is."""
    import numpy as np
    left = hist.astype(np.int64).copy()
    left[0] = 0
    counts = np.zeros(len(combos), np.int64)
    used = (combos > 0).astype(float)

    def down(x):                                              # A x: lengths used by counts x
        return sum(np.bincount(combos[:, k], x * used[:, k], len(hist)) for k in range(combos.shape[1]))

    for _ in range(rounds):
        if not left.any():
            break
        h = left.astype(float)
        size = float(np.bincount(combos.ravel(), minlength=len(hist))[1:].max()) * 3 or 1.0
        x = y = np.zeros(len(combos))
        t = 1.0
        for _ in range(steps):
            g = down(y) - h
            g[0] = 0
            grad = g[combos[:, 0]] + g[combos[:, 1]] + np.where(combos[:, 2] > 0, g[combos[:, 2]], 0)
            new = np.maximum(y - grad / size, 0)
            t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
            y = new + (t - 1) / t2 * (new - x)
            x, t = new, t2
        order = np.argsort(-x, kind="stable")
        run = np.floor(np.cumsum(x[order]))
        rounded = np.diff(np.concatenate(([0], run))).astype(np.int64)
        gained = 0
        for s, want in zip(order[rounded > 0], rounded[rounded > 0]):
            parts = [int(v) for v in combos[s] if v]
            can = min([int(want)] + [int(left[v]) // parts.count(v) for v in set(parts)])
            if can > 0:
                counts[s] += can
                gained += can
                for v in parts:
                    left[v] -= can
        if gained * 3 < 0.02 * left.sum():
            break
    return counts


class Plan:
    """The driver's packing plan: a few arrays whose size depends on the window alone."""

    def __init__(self, hist, window: int, depth: int, n_full: int):
        import numpy as np
        combos = combinations(window, depth)
        counts = solve_counts(hist, combos)
        live = np.flatnonzero(counts)
        slot = []                                            # (length, copies, first sequence, offset)
        seq = n_full
        for s in live:
            at = 0
            for v in combos[s]:
                if v:
                    slot.append((int(v), int(counts[s]), seq, at))
                    at += int(v)
            seq += int(counts[s])
        slot.sort(key=lambda r: r[0])
        self.length = np.array([r[0] for r in slot], np.int64)
        n = np.array([r[1] for r in slot], np.int64)
        self.seq = np.array([r[2] for r in slot], np.int64)
        self.at = np.array([r[3] for r in slot], np.int64)
        first = np.concatenate(([0], np.cumsum(hist)))[:-1]  # sorted position of each length
        used = np.bincount(self.length, n, len(hist)).astype(np.int64)
        start = np.cumsum(n) - n                             # running copies, restarted per length
        base = np.concatenate(([0], np.cumsum(used)))[:-1]
        self.lo = first[self.length] + start - base[self.length] if len(slot) else start
        self.hi = self.lo + n
        self.first, self.used = first, used
        rest = hist - used
        bits = max(1, (window - 1).bit_length())
        has = (np.arange(len(hist))[:, None] >> np.arange(bits)) & 1
        per = rest[:, None] * has
        self.before = np.cumsum(per, 0) - per                # residual pieces of a size before a length
        total = per.sum(0)
        sizes = 1 << np.arange(bits)
        bigger = np.concatenate((np.cumsum((total * sizes)[::-1])[::-1][1:], [0]))
        self.from_ = bigger                                  # running ids before a size class
        self.residual_ids = int((total * sizes).sum())
        self.first_residual = seq
        last = self.residual_ids // window
        self.tail_cuts = np.concatenate(([0], np.cumsum(_powers(self.residual_ids % window) or [0])))
        self.last, self.window = last, window

    def place_residual(self, offset: int) -> tuple[int, int]:
        """(sequence, place) of a running residual offset; the last window is cut into powers of two."""
        import bisect
        q, r = divmod(offset, self.window)
        if q < self.last:
            return self.first_residual + q, r
        k = bisect.bisect_right(self.tail_cuts, r) - 1
        return self.first_residual + self.last + k, r - int(self.tail_cuts[k])


def pack(docs: DataFrame, window: int = 1024, depth: int = 3, id_col: str = "doc_id", text_col: str = "text",
         ranks_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    coded = encoded(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                    "text", window, ranks_path or default_ranks()).select("doc_id", "coded.*")
    coded = saved(coded, "coded")

    ranged = coded.repartitionByRange("tail", "doc_id", F.xxhash64("crc", "n")).sortWithinPartitions("tail", "doc_id")
    placed = saved(ranged.mapInArrow(_numbered, "part int, at long, fulls long, doc_id long, n long, "
                                     "full array<long>, tail int, crc long, bits array<long>"), "ranked")
    parts = (placed.groupBy("part").agg(F.count("*").alias("rows"), F.sum(F.size("full")).alias("fulls"))
             .orderBy("part").collect())                     # one row per task of the sort
    hist_rows = placed.groupBy("tail").count().collect()     # at most ``window`` rows

    import numpy as np
    hist = np.zeros(window, np.int64)
    for r in hist_rows:
        hist[r["tail"]] = r["count"]
    starts, rows, fulls = {}, 0, 0
    for r in parts:
        starts[r["part"]] = (rows, fulls)
        rows += r["rows"]
        fulls += r["fulls"]
    held = spark.sparkContext.broadcast((Plan(hist, window, depth, fulls), starts))
    return placed.mapInArrow(_emit(held, window), PIECES)


def _numbered(batches: Iterator) -> Iterator:
    """Number the rows of a sorted partition, and the whole windows before each."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext
    part, at, fulls = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        t = pa.Table.from_batches([b])
        n = pc.list_value_length(t["full"]).to_numpy()
        before = fulls + np.concatenate(([0], np.cumsum(n)))
        cols = [pa.array(np.full(len(n), part, np.int32)), pa.array(at + np.arange(len(n))),
                pa.array(before[:-1].astype(np.int64))]
        at, fulls = at + len(n), int(before[-1])
        yield pa.RecordBatch.from_arrays(cols + b.columns, ["part", "at", "fulls"] + b.schema.names)


def _emit(held, window: int):
    def emit(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        plan, starts = held.value
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in batches:
            out: list = [[] for _ in names]

            def add(*row):
                for c, v in zip(out, row):
                    c.append(v)

            for r in b.to_pylist():
                row0, full0 = starts[r["part"]]
                d, n, tail, g = r["doc_id"], r["n"], r["tail"], row0 + r["at"]
                for k, crc in enumerate(r["full"]):
                    add(d, k * window, window, crc, n, full0 + r["fulls"] + k, 0)
                at = n - tail
                rank = g - plan.first[tail]
                if tail and rank < plan.used[tail]:
                    s = int(np.searchsorted(plan.hi, g, "right"))
                    add(d, at, tail, r["crc"], n, int(plan.seq[s] + g - plan.lo[s]), int(plan.at[s]))
                elif tail:
                    extra = int(rank - plan.used[tail])
                    for crc, size in zip(r["bits"], _powers(tail)):
                        k = size.bit_length() - 1
                        run = int(plan.from_[k]) + (int(plan.before[tail, k]) + extra) * size
                        add(d, at, size, crc, n, *plan.place_residual(run))
                        at += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
    return emit
