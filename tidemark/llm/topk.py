"""Exact top-k inner-product search (operator 7).

Exhaustive term-at-a-time accumulation: candidates are cut into blocks and each block is
turned into postings per term (dimension); every nonzero term of a query scatters its
weight times the posting weights into a dense score array; the k best of the block are
chosen by partition selection, and the blocks' lists are merged per query.

Queries travel in waves of a bounded number of bytes, broadcast to the candidate tasks;
candidates are never shuffled. Per query and task at most k rows go to the merge.

Defined cases: rows with a null id, a null vector, or a null or non-finite component
take no part; vectors of different lengths meet on their common dimensions; a query's
own rows (same id) are not its candidates; repeated query rows with one id are one query
(the smallest vector); ties go to the smaller id; no candidates means no rows. Scaled
components beyond 2**31 are clipped there; scores are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import saved


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component, clipped to 32 bits; unusable rows left out."""
    x = F.col(vec_col)
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    edge = float(2 ** 31 - 1)
    v = F.transform(x, lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(edge)), F.lit(-edge)))
                    .cast("int"))
    return (vectors.where(F.coalesce(sound, F.lit(False)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")))


def _matrix(ids, rows):
    """(ids, dense int64 matrix) of ragged rows, padded with zeros."""
    import numpy as np
    wide = max((len(r) for r in rows), default=0)
    m = np.zeros((len(rows), wide), np.int64)
    for k, r in enumerate(rows):
        m[k, :len(r)] = r
    return np.asarray(ids, np.int64), m


def accumulate(queries, block):
    """Scores [query, candidate] by terms: each query holding term t adds its weight
    times the postings of t into its dense row."""
    import numpy as np
    big = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(1, block.shape[1])
    kind = np.int32 if big < 2 ** 31 else np.int64
    acc = np.zeros((len(queries), len(block)), kind)
    cols, qs = np.ascontiguousarray(block.T.astype(kind)), queries.astype(kind)
    for t in range(min(queries.shape[1], block.shape[1])):
        rows = np.flatnonzero(qs[:, t])
        post = np.flatnonzero(cols[t])
        if not len(rows) or not len(post):
            continue
        if 2 * len(post) < len(block):                  # sparse postings: scatter
            acc[np.ix_(rows, post)] += qs[rows, t][:, None] * cols[t, post][None, :]
        else:                                           # dense postings: whole rows
            weights = cols[t]
            for r in rows:
                acc[r] += qs[r, t] * weights
    return acc


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 64.0, wave_bytes: int = 16_000_000, block_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for every query row."""
    spark = vectors.sparkSession
    cand = quantised(vectors, id_col, vec_col, scale)
    q = quantised(queries, id_col, vec_col, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    # every query gets a wave number from its running size, one wave within wave_bytes
    q = saved(q.withColumn("w", F.size("v") * 8 + 64), "queries")
    total = q.agg(F.sum("w")).first()[0] or 0
    waves = max(1, -(-int(total) // wave_bytes))
    out = None
    for w in range(waves):
        part = q.where(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == w).select("vec_id", "v").collect()
        held = spark.sparkContext.broadcast(([r[0] for r in part], [r[1] for r in part]))
        found = cand.mapInArrow(_search(held, k, block_rows), "query_id long, vec_id long, score long")
        out = found if out is None else out.union(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search(held, k: int, block_rows: int):
    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        qid, qs = _matrix(*held.value)
        best: list = []                                 # per chunk of queries: (score, id) kept so far
        for lo in range(0, len(qid), 512):
            best.append((np.zeros((min(512, len(qid) - lo), 0), np.int64),) * 2)

        def feed(ids, m):
            order = np.argsort(ids, kind="stable")      # ties: smaller ids first
            ids, m = ids[order], m[order]
            for c, lo in enumerate(range(0, len(qid), 512)):
                mine = qid[lo:lo + 512]
                acc = accumulate(qs[lo:lo + 512], m).astype(np.int64)
                own = mine[:, None] == ids[None, :] if np.isin(mine, ids).any() else None
                floor_ = np.iinfo(np.int64).min
                if own is not None:
                    acc[own] = floor_
                keep = min(k, len(ids))
                # composite key: score first, then the smaller position
                key_ok = np.abs(np.where(acc == floor_, 0, acc)).max(initial=0) < 2 ** 40
                if key_ok:
                    comp = np.where(acc == floor_, floor_, acc * 2 ** 20 - np.arange(len(ids)))
                    at = np.argpartition(comp, len(ids) - keep, axis=1)[:, len(ids) - keep:]
                else:
                    at = np.argsort(-acc.astype(object), axis=1, kind="stable")[:, :keep]
                sc = np.concatenate((best[c][0], np.take_along_axis(acc, at, 1)), 1)
                vi = np.concatenate((best[c][1], ids[at]), 1)
                if sc.shape[1] > k:
                    o = np.lexsort((vi, -np.maximum(sc, floor_ + 1)), axis=1)[:, :k]
                    sc, vi = np.take_along_axis(sc, o, 1), np.take_along_axis(vi, o, 1)
                best[c] = (sc, vi)

        ids, rows = [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += batch.column(1).to_pylist()
            while len(ids) >= block_rows:
                feed(*_matrix(ids[:block_rows], rows[:block_rows]))
                ids, rows = ids[block_rows:], rows[block_rows:]
        if ids:
            feed(*_matrix(ids, rows))
        for c, lo in enumerate(range(0, len(qid), 512)):
            sc, vi = best[c]
            real = sc != np.iinfo(np.int64).min
            if real.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(qid[lo:lo + 512], real.sum(1))), pa.array(vi[real]), pa.array(sc[real])],
                    ["query_id", "vec_id", "score"])
    return search
