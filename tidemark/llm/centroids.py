"""Centroid clustering of integer vectors (operator 12).

Scalar lookup tables: for every block of rows and every dimension, the squared difference
of each integer value that occurs there and each centroid is tabulated once; the
distances of the block's rows are gathers from these tables, summed over the dimensions.
The number of differences computed is that of occurring values, not of rows.

Vectors are quantised once into a shared table. A round reads it in place, sums members and
components per cluster in each task, and shuffles one row per cluster and task; only the
k sums come to the driver, and only the k centroids go out with the next round's
tasks. A block's tables are dropped before the next block's are built, so memory is that of one Arrow
batch. Everything is in exact integers: 32 bits where the largest possible distance fits, 64 bits
where that fits, else Python integers.

Defined cases: vectors that are null, of another length, or that hold a null or non-finite
component are left out; a null id is clustered but is no start; repeated rows count as often as they
come; ties go to the smaller cluster; fewer vectors than k give fewer clusters; empty clusters keep their
centroid; an empty table gives no rows. Other columns are not read. A component whose integer is beyond
2**62 fails the job with a message, as does a distance or a sum of distances beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import saved

LARGEST = 2 ** 62


def integer_vectors(vectors: DataFrame, dims: int, scale: float, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; unusable vectors left out."""
    x = F.col(vec_col)
    sound = (F.size(x) == dims) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def whole(c):
        y = c.cast("double") * scale
        return F.when(F.abs(y) < float(LARGEST), F.floor(y)).otherwise(
            F.raise_error(F.lit("a component beyond 2**62 after scaling can't be clustered")))
    return (vectors.where(F.coalesce(x.isNotNull() & sound, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, whole).alias("v")))


def starts(points: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors whose id, after ``salt``, has the smallest SHA-256."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = points.where("vec_id is not null").select(key.alias("key"), "v").orderBy("key", "v").limit(k)
    return [list(r["v"]) for r in first.collect()]


def distances(v, centroids: list[list[int]]):
    """Squared distances [row, centroid] of the rows of ``v`` by lookup tables."""
    import numpy as np
    reach = max(int(v.max(initial=0)), -int(v.min(initial=0)), *(abs(x) for c in centroids for x in c), 0)
    most = 4 * reach * reach * v.shape[1]
    kind = np.int32 if most < 2 ** 31 else np.int64 if most < 2 ** 63 else object
    c = np.array(centroids, dtype=kind).reshape(len(centroids), v.shape[1])
    total = np.zeros((len(v), len(centroids)), kind)
    for d in range(v.shape[1]):
        column = np.ascontiguousarray(v[:, d])
        lo, hi = int(column.min()), int(column.max())
        if hi - lo < 8 * len(column) + 1024:            # dense values: count them off
            there = np.zeros(hi - lo + 1, bool)
            there[column - lo] = True
            values, at = np.flatnonzero(there) + lo, (np.cumsum(there) - 1)[column - lo]
        else:
            values, at = np.unique(column, return_inverse=True)
        table = (values.astype(kind)[:, None] - c[:, d][None, :]) ** 2
        total += table[at]
    return total


def _blocks(batches: Iterator, dims: int) -> Iterator:
    """(ids, int64 matrix) of each Arrow batch that has rows."""
    import numpy as np
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0), np.asarray(batch.column(1).flatten()).astype(np.int64).reshape(batch.num_rows, dims)


def _summed(centroids: list[list[int]], dims: int):
    def summed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from decimal import Decimal
        n = [0] * len(centroids)
        sums = [[0] * dims for _ in centroids]
        for _, v in _blocks(batches, dims):
            nearest = distances(v, centroids).argmin(axis=1)
            wide = v if int(np.abs(v).max()) * len(v) < 2 ** 62 else v.astype(object)
            for j in np.unique(nearest).tolist():
                mine = wide[nearest == j]
                n[j] += len(mine)
                sums[j] = [a + int(b) for a, b in zip(sums[j], mine.sum(axis=0))]
        full = [j for j in range(len(centroids)) if n[j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([n[j] for j in full], pa.int64()),
             pa.array([[Decimal(s) for s in sums[j]] for j in full], pa.list_(pa.decimal128(38, 0)))],
            ["cluster", "n", "sums"])
    return summed


def _assigned(centroids: list[list[int]], dims: int):
    def assigned(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for ids, v in _blocks(batches, dims):
            far = distances(v, centroids)
            nearest = far.argmin(axis=1)
            own = far[range(len(v)), nearest]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nearest.astype("int32")), pa.array([int(x) for x in own], pa.int64())],
                ["vec_id", "cluster", "distance"])
    return assigned


def refine(points: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """One round: the componentwise floor of the mean of each centroid's nearest vectors."""
    part = points.mapInArrow(_summed(centroids, dims), "cluster int, n long, sums array<decimal(38,0)>")
    sums = part.select("cluster", "n", F.posexplode("sums").alias("d", "s"))
    out = [list(c) for c in centroids]
    for r in sums.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        out[r["cluster"]][r["d"]] = int(r["s"]) // r["n"]
    return out


def cluster(vectors: DataFrame, k: int, rounds: int, dims: int, scale: float = 256.0, salt: str = "",
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector
    after ``rounds`` rounds from the k starts; centroid is the cluster's final one."""
    points = saved(integer_vectors(vectors, dims, scale, id_col, vec_col), "points")
    centroids = starts(points, k, salt)
    names = "vec_id long, cluster int, distance long"
    if not centroids:
        none = points.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)
        return none.select("*", *[F.col("distance").alias(c) for c in ("cluster_inertia", "inertia")],
                           F.array().cast("array<long>").alias("centroid"))
    for _ in range(rounds):
        centroids = refine(points, centroids, dims)
    found = saved(points.mapInArrow(_assigned(centroids, dims), names), "clusters")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}

    def of_cluster(values, kind):
        return F.array(*[F.lit(x) for x in values]).cast("array<%s>" % kind)[F.col("cluster")]
    held = F.array(*[F.array(*[F.lit(x) for x in c]).cast("array<long>") for c in centroids])[F.col("cluster")]
    return found.select("*", of_cluster([inertia.get(j, 0) for j in range(len(centroids))], "long").alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"), held.alias("centroid"))
