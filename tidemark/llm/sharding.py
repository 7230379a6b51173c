"""Uniform shuffle into shards of exact sizes (operator 13), DataFrame functions only.

Hypergeometric communication matrix: rows sit in blocks (the partitions of the shuffle);
how many rows go from each block to each shard is drawn first, exactly as a uniform
permutation would have it. A block then permutes its own rows and deals them out by its
row of the matrix, rows are exchanged, and each shard permutes what it got.

The matrix is drawn down a binary tree over the blocks: the left half of a node's blocks
takes a multivariate hypergeometric share of the node's shard sizes, the right half the
rest. One draw walks the probabilities outwards from the mode by their ratios, at most 12
standard deviations + 50 steps to either side (what lies beyond has less than 1e-20 of
the mass, below what a double can tell from 0). Nodes are rows: a level is one projection,
and levels are dealt out anew every few levels, so the matrix is never drawn in one task.

Rows get a number once, in a table written to the shared folder, and every random
number is a hash of seed and row number: a task that is run again after a lost executor
draws the same. Blocks have as many rows as a shuffle partition (``spark.sql.shuffle.partitions``
of them, more where a block would exceed ``block_rows``); equal or repeated rows have numbers of their
own, so no group of copies can heat a block. Two narrow shuffles place the row numbers,
and the rows themselves move once, in a join on their number.

Defined cases: any column may be null; repeated rows are rows of their own; an empty table
gives no rows; with fewer rows than shards the last shards stay empty; input columns called
``shard`` or ``slot`` come back as ``shard_in`` and ``slot_in``. The same seed and the same
files give the same shards; the number given to a row depends on how Spark lists the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import free_names, saved

#: Rows are dealt out again after this many levels of the tree.
LEVELS_PER_DEAL = 6


def unit(*parts) -> Column:
    """A uniform number in [0, 1) that depends on ``parts`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` items, taken without replacement, are among the ``good`` ones:
    the inverse of the distribution, summed outwards from its mode, at ``u``."""
    g, b, n = (c.cast("double") for c in (good, bad, draws))
    total = g + b
    mode = F.greatest(F.lit(0.0), n - b, F.least(g, n, F.floor((n + 1) * (g + 1) / (total + 2)).cast("double")))
    spread = F.sqrt(F.when(total > 1, n * (g / total) * (b / total) * (total - n) / (total - 1)).otherwise(F.lit(0.0)))
    reach = F.least(F.ceil(spread * 12 + 50), F.greatest(F.least(g, n), F.lit(0.0)).cast("long"))
    given = F.struct(g.alias("g"), b.alias("b"), n.alias("n"), mode.alias("mode"), reach.cast("int").alias("reach"),
                     u.alias("u"))

    def draw(p):
        def wider(acc, i):                      # weights of mode + i and mode - i, relative to the mode's
            up, down = p["mode"] + i - 1, p["mode"] - i + 1
            more = acc["up"] * (p["g"] - up) * (p["n"] - up) / ((up + 1) * (p["b"] - p["n"] + up + 1))
            less = acc["down"] * down * (p["b"] - p["n"] + down) / ((p["g"] - down + 1) * (p["n"] - down + 1))
            return (F.when(acc["up"] > 0, more).otherwise(F.lit(0.0)),
                    F.when(acc["down"] > 0, less).otherwise(F.lit(0.0)))

        steps = F.when(p["reach"] > 0, F.sequence(F.lit(1), p["reach"])).otherwise(F.array().cast("array<int>"))

        def add(acc, i):
            up, down = wider(acc, i)
            return let(F.struct(up.alias("up"), down.alias("down")), lambda w: F.struct(
                w["up"].alias("up"), w["down"].alias("down"), (acc["sum"] + w["up"] + w["down"]).alias("sum")))

        def find(acc, i):
            up, down = wider(acc, i)
            return F.when(acc["pick"].isNotNull(), acc).otherwise(
                let(F.struct(up.alias("up"), down.alias("down")), lambda w: F.struct(
                    w["up"].alias("up"), w["down"].alias("down"),
                    (acc["left"] - w["up"] - w["down"]).alias("left"),
                    F.when(acc["left"] < w["up"], p["mode"] + i)
                    .when(acc["left"] < w["up"] + w["down"], p["mode"] - i).alias("pick"))))

        one = F.lit(1.0)
        mass = F.aggregate(steps, F.struct(one.alias("up"), one.alias("down"), one.alias("sum")), add)["sum"]
        start = let(mass * p["u"] - 1, lambda left: F.struct(
            one.alias("up"), one.alias("down"), left.alias("left"),
            F.when(left < 0, p["mode"]).alias("pick")))
        return F.coalesce(F.aggregate(steps, start, find)["pick"], p["mode"]).cast("long")

    return let(given, draw)


def share(sizes: Column, draws: Column, *key) -> Column:
    """One multivariate hypergeometric draw: how many of ``draws`` items fall to each of ``sizes``."""
    def take(acc, size):
        rest = acc["rest"] - size
        return let(hypergeometric(size, rest, acc["draws"], unit(*key, F.size(acc["out"]))), lambda h: F.struct(
            (acc["draws"] - h).alias("draws"), rest.alias("rest"), F.concat(acc["out"], F.array(h)).alias("out")))
    start = F.struct(draws.cast("long").alias("draws"), total_of(sizes).alias("rest"),
                     F.array().cast("array<long>").alias("out"))
    return F.aggregate(sizes, start, take)["out"]


def total_of(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)


def communication_matrix(counts: DataFrame, shards: int, blocks: int, seed: int) -> DataFrame:
    """(block, takes): how many of a block's rows each shard takes, for ``counts`` (block, n).
    Shard sizes differ by one at most, the larger ones first."""
    root = counts.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks"))
    n = total_of(F.transform("blocks", lambda b: b["n"]))
    nodes = root.where(F.size("blocks") > 0).withColumn("n", n).select(
        F.lit(1).cast("long").alias("node"), "blocks",
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                    lambda j: F.floor(F.col("n") / shards) + (j < F.col("n") % shards).cast("long")).alias("sizes"))
    for level in range(max(0, (blocks - 1).bit_length())):
        if level and level % LEVELS_PER_DEAL == 0:
            nodes = nodes.repartition("node")
        half = F.floor((F.size("blocks") + 1) / 2).cast("int")
        near = F.slice("blocks", F.lit(1), half)
        far = F.slice("blocks", half + 1, F.size("blocks"))
        taken = share(F.col("sizes"), total_of(F.transform(near, lambda b: b["n"])), F.lit(seed), F.col("node"))
        child = let(taken, lambda t: F.array(
            F.struct((F.col("node") * 2).alias("node"), near.alias("blocks"), t.alias("sizes")),
            F.struct((F.col("node") * 2 + 1).alias("node"), far.alias("blocks"),
                     F.zip_with("sizes", t, lambda a, b: a - b).alias("sizes"))))
        nodes = nodes.select(F.explode(child).alias("c")).select("c.*").where(F.size("blocks") > 0)
    return nodes.select(F.col("blocks")[0]["block"].alias("block"), F.col("sizes").alias("takes"))


def place(rows: DataFrame, shards: int, seed: int = 0, block_rows: int = 1_000_000) -> DataFrame:
    """(row, shard, slot) for every ``row`` number of ``rows``; slots run from 0 in each shard."""
    spark = rows.sparkSession
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    n = rows.count()
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // block_rows), 1)
    rows = rows.select("row", F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), "row"), F.lit(blocks)).alias("block"))
    matrix = saved(communication_matrix(rows.groupBy("block").agg(F.count("*").alias("n")), shards, blocks, seed), "matrix")
    first = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), F.lit("first"), "row"), "row")
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: total_of(F.slice("takes", F.lit(1), j)))
    dealt = (rows.withColumn("at", F.row_number().over(first))
             .join(matrix.select("block", ends.alias("ends")).hint("merge"), "block")
             .select("row", F.size(F.filter("ends", lambda e: e < F.col("at"))).alias("shard")))
    # the second permutation, by parts of a shard: part p holds the p-th range of the random numbers, and any
    # fixed order of the numbers within a part is as random as another
    parts = -(-blocks // shards)
    second = F.xxhash64(F.lit(seed), F.lit("second"), "row")
    dealt = saved(dealt.withColumn("key", second)
                  .withColumn("part", F.shiftright(F.shiftrightunsigned("key", 33) * parts, 31)), "dealt")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
              .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = Window.partitionBy("shard", "part").orderBy("key", "row")
    return (dealt.withColumn("at", F.row_number().over(inside)).join(starts.hint("merge"), ["shard", "part"])
            .select("row", "shard", (F.col("start") + F.col("at") - 1).cast("long").alias("slot")))


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, block_rows: int = 1_000_000) -> DataFrame:
    """All columns of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0 in each shard):
    a uniform permutation of all rows, cut into shards whose sizes differ by one at most."""
    rows = saved(df.select(F.struct(*[F.col("`%s`" % c) for c in df.columns]).alias("r"),
                           F.monotonically_increasing_id().alias("row")), "numbered")
    placed = rows.join(place(rows.select("row"), shards, seed, block_rows).hint("merge"), "row")
    names = free_names(df.columns, ("shard", "slot"), "_in")
    return placed.select(*[F.col("r")[c].alias(to) for c, to in zip(df.columns, names)], "shard", "slot")


def write_shards(df: DataFrame, path: str, shards: int, seed: int = 0, block_rows: int = 1_000_000) -> None:
    """The rows of ``df`` as Parquet in one folder ``shard=N`` per shard, sorted by slot within each file."""
    out = shuffle_into_shards(df, shards, seed, block_rows)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """One shard in the order of its slots."""
    return spark.read.parquet(path).where(F.col("shard") == shard).orderBy("slot")
