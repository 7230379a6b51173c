"""Near-duplicate components by an n-gram Jaccard join with vertical partitioning (operator 2).

1. Each distinct text becomes the set of its hashed word n-grams (64-bit; sets are known by a
   64-bit id, so copies collapse at once, within a task and again after the shuffle).
2. The n-gram domain is cut into fragments. Fragments are shuffled apart as packed
   segments, in ``TURNS`` parts of the fragments one after the other (the texts are read again for
   each, so that no more than one part is on disk), and each counts how many sets hold each of its n-grams. N-grams of
   one set only can link nothing and end there. The global order is (that count, hash),
   rare first; n-grams in a large share of all entries ("heavy", at most 1 / ``heavy_share`` of them,
   found by a first pass) are not shuffled by hash but come last in the order.
3. A set of n n-grams needs only its first n - ceil(t n) + 1 in the order (prefix) to meet every
   set it can be similar to. Candidates that share a prefix n-gram have their overlap
   counted fragment by fragment (partial overlaps), summed per pair and checked exactly. The
   n-grams from the common one on bound the overlap, so most lists yield few candidates.
4. Only components are asked for, so pairs already connected are never compared: rounds
   pair each set with the pivot of one of its prefix lists (a star, one pair per set), merge
   what links, and drop the lists that have become one component. The exact end compares the pairs of
   different components in the remaining lists, each distinct list once; parity bits of the
   sets bound what two of them do not share, so that sets that are alike but too far apart to link make no rows.

No list is collected: pivots and list signatures are aggregates combined map-side, and
the joins back are plain equi-joins that adaptive execution splits when a list is hot.

Defined cases: null and empty texts have no n-grams, link with nothing and are their own
component; fewer words than n make one n-gram of the whole sequence; rows with one doc_id
are separate rows with a result each; a null id never names a component (it gets the
smallest non-null id, or null); texts of any length are used whole; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Rounds, components, saved

_LOWER = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Odd multipliers of the polynomial hash and the finaliser's shifts. Fixed values.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2 ** 64)
MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
PIECE = 1 << 20
FLUSH = 2_000_000
TURNS = 2
_POWERS: dict = {}


def _mix(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def _powers(n: int):
    import numpy as np
    if _POWERS.get("n", 0) < n:
        for name, b in (("up", BASE), ("down", INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def shingle_sets(texts: list, words: int):
    """The sorted distinct n-gram hashes of each text (an empty array without words)."""
    import numpy as np
    data = b" ".join(t.encode("utf-8", "replace").translate(_LOWER) if t else b"" for t in texts) + b" "
    sizes = np.array([len(t.encode("utf-8", "replace")) + 1 if t else 1 for t in texts])
    a = np.frombuffer(data, np.uint8)
    up, down = _powers(max(len(a), PIECE + (PIECE >> 2)))
    body = a != 32
    edge = np.diff(body.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    run = np.concatenate(([np.uint64(0)], np.cumsum((a.astype(np.uint64) + np.uint64(1)) * down[:len(a)])))
    w = _mix((run[end] - run[start]) * up[start] + (end - start).astype(np.uint64) * np.uint64(MIX1))
    bounds = np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes))))
    coef = [np.uint64(pow(BASE, k + 1, 2 ** 64)) for k in range(words)]
    if len(w) >= words:
        grams = sum((w[k:len(w) - words + 1 + k] * coef[k] for k in range(1, words)), w[:len(w) - words + 1] * coef[0])
        grams = _mix(grams)
    out = []
    for lo, hi in zip(bounds, bounds[1:]):
        if hi - lo >= words:
            out.append(np.unique(grams[lo:hi - words + 1]))
        elif hi > lo:
            extra = np.uint64((int(hi - lo) * MIX2) % 2 ** 64)
            short = sum((w[lo + k:lo + k + 1] * coef[k] for k in range(hi - lo)), np.zeros(1, np.uint64))
            out.append(_mix(short + extra))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batches, words: int):
    """(doc_id, sorted hashes, set id) of every row; texts are worked on in small pieces."""
    import hashlib
    for b in batches:
        ids, texts = b.column(0).to_pylist(), b.column(1)
        at = 0
        while at < len(ids):
            part, size, first = [], 0, at
            while at < len(ids) and (not part or size < PIECE):
                part.append(texts[at].as_py())
                size += len(part[-1] or "")
                at += 1
            for d, s in zip(ids[first:at], shingle_sets(part, words)):
                sid = int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                yield d, s, sid


def _count_heavy(words: int, share: float):
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        held, size, seen = [], 0, set()

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            ok = n >= max(2, share * size)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(h[ok].view(np.int64), 0)), pa.array(np.append(n[ok], size)),
                 pa.array(np.append(np.zeros(ok.sum(), bool), True))], ["h", "n", "total"])
        for _, s, sid in _sets(batches, words):
            if sid in seen or not len(s):
                continue
            seen.add(sid)
            held.append(s)
            size += len(s)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()
    return count


SEGMENTS = "kind int, frag int, doc_id long, n int, sid long, data binary"


def _fragment_keys(spark, parts: int) -> list[int]:
    """One integer per task of a hash partitioning into ``parts``, so that fragments and
    tasks are one to one (a few of each task are tried; their number depends on ``parts`` alone)."""
    k = F.col("id").cast("int")
    got = (spark.range(parts * 40 + 400).groupBy(F.pmod(F.hash(k), F.lit(parts)).alias("p")).agg(F.min(k)).collect())
    keys = dict((r[0], r[1]) for r in got)
    return [keys.get(p, p) for p in range(parts)]


def _segment(words: int, heavy, keys: list[int], turn: int = 0, turns: int = 1):
    """Map side: membership (kind 0), packed segments (kind 1) of the fragments of this turn, heavy
    n-grams of a set (kind 2). Membership and heavy n-grams come in the first turn."""
    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        hot, frags = heavy.value, len(keys)
        seen: set = set()
        rows: list = []
        held, size = [], 0

        def flush():
            h = np.concatenate([x[2] for x in held]) if held else np.zeros(0, np.uint64)
            which = np.repeat(np.arange(len(held)), [len(x[2]) for x in held])
            sid = np.array([x[0] for x in held], np.int64)
            frag = (h % np.uint64(frags)).astype(np.int32)
            order = np.flatnonzero(frag % turns == turn)
            order = order[np.argsort(frag[order], kind="stable")]
            cuts = np.searchsorted(frag[order], np.arange(frags + 1))
            for f in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[f]:cuts[f + 1]]
                who, runs = np.unique(which[at], return_counts=True)
                rest = (h[at] // np.uint64(frags)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                head, m = _runs(sid[who], runs)
                rows.append((1, keys[f], None, m, None, head + rest.tobytes()))

        def batch():
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             ["kind", "frag", "doc_id", "n", "sid", "data"])
            rows.clear()
            return out
        for d, s, sid in _sets(batches, words):
            if not turn:
                rows.append((0, keys[(sid if len(s) else hash(d)) % frags], d, len(s), sid if len(s) else None, None))
            if len(s) and sid not in seen:
                seen.add(sid)
                if len(hot):
                    is_hot = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s
                    if is_hot.any():
                        if not turn:
                            rows.append((2, keys[sid % frags], None, len(s), sid, s[is_hot].tobytes()))
                        held.append((sid, len(s), s[~is_hot]))
                    else:
                        held.append((sid, len(s), s))
                else:
                    held.append((sid, len(s), s))
                size += len(s)
            if size >= FLUSH:
                flush()
                held, size = [], 0
                yield batch()
            elif len(rows) > 20_000:
                yield batch()
        flush()
        yield batch()
    return cut


def _runs(values, runs) -> tuple[bytes, int]:
    """Run-length form of repeated 64-bit values and its number of runs (each of 255 at most, one byte)."""
    import numpy as np
    cuts = -(-runs // 255)
    short = np.full(int(cuts.sum()), 255, np.uint8)
    short[np.cumsum(cuts) - 1] = runs - 255 * (cuts - 1)
    return np.repeat(values, cuts).tobytes() + short.tobytes(), len(short)


def _unpack(m: int, raw: bytes, tail: int):
    """(48-bit remainders, set ids) of a packed segment of ``m`` runs with ``tail`` bytes behind an entry."""
    import numpy as np
    runs = np.frombuffer(raw, np.uint8, m, 8 * m)
    total = int(runs.sum())
    rest = np.zeros((total, 8), np.uint8)
    rest[:, :6] = np.frombuffer(raw, np.uint8, 6 * total, 9 * m).reshape(-1, 6)
    return rest.view("<u8").ravel(), np.repeat(np.frombuffer(raw, np.int64, m), runs), raw[len(raw) - tail * total:]


def _count_fragment(keys: list[int]):
    """One task's fragment: count sets per n-gram, keep shared n-grams, deal them to their sets."""
    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        frags, mine = len(keys), TaskContext.get().partitionId()
        packed = []
        for b in batches:
            kind = b.column(0).to_numpy(zero_copy_only=False)
            other = b.filter(pa.array(kind != 1))
            if other.num_rows:
                yield other
            for m, raw in zip(*[b.filter(pa.array(kind == 1)).column(k).to_pylist() for k in (3, 5)]):
                packed.append(_unpack(m, raw, 0)[:2])
        h, s = (np.concatenate([x[k] for x in packed]) if packed else np.zeros(0, t)
                for k, t in enumerate((np.uint64, np.int64)))
        packed.clear()
        order = np.argsort(h, kind="stable")
        h, s = h[order], s[order]
        new = np.flatnonzero(np.diff(h, prepend=h[:1] ^ np.uint64(1)) != 0) if len(h) else np.zeros(0, int)
        many = np.repeat(np.diff(np.append(new, len(h))) > 1, np.diff(np.append(new, len(h))))
        h, s = h[many], s[many]                               # one set in two tasks still counts twice here
        order = np.lexsort((s, h))
        h, s = h[order], s[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, s = h[fresh], s[fresh]
        new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
        df = np.diff(np.append(new, len(h)))
        df = np.repeat(df, df).astype(np.int32)
        h, s, df = (x[df > 1] for x in (h, s, df))
        frag = (s % frags).astype(np.int32)
        order = np.lexsort((s, frag))
        cuts = np.searchsorted(frag[order], np.arange(frags + 1))
        rows = []
        for f in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[f]:cuts[f + 1]]
            who, runs = np.unique(s[at], return_counts=True)
            head, m = _runs(who, runs)
            rest = h[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            count = df[at].astype("<i4").view(np.uint8).reshape(-1, 4).T        # mostly zeros, byte by byte
            rows.append((1, keys[f], mine, m, None, head + rest.tobytes() + count.tobytes()))
        cols = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["kind", "frag", "doc_id", "n", "sid", "data"])
    return count


SETS = "kind int, doc_id long, n int, sid long, shared array<long>, prefix array<long>, bits array<long>"


def _parities(h, cut, n):
    """For each set ``h[cut[k]:cut[k + 1]]``: bits that say whether an odd number of its n-grams fall
    on them. There are four to eight per n-gram of the set, a power of two of words."""
    import numpy as np
    words = 2 ** np.ceil(np.log2(np.maximum(n / 16, 1))).astype(np.int64)
    at = np.concatenate(([0], np.cumsum(words)))
    out = np.zeros(at[-1], np.uint64)
    runs = np.diff(np.append(cut, len(h)))
    h = _mix(h.view(np.uint64))
    word = (h >> np.uint64(6)).astype(np.int64) & np.repeat(words - 1, runs)
    np.bitwise_xor.at(out, np.repeat(at[:-1], runs) + word, np.uint64(1) << (h & np.uint64(63)))
    return out.view(np.int64), at


def _prefixes(threshold: int, frags: int):
    """One task's sets: order their shared n-grams, keep sets whose prefix holds one."""
    def order_sets(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3)
        names = ["kind", "doc_id", "n", "sid", "shared", "prefix", "bits"]
        h, s, df, ids, sizes = [], [], [], [], []
        for b in batches:
            kind = b.column(0).to_numpy(zero_copy_only=False)
            members = b.filter(pa.array(kind == 0))
            if members.num_rows:
                named = members.filter(members.column(4).is_valid())
                ids.append(named.column(4).to_numpy())
                sizes.append(named.column(3).to_numpy())
                none = pa.nulls(members.num_rows, kinds[4])
                yield pa.RecordBatch.from_arrays([members.column(k) for k in (0, 2, 3, 4)] + [none] * 3, names)
            for k, frag, m, sid, raw in zip(*[b.filter(pa.array(kind > 0)).column(c).to_pylist() for c in (0, 2, 3, 4, 5)]):
                if k == 1:
                    rest, who, count = _unpack(m, raw, 4)
                    h.append(rest * np.uint64(frags) + np.uint64(frag))        # fragments stay apart
                    s.append(who)
                    df.append(np.frombuffer(count, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel())
                else:                                          # heavy n-grams: last in the order
                    h.append(np.unique(np.frombuffer(raw, np.uint64)))
                    s.append(np.full(len(h[-1]), sid, np.int64))
                    df.append(np.full(len(h[-1]), 2 ** 31 - 1, np.int32))
        if not h:
            return
        h, s, df, ids, sizes = (np.concatenate(x) for x in (h, s, df, ids, sizes))
        order = np.lexsort((h, df, s))
        h, s = h[order], s[order]
        fresh = np.ones(len(h), bool)                          # a set's heavy row may come from several tasks
        fresh[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, s = h[fresh].view(np.int64), s[fresh]
        ids, first = np.unique(ids, return_index=True)         # a set's rows come to the task of its members
        n = sizes[first][np.searchsorted(ids, s)]
        cut = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        bits, at = _parities(h, cut, n[cut])
        rows = []
        for k, (lo, hi) in enumerate(zip(cut, np.append(cut[1:], len(s)))):
            size = int(n[lo])
            take = size - -(-threshold * size // 100) + 1 - (size - int(hi - lo))
            if take > 0:
                rows.append((1, None, size, int(s[lo]), h[lo:hi], h[lo:min(hi, lo + take)], bits[at[k]:at[k + 1]]))
        for k in range(0, len(rows), 2000):
            cols = list(zip(*rows[k:k + 2000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)
    return order_sets


def shared_sets(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: int,
                heavy_share: float, min_heavy: int) -> DataFrame:
    """The saved table of membership rows (kind 0) and of sets with a shared prefix (kind 1)."""
    import numpy as np
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = saved(src.mapInArrow(_count_heavy(words, heavy_share), "h long, n long, total boolean"), "heavy")
    entries = int(found.where("total").agg(F.sum("n")).first()[0] or 0)
    floor = max(min_heavy, heavy_share * entries)
    hot = (found.where("not total").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= floor)
           .select("h").collect())                             # at most 1 / heavy_share rows
    heavy = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(entries / 3_000_000))
    keys = _fragment_keys(spark, parts)
    rounds, dealt = Rounds(), None
    for turn in range(TURNS):
        cut = src.mapInArrow(_segment(words, heavy, keys, turn, TURNS), SEGMENTS).repartition(parts, "frag")
        part = rounds.saved(cut.mapInArrow(_count_fragment(keys), SEGMENTS), "dealt%d" % turn)
        dealt = part if dealt is None else dealt.union(part)
    out = saved(dealt.repartition(parts, "frag").mapInArrow(_prefixes(threshold, parts), SETS), "sets")
    rounds.drop()
    return out


def verified(pairs: DataFrame, sets: DataFrame, threshold: int, fragments: int) -> DataFrame:
    """The pairs (a, b) whose Jaccard similarity reaches the threshold: partial overlaps are
    counted per fragment of the n-gram domain and summed per pair."""
    need = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
    sets = sets.join(need, "sid", "left_semi")
    seg = sets.select("sid", "n", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("f"), "shared")
    seg = (seg.select("sid", "n", "f", F.filter("shared", lambda x: F.pmod(x, F.lit(fragments)) == F.col("f"))
                      .alias("seg")).where(F.size("seg") > 0))
    left = seg.select(F.col("sid").alias("a"), F.col("n").alias("na"), "f", F.col("seg").alias("sa"))
    right = seg.select(F.col("sid").alias("b"), F.col("n").alias("nb"), "f", F.col("seg").alias("sb"))
    part = (pairs.join(left, "a").join(right, ["b", "f"])
            .select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("o")))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return total.where(100 * F.col("o") >= threshold * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _differ(a, b) -> F.Column:
    """At least so many n-grams are in one of two sets alone: each parity that differs needs one
    (bits of the larger set are folded to the size of the smaller; 0 where sizes are further apart)."""
    k = F.least(F.size(a), F.size(b))

    def fold(x):
        return F.when(F.size(x) == k, x).otherwise(
            F.zip_with(F.slice(x, 1, k), F.slice(x, k + 1, k), lambda p, q: p.bitwiseXOR(q)))
    odd = F.aggregate(F.zip_with(fold(a), fold(b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)
    return F.when(F.greatest(F.size(a), F.size(b)) <= 2 * k, odd).otherwise(0)


def set_components(sets: DataFrame, threshold: int, fragments: int, rounds: Rounds) -> DataFrame:
    """(sid, comp): the connected component of every set that has a shared prefix."""
    # sizes allow it, and so do the shared n-grams from this one on, which bound the overlap: a
    # similar pair meets in the list of its first common n-gram, and none of its overlap lies before
    left, left2 = F.col("r") - F.col("pos"), F.col("r2") - F.col("pos2")
    close = ((100 * F.least("n", "n2") >= threshold * F.greatest("n", "n2"))
             & ((100 + threshold) * F.least(left, left2) >= threshold * (F.col("n") + F.col("n2"))))
    entry = sets.select("sid", "n", F.size("shared").alias("r"), F.posexplode("prefix").alias("pos", "h"),
                        F.col("sid").alias("comp"))
    crowd = F.col("lo") < F.col("hi")
    e = rounds.saved(entry.join(entry.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                         .where(crowd).select("h"), "h", "left_semi"), "entries")
    label = rounds.saved(e.select("sid", "comp").distinct(), "labels")
    turn, before = 0, None
    while True:
        turn += 1
        # pivots: sets with the least of their own first, another draw in each round
        unlike = F.struct(F.floor(20 * (F.col("n") - F.col("r")) / F.col("n")), F.xxhash64("sid", F.lit(turn)))
        lists = e.groupBy("h").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"),
            F.min_by(F.struct(F.col("sid").alias("sid2"), F.col("n").alias("n2"), F.col("r").alias("r2"),
                              F.col("pos").alias("pos2"), F.col("comp").alias("comp2")), unlike).alias("pivot"))
        star = (e.join(lists.where(crowd), "h").select("sid", "n", "r", "pos", "comp", "pivot.*")
                .where((F.col("comp") != F.col("comp2")) & close))
        star = star.groupBy("sid", "comp").agg(
            F.min_by(F.struct("sid2", "comp2"), F.xxhash64("sid", "sid2", F.lit(turn))).alias("one"))
        links = _links(star.select("sid", "comp", "one.*"), sets, threshold, fragments, rounds)
        e, label, merged = _merge(e, label, links, rounds)
        # members and pairs of different components in the lists left, each distinct list once
        per = e.groupBy("h", "comp").agg(F.count("*").alias("k"), F.sum(F.xxhash64("sid").cast("decimal(38,0)"))
                                         .alias("s1"), F.expr("bit_xor(xxhash64(sid, 7))").alias("s2"))
        per = per.groupBy("h").agg(F.count("*").alias("comps"), F.sum("k").alias("k"), F.sum("s1").alias("s1"),
                                   F.expr("bit_xor(s2)").alias("s2"), F.sum(F.col("k") * F.col("k")).alias("kk"))
        per = rounds.saved(per.where("comps > 1").drop("comps"), "lists")
        once = per.groupBy("k", "s1", "s2", "kk").agg(F.min("h").alias("list"))
        pairs, members = once.agg(F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2), F.sum("k")).first()
        if not members:
            return label
        if pairs <= 4 * members or not merged or (before and pairs > 0.5 * before):
            break                                              # the exact end takes what rounds no longer thin out
        before = pairs
    # lists with the same members are one; a set counts from its earliest n-gram among them
    lists = per.join(once, ["k", "s1", "s2", "kk"]).select("h", "list")
    e = e.join(lists, "h").groupBy("list", "sid", "n", "r", "comp").agg(F.min("pos").alias("pos"))
    e = rounds.saved(e.join(sets.select("sid", "bits"), "sid"), "rest")
    other = e.select("list", *[F.col(c).alias(c + "2") for c in ("sid", "n", "r", "pos", "comp", "bits")])
    alone = F.col("n") - F.col("r") + F.col("n2") - F.col("r2") + _differ(F.col("bits"), F.col("bits2"))
    close &= (100 + threshold) * alone <= (100 - threshold) * (F.col("n") + F.col("n2"))
    cross = e.join(other, "list").where((F.col("sid") < F.col("sid2")) & (F.col("comp") != F.col("comp2")) & close)
    _, label, _ = _merge(None, label, _links(cross, sets, threshold, fragments, rounds), rounds)
    return label


def _links(candidates: DataFrame, sets: DataFrame, threshold: int, fragments: int, rounds: Rounds) -> DataFrame:
    """Links between components, from candidate rows (sid, comp, sid2, comp2)."""
    flip = F.col("sid") < F.col("sid2")
    pairs = candidates.select(
        F.least("sid", "sid2").alias("a"), F.greatest("sid", "sid2").alias("b"),
        F.when(flip, F.col("comp")).otherwise(F.col("comp2")).alias("ca"),
        F.when(flip, F.col("comp2")).otherwise(F.col("comp")).alias("cb")).distinct()
    pairs = rounds.saved(pairs, "pairs")
    ok = verified(pairs.select("a", "b"), sets, threshold, fragments)
    return rounds.saved(pairs.join(ok, ["a", "b"], "left_semi").select(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "links")


def _merge(e, label: DataFrame, links: DataFrame, rounds: Rounds):
    if links.isEmpty():
        return e, label, False
    roots = rounds.saved(components(links), "roots").withColumnRenamed("node", "comp")

    def moved(x, name):
        cols = [F.coalesce("root", "comp").alias("comp") if c == "comp" else F.col(c) for c in x.columns]
        return rounds.saved(x.join(roots, "comp", "left").select(*cols), name)
    return (None if e is None else moved(e, "entries")), moved(label, "labels"), True


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    threshold: int = 75, fragments: int = 4, heavy_share: float = 2e-5,
                    min_heavy: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; ``threshold`` is in percent."""
    table = shared_sets(docs, id_col, text_col, words, threshold, heavy_share, min_heavy)
    sets = table.where("kind = 1").select("sid", "n", "shared", "prefix", "bits")
    rounds = Rounds()
    label = set_components(sets, threshold, fragments, rounds)
    member = table.where("kind = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "sid")
    member = saved(member.join(label, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "sid").alias("comp")), "members")
    rounds.drop()
    least = member.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return member.join(least, "comp", "left").select(
        "doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
        .alias("component_id"))
