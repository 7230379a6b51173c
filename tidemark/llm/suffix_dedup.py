"""Repeated byte strings by suffix order and longest previous factors (operator 3).

A byte goes when it is covered by a ``length``-byte string that also starts earlier
(``keep="first"``) or anywhere else (``keep="none"``), in any document. Strings are judged on the input.

1. Each ``length``-byte window is owned by its smallest hashed 32-byte gram (the anchor); equal
   windows have equal anchors at equal places. The windows of one anchor occurrence are
   a segment. Only (anchor, segment hash, place) rows are shuffled.
2. A segment that occurs more than once is settled by counting, combined map-side: copies
   of documents, however many, end here. Anchors with one occurrence end here too.
3. Where an anchor has several different segments, one of each is fetched and its bytes join a
   block of at most ``block_bytes``. Equal windows hold the anchor at the same place, so only what has an
   equal string there in another segment of the anchor joins. A block's suffixes are ordered by prefix doubling; the
   previous and the next smaller position in that order are the earlier places that share
   most with a position, and the longer of the two matches is its longest previous
   factor. Where that reaches ``length``, the string also starts earlier, and its source later.
4. An anchor with more segments than a block holds is split over blocks by segment hash; what its
   blocks have not settled is compared across them by window hash, so nothing is lost.

Defined cases: null texts are empty (kept as empty bytes, nothing removed); texts shorter than
``length`` are untouched; rows with the same id and text are copies of each other, each with a result;
order is (id, row hash, place), null ids first; texts of any length are read whole, in overlapping
pieces; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import arrow_scan, saved
from tidemark.llm.ngram_join import _mix, _powers

GRAM = 32
STARTS = 1 << 18                       # window starts worked on at a time
PLACE = 20                             # bits of a place within a piece
WORD = 7                               # symbols of nine bits in a first sorting key
CUTS = 4                               # strings around an anchor, one of which equal windows share


def _range_hash(run, up, lo, hi):
    """Hashes of byte ranges [lo, hi) from the running polynomial sums."""
    import numpy as np
    return _mix((run[hi] - run[lo]) * up[lo] + (hi - lo).astype(np.uint64))


def segments(data: bytes, length: int):
    """(anchor, content, a, b, p) arrays: window starts a..b are owned by the gram at p."""
    import numpy as np
    span = length - GRAM + 1
    found = []
    for base in range(0, len(data) - length + 1, STARTS):
        raw = np.frombuffer(data, np.uint8, min(STARTS + length - 1, len(data) - base), base)
        up, down = _powers(1 << 19)
        run = np.concatenate(([np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * down[:len(raw)])))
        g = np.arange(len(raw) - GRAM + 1)
        h = _mix((run[GRAM:] - run[:-GRAM]) * up[:len(g)])
        key = (h >> np.uint64(PLACE) << np.uint64(PLACE)) | g.astype(np.uint64)
        # sliding minimum: suffix minima of one stretch against prefix minima of the next
        n = len(raw) - length + 1
        pad = -len(key) % span
        flat = np.append(key, np.full(pad, np.uint64(2 ** 64 - 1)))
        pre = np.minimum.accumulate(flat.reshape(-1, span), 1).ravel()
        suf = np.minimum.accumulate(flat.reshape(-1, span)[:, ::-1], 1)[:, ::-1].ravel()
        p = (np.minimum(suf[:n], pre[span - 1:span - 1 + n]) & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        a = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        b = np.append(a[1:], n) - 1
        p = p[a]
        content = _mix(_range_hash(run, up, a, b + length) + (p - a).astype(np.uint64) * np.uint64(0x9E3779B1))
        found.append((h[p], content, a + base, b + base, p + base))
    return [np.concatenate(x) for x in zip(*found)] if found else []


def _map_segments(length: int):
    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        names = ["anchor", "content", "uid", "doc_id", "a", "b", "p"]
        for batch in batches:
            uid, ids, texts = (batch.column(k) for k in range(3))
            out, size = [], 0
            for r in range(len(uid)):
                text = texts[r].as_py()
                data = text.encode("utf-8", "replace") if text else b""
                if len(data) >= length:
                    s = segments(data, length)
                    n = len(s[0])
                    out.append((s[0].view(np.int64), s[1].view(np.int64), np.full(n, uid[r].as_py()),
                                np.full(n, ids[r].as_py(), np.int64) if ids[r].is_valid
                                else np.full(n, -2 ** 63, np.int64), s[2], s[3], s[4]))
                    size += n
                if out and (size > 100_000 or r == len(uid) - 1):
                    cols = [np.concatenate(c) for c in zip(*out)]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names)
                    out, size = [], 0
            if out:
                cols = [np.concatenate(c) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names)
    return scan


def suffix_order(data, length: int):
    """(order, levels): positions in the order of their first ``length`` symbols, and for each
    step of the doubling (symbols, rank): equal ranks, equal first symbols. ``data``: integers
    from 1 to 511 (0 parts strings); every position past the end reads as 0. Only positions whose rank is still
    shared are sorted again."""
    import numpy as np
    n = len(data)
    key = np.zeros(n, np.int64)
    for k in range(WORD):
        key <<= 9
        key[:max(0, n - k)] |= data[k:]
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])[:n]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, have = [(WORD, rank)], WORD
    while have < length:
        step = min(have, length - have)
        slot = np.flatnonzero(~(new & np.append(new[1:], True)))
        at = order[slot]
        both = rank[at].astype(np.int64) * (n + 1)
        inside = at + step < n
        both[inside] += rank[at[inside] + step] + 1
        by = np.argsort(both)
        order[slot], both = at[by], both[by]
        fresh = np.append(True, both[1:] != both[:-1])[:len(slot)]
        new[slot] = fresh
        rank = rank.copy()
        rank[order[slot]] = np.maximum.accumulate(np.where(fresh, slot, 0))
        have += step
        levels.append((have, rank))
    return order, levels


def shared_length(data, levels, i, j, length: int):
    """How many symbols, ``length`` at most, the suffixes at ``i`` and ``j`` share (0 where one is -1)."""
    import numpy as np
    n, sound = len(data), (i >= 0) & (j >= 0)
    whole = np.zeros(len(i), bool)
    whole[sound] = levels[-1][1][i[sound]] == levels[-1][1][j[sound]]
    out = np.where(whole, np.minimum(length, n - np.maximum(i, j)), 0)
    rest = np.flatnonzero(sound & ~whole)
    i, j, far = i[rest], j[rest], np.maximum(i[rest], j[rest])
    got, top = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int8)
    look = np.arange(len(rest))
    for k, (step, rank) in enumerate(levels[:-1]):             # up while ranks agree, then down behind that
        look = look[rank[i[look]] == rank[j[look]]]
        got[look], top[look] = step, k + 1
    for k in range(len(levels) - 3, -1, -1):
        step, rank = levels[k]
        look = np.flatnonzero((top > k + 1) & (far + got < n))
        look = look[rank[i[look] + got[look]] == rank[j[look] + got[look]]]
        got[look] += step
    same = np.ones(len(rest), bool)
    for _ in range(WORD - 1):
        same &= far + got < n
        same[same] = data[i[same] + got[same]] == data[j[same] + got[same]]
        got[same] += 1
    out[rest] = np.minimum(np.minimum(got, length), n - far)
    return out


def previous_smaller(values, jumps: int = 12):
    """The nearest index to the left with a smaller value, or -1, for each of distinct ``values``.
    Pointers jump over what is larger; the few that are not there after ``jumps``
    rounds search a pyramid of minima, so no order of the values is a slow one."""
    import numpy as np
    n = len(values)
    prev = np.arange(n) - 1
    todo = np.flatnonzero(values[prev] > values)               # the first one looks at the last: undone below
    todo = todo[todo > 0]
    for _ in range(jumps):
        if not len(todo):
            return prev
        prev[todo] = prev[prev[todo]]
        todo = todo[prev[todo] >= 0]
        todo = todo[values[prev[todo]] > values[todo]]
    low = [values]
    while len(low[-1]) > 1:
        pad = np.append(low[-1], low[-1][-1:]) if len(low[-1]) % 2 else low[-1]
        low.append(pad.reshape(-1, 2).min(1))
    end, want = prev[todo].copy(), values[todo]                # all from end on is known to be larger
    block, level = np.full(len(todo), -1), np.zeros(len(todo), np.int64)
    for k, least in enumerate(low):
        look = np.flatnonzero((block < 0) & (end % 2 == 1))
        hit = least[end[look] - 1] < want[look]
        block[look[hit]], level[look[hit]] = end[look[hit]] - 1, k
        end >>= 1
    for k in range(len(low) - 1, 0, -1):
        down = np.flatnonzero((block >= 0) & (level >= k))
        right = np.minimum(2 * block[down] + 1, len(low[k - 1]) - 1)
        block[down] = np.where(low[k - 1][right] < want[down], right, 2 * block[down])
    prev[todo] = block
    return prev


def previous_factors(data, length: int):
    """(lpf, sources, levels): how long a string, ``length`` at most, starts at each position and
    also earlier; the previous and the next smaller position in suffix order, where such a
    string starts (-1: none)."""
    import numpy as np
    n = len(data)
    order, levels = suffix_order(data, length)
    lpf, sources = np.zeros(n, np.int64), []
    for turn in (slice(None), slice(None, None, -1)):
        along = order[turn]
        prev = previous_smaller(along)
        source = np.full(n, -1)
        source[along] = np.where(prev >= 0, along[prev], -1)
        shared = shared_length(data, levels, np.arange(n), source, length)
        lpf = np.maximum(lpf, shared)
        sources.append(np.where(shared > 0, source, -1))
    return lpf, sources, levels


def repeated_starts(parts: list[bytes], ranks, length: int):
    """For window starts of a block of byte strings: (has an equal window elsewhere, has an
    earlier one, class of equal windows), over the joined strings, and the strings' offsets.
    ``ranks`` order the strings: earlier occurrence first."""
    import numpy as np
    order_in = np.argsort(ranks, kind="stable")
    sizes = np.array([len(parts[k]) for k in order_in])
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    data, left = np.zeros(at[-1], np.int16), np.zeros(at[-1], np.int64)
    for k, o in zip(order_in, at):
        data[o:o + len(parts[k])] = np.frombuffer(parts[k], np.uint8).astype(np.int16) + 1
        left[o:o + len(parts[k])] = np.arange(len(parts[k]), 0, -1)
    lpf, sources, levels = previous_factors(data, length)
    earlier = np.minimum(lpf, left) >= length                  # a factor ends with its string
    other, cls = earlier.copy(), levels[-1][1]
    for source in sources:                                     # and its source has a later copy
        held = source[earlier]
        held = held[held >= 0]
        other[held[cls[held] == cls[np.flatnonzero(earlier)[source[earlier] >= 0]]]] = True
    offset = np.empty(len(parts), np.int64)
    offset[order_in] = at[:-1]
    return other, earlier, cls, offset


FLAGS = "uid long, lo long, hi long, win long, doc_id long"


def with_partners(rows: list[dict], length: int) -> list[dict]:
    """What may hold equal windows among all segments of one anchor, which starts ``at`` in each. A window
    reaches between ``k * step`` and ``(k + 1) * step - 1`` bytes to the left of the anchor for one k, so equal
    windows share the bytes from the least such reach to the least one to the right. Segments
    without a string that another one has are left out, and the others cut to the windows around theirs."""
    span = length - GRAM
    step = span // CUTS + 1

    def strings(r):
        seg, at = r["seg"], r["at"]
        for k in range(CUTS):
            lo, hi = at - k * step, at + GRAM + span - (k + 1) * step + 1
            if lo >= 0 and hi <= len(seg):
                yield k, seg[lo:hi]
    seen = Counter(x for r in rows for x in strings(r))
    out = []
    for r in rows:
        shared = [k for k, x in strings(r) if seen[k, x] > 1]
        if shared:
            lo = max(0, r["at"] - (shared[-1] + 1) * step + 1)
            hi = min(len(r["seg"]), r["at"] - shared[0] * step + length)
            out.append(dict(r, a=r["a"] + lo, at=r["at"] - lo, seg=r["seg"][lo:hi]))
    return out


def _block_scan(length: int, block_bytes: int, keep: str):
    """Blocks of segments (uid, doc_id, a, at, c, salted, bytes) to flagged byte ranges, and to
    one row per window class of a split anchor (win = its hash)."""
    def solve(rows):
        import numpy as np
        import pyarrow as pa
        parts = [r["seg"] for r in rows]
        rank = np.empty(len(rows), np.int64)
        rank[sorted(range(len(rows)), key=lambda k: (rows[k]["doc_id"], rows[k]["uid"], rows[k]["a"]))] = np.arange(len(rows))
        other, earlier, cls, offset = repeated_starts(parts, rank, length)
        mark = other if keep == "none" else earlier
        out: list = []
        told: set = set()
        for r, o in zip(rows, offset):
            n = len(r["seg"]) - length + 1
            hit = mark[o:o + n]
            if keep == "first" or r["c"] == 1:
                edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
                for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                    out.append((r["uid"], int(r["a"] + s), int(r["a"] + e - 1 + length), None, r["doc_id"]))
            if r["salted"]:
                raw = np.frombuffer(r["seg"], np.uint8)
                up, down = _powers(1 << 19)
                run = np.concatenate(([np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1))
                                                                * down[:len(raw)])))
                lo = np.arange(n)
                win = _range_hash(run, up, lo, lo + length).view(np.int64)
                for s in np.flatnonzero(~hit | (keep == "first")):
                    out.append((r["uid"], int(r["a"] + s), int(r["a"] + s + length), int(win[s]), r["doc_id"]))
                for s in np.flatnonzero(hit) if keep == "none" else ():
                    c = int(cls[o + s])
                    if c not in told:                          # a settled class still speaks for other blocks
                        told.add(c)
                        out.append((r["uid"], int(r["a"] + s), int(r["a"] + s + length), int(win[s]), r["doc_id"]))
        cols = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols],
                                          ["uid", "lo", "hi", "win", "doc_id"])

    def scan(batches: Iterator) -> Iterator:
        held, size = [], 0
        rows = (r for b in batches for r in b.to_pylist())
        for _, group in groupby(rows, lambda r: (r["anchor"], r["salt"])):
            # a group is never cut: blocks close between groups, which a salt keeps within bounds
            if size >= block_bytes // 4:
                yield solve(held)
                held, size = [], 0
            group = list(group)
            if not group[0]["salted"]:                         # else partners may be in other blocks
                group = with_partners(group, length)
            held += group
            size += sum(len(r["seg"]) for r in group)
        if held:
            yield solve(held)
    return scan


def _cut_segments(batches: Iterator) -> Iterator:
    """The bytes of the wanted segments of each text."""
    import pyarrow as pa
    names = ["anchor", "salt", "salted", "uid", "doc_id", "a", "at", "c", "seg"]
    for batch in batches:
        out: list = []
        for text, want in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = text.encode("utf-8", "replace")
            for w in want:
                out.append((w["anchor"], w["salt"], w["salted"], w["uid"], w["doc_id"], w["a"], w["at"], w["c"],
                            data[w["a"]:w["hi"]]))
        cols = list(zip(*out)) if out else [[]] * 9
        kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def repeated_ranges(rows: DataFrame, length: int, keep: str, block_bytes: int) -> DataFrame:
    """(uid, lo, hi): byte ranges to remove of ``rows`` (uid, doc_id, text)."""
    occ = saved(rows.mapInArrow(_map_segments(length), "anchor long, content long, uid long, doc_id long, "
                                "a long, b long, p long"), "occurrences")
    order = F.struct("doc_id", "uid", "a")
    contents = occ.groupBy("anchor", "content").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "uid", "a", "b", "p")).alias("first"))
    contents = saved(contents, "contents")
    per_anchor = contents.groupBy("anchor").agg(
        F.count("*").alias("k"), F.sum("c").alias("n"),
        F.sum(F.col("first.b") - F.col("first.a") + length).alias("size")).where("n > 1")
    per_anchor = saved(per_anchor, "anchors")

    many = contents.where("c > 1").select("anchor", "content", "first")
    copies = occ.join(many, ["anchor", "content"])
    if keep == "first":
        copies = copies.where(order > F.struct("first.doc_id", "first.uid", "first.a"))
    ranges = copies.select("uid", F.col("a").alias("lo"), (F.col("b") + length).alias("hi"))

    blocks = F.ceil(F.col("size") / block_bytes)
    want = contents.join(per_anchor.where("k > 1"), "anchor").select(
        "anchor", F.pmod(F.col("content"), blocks).alias("salt"), (blocks > 1).alias("salted"),
        F.col("first.uid").alias("uid"), F.col("first.doc_id").alias("doc_id"), F.col("first.a").alias("a"),
        (F.col("first.p") - F.col("first.a")).alias("at"), "c", (F.col("first.b") + length).alias("hi"))
    by_row = want.groupBy("uid").agg(F.collect_list(F.struct(*want.columns)).alias("want"))
    texts = rows.where(F.octet_length("text") >= length).groupBy("uid").agg(F.first("text").alias("text"))
    cut = texts.join(by_row, "uid").select("text", "want").mapInArrow(
        _cut_segments, "anchor long, salt long, salted boolean, uid long, doc_id long, a long, at long, c long, "
        "seg binary")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    solved = saved(cut.repartition(parts, "anchor", "salt").sortWithinPartitions("anchor", "salt")
                   .mapInArrow(_block_scan(length, block_bytes, keep), FLAGS), "solved")
    ranges = ranges.unionByName(solved.where("win is null").select("uid", "lo", "hi"))
    wins = solved.where("win is not null")
    both = wins.groupBy("win").agg(F.count("*").alias("k"), F.min(F.struct("doc_id", "uid", "lo")).alias("first"))
    cross = wins.join(both.where("k > 1"), "win")
    if keep == "first":
        cross = cross.where(F.struct("doc_id", "uid", "lo") > F.col("first"))
    return ranges.unionByName(cross.select("uid", "lo", "hi"))


RESULT = T.StructType([T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                       T.StructField("kept", T.BinaryType())])


def remove_repeats(docs: DataFrame, length: int = 400, keep: str = "first", id_col: str = "doc_id",
                   text_col: str = "text", block_bytes: int = 4_000_000) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the size of every row's text in UTF-8, the maximal removed
    byte spans [lo, hi), and what is left (bytes: a cut may fall inside a character)."""
    if keep not in ("first", "none") or not 2 * GRAM <= length <= STARTS:
        raise ValueError("keep must be 'first' or 'none', length %d to %d" % (2 * GRAM, STARTS))
    rows = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("uid"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = repeated_ranges(rows, length, keep, block_bytes)
    # a row has as many ranges as anchors at most
    by_row = found.distinct().groupBy("uid").agg(F.collect_list(F.array("lo", "hi")).alias("ranges"))
    out = rows.join(by_row, "uid", "left").select(
        "doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("data"), "ranges")
    cut = arrow_scan(_cut_out, RESULT, 2)("data", "ranges")
    return out.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"), cut.alias("r")).select(
        "doc_id", "n_bytes", "r.spans", "r.kept")


def _cut_out(batches: Iterator) -> Iterator:
    """Merge each row's ranges to maximal spans and take them out of its bytes."""
    import pyarrow as pa
    kind = pa.struct([("spans", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])
    for data, ranges in batches:
        out = []
        for d, r in zip(data, ranges.to_pylist()):
            spans: list = []
            for lo, hi in sorted(r or ()):
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = max(hi, spans[-1][1])
                else:
                    spans.append([lo, hi])
            raw, at, kept = d.as_py(), 0, []
            for lo, hi in spans:
                kept.append(raw[at:lo])
                at = hi
            out.append({"spans": spans, "kept": b"".join(kept) + raw[at:]})
        yield pa.array(out, kind)
