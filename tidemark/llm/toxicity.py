"""Toxicity by a subsequence string-kernel support vector machine (operator 4).

Words are compared by the gap-weighted subsequence kernel of order 3: two words share a
feature for every three symbols that occur in order in both, within ``SPAN`` symbols,
weighted by LAMBDA ** span in each word, word edges being symbols too. Gaps are what lets
an inserted or dropped character leave most of the similarity in place. Before that,
punctuation inside a word is dropped, look-alike digits become letters, and runs of
single letters are joined ("i d i o t").

Training sees labelled sentences (each carries its document's label) of a bounded sample:
distinct uses (a word between its neighbours) give each word's contrast, a greedy cover of
the toxic documents picks the witness words, and a squared-hinge SVM is fitted on Nystroem features of landmark words
(witnesses, their one-insertion variants, clean words), with the hardest clean words of the
sample added before a second fit. The kernel is linear in an explicit feature space of
28**3 weights, so the fitted machine is folded into one table and every word of every
whole text is scored by table look-ups. A document scores as its worst word.

Defined cases: null, empty and letterless texts score as no word does (the score's lower
end); without both classes in the sample every text gets that score; labels that are null
are ignored, repeated labels count as toxic if any is; texts of any length are read whole in
pieces; extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import arrow_scan, saved

SPAN, LAMBDA, SYMBOLS = 5, 0.6, 28
STEPS = [(d1, d2) for d2 in range(2, SPAN + 1) for d1 in range(1, d2)]
PIECE = 1 << 19
#: Look-alike characters and the letters they stand for. Fixed values.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_CODE = bytes(c - 96 if 97 <= c <= 122 else 27 if c >= 128 else
              ord(LOOKALIKE[chr(c)]) - 96 if chr(c) in LOOKALIKE else 0 for c in range(256))
_DROP = bytes(c for c in range(128) if not (chr(c).isalpha() or chr(c) in LOOKALIKE or c in b" \t\n\v\f\r"))


def symbols(data: bytes):
    """Symbol codes with single letters in a row joined; 0 separates words. ``data`` is
    lower-cased UTF-8; the result starts and ends with a separator."""
    import numpy as np
    a = np.frombuffer(b" " + data.translate(None, _DROP) + b" ", np.uint8)
    a = np.frombuffer(bytes(_CODE), np.uint8)[a]
    word = a > 0
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    one = end - start == 1
    if len(one) > 1:
        glue = one[:-1] & one[1:] & (start[1:] - end[:-1] == 1)
        if glue.any():
            keep = np.ones(len(a), bool)
            keep[end[:-1][glue]] = False
            a = a[keep]
    return a


def word_margins(a, table):
    """(starts, ends, margins) of the words of a symbol array."""
    import numpy as np
    word = a > 0
    start = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    end = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    if not len(start):
        return start, end, np.zeros(0)
    n = len(a)
    sep = np.flatnonzero(a == 0)
    nxt = sep[np.minimum(np.searchsorted(sep, np.arange(n), "right"), len(sep) - 1)] - np.arange(n)
    c = a.astype(np.int32)
    val = np.zeros(n, np.float32)
    for d1, d2 in STEPS:
        m = n - d2
        if m <= 0:
            continue
        w = table[(c[:m] * SYMBOLS + c[d1:d1 + m]) * SYMBOLS + c[d2:]]
        val[:m] += np.where(nxt[:m] >= d2, w, 0) * np.float32(LAMBDA ** d2)
    run = np.concatenate(([0], np.cumsum(val, dtype=np.float64)))
    return start, end, (run[end] - run[start - 1]) / scale(end - start)


def scale(length):
    """The kernel's conformal factor: depends on a word's length alone, so the scaled
    kernel stays positive semi-definite."""
    import numpy as np
    length = np.asarray(length)
    s = sum((d2 - 1) * np.maximum(0, length + 2 - d2) * LAMBDA ** (2 * d2) for d2 in range(2, SPAN + 1))
    return np.sqrt(np.maximum(s, 1e-9))


def spelled(words: list[str]):
    """The symbol array of normalised words ("~" stands for a byte beyond ASCII)."""
    import numpy as np
    code = np.frombuffer(bytes(27 if c == 126 else c - 96 if 97 <= c <= 122 else 0 for c in range(256)), np.uint8)
    return code[np.frombuffer((" %s " % " ".join(words)).encode(), np.uint8)]


def features(words: list[str]):
    """Explicit kernel features [word, 28**3], for a bounded list of normalised words."""
    import numpy as np
    out = np.zeros((len(words), SYMBOLS ** 3), np.float32)
    a = spelled(words).astype(np.int64)
    sep = a == 0
    who = np.cumsum(sep) - 1                     # a separator opens the word that follows it
    last = np.flatnonzero(sep)
    nxt = last[np.minimum(who + 1, len(last) - 1)] - np.arange(len(a))
    for d1, d2 in STEPS:
        i = np.flatnonzero(nxt[:-d2] >= d2)
        np.add.at(out, (who[i], (a[i] * SYMBOLS + a[i + d1]) * SYMBOLS + a[i + d2]), np.float32(LAMBDA ** d2))
    return out / scale([len(w) for w in words])[:, None].astype(np.float32)


def fit_svm(x, y, weight, steps: int = 400, l2: float = 2e-3):
    """Squared-hinge linear SVM by accelerated gradient; weights sum to one."""
    import numpy as np
    weight = weight / weight.sum()
    rate = 1 / (2 * (x * x).sum(1).max() + l2 + 2)
    w, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    x1 = np.concatenate([x, np.ones((len(x), 1))], 1)
    for s in range(steps):
        p = w + s / (s + 3) * v
        slack = np.maximum(0, 1 - y * (x1 @ p))
        g = -2 * x1.T @ (weight * y * slack)
        g[:-1] += l2 * p[:-1]
        new = p - rate * g
        w, v = new, new - w
    return w[:-1], w[-1]


class Model:
    """table: folded weights; low / high: margins of the hardest clean and the weakest
    witness word of the sample, which place the score's cut."""

    def __init__(self, table, low: float, high: float, witnesses: list[str]):
        self.table, self.low, self.high, self.witnesses = table, low, high, witnesses

    def score(self, margin):
        import numpy as np
        at = (margin - self.low) / (self.high - self.low)
        z = np.log(0.7 / 0.3) + 8 * (at - 0.5)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _nystroem_svm(pos: list[str], weak: list[str], neg: list[str], landmarks: int = 480):
    """Squared-hinge SVM on Nystroem features of at most ``landmarks`` landmark words."""
    import numpy as np
    third = landmarks // 3
    marks = list(dict.fromkeys(pos[:third] + weak[::max(1, len(weak) // third)][:third] + neg[:third]))
    z = features(marks)
    val, vec = np.linalg.eigh(z @ z.T)
    ok = val > 1e-6 * val.max()
    root = vec[:, ok] / np.sqrt(val[ok])
    words = pos + weak + neg
    x = np.concatenate([features(words[k:k + 256]) @ z.T for k in range(0, len(words), 256)]) @ root
    y = np.array([1.0] * (len(pos) + len(weak)) + [-1.0] * len(neg))
    weight = np.array([2.0 / len(pos)] * len(pos) + [0.5 / max(1, len(weak))] * len(weak) + [2.0 / max(1, len(neg))] * len(neg))
    w, b = fit_svm(x, y, weight)
    return (z.T @ (root @ w)).astype(np.float32), b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_docs: int = 3000) -> Model | None:
    """Fit on at most ``max_docs`` labelled documents of each class, drawn by a hash of the
    id (the drawn ids are broadcast: their number is the bound)."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y"))
    size = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(size) < 2:
        return None
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1_000_000)) / 1e6
    take = F.lit(False)
    for y, n in size.items():
        take = take | ((F.col("y") == y) & (draw < min(1.0, max_docs / n)))
    drawn = known.where(take).limit(3 * max_docs).groupBy("id").agg(F.max("y").alias("y"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(drawn), "id")
    # labelled sentences, distinct: copies of a document count their sentences once
    lines = saved(rows.where(F.col("t").isNotNull()).select(
        "id", "y", F.explode(F.split("t", "(?<=[.!?\\n])\\s+")).alias("s")), "sentences")
    once = lines.groupBy(F.xxhash64("s").alias("h"), "s").agg(F.max("y").alias("y"))
    uses = arrow_scan(_uses_scan, T.ArrayType(T.StringType()))
    once = saved(once.select("y", F.explode(uses("s")).alias("u")), "uses")
    # distinct uses (word between its neighbours): a copied sentence counts once
    table = saved(once.groupBy("u").agg(F.max("y").alias("y"))
                  .groupBy(F.substring_index("u", " ", 1).alias("word"))
                  .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
                  .where(F.length("word").between(3, 24)), "words")
    tot = table.agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count("*").alias("v")).first()
    if not tot["p"] or not tot["n"]:
        return None
    # log-likelihood ratio of a word's uses against the classes' sizes, beyond what chance
    # yields among so many words
    p, n = F.col("p"), F.col("n")
    share = tot["p"] / (tot["p"] + tot["n"])
    ratio = 2 * (F.when(p > 0, p * F.log(p / ((p + n) * share))).otherwise(0)
                 + F.when(n > 0, n * F.log(n / ((p + n) * (1 - share)))).otherwise(0))
    floor = 2 * math.log(tot["v"]) + 8
    best = (table.where((p > 0.8 * (p + n)) & (ratio > floor))
            .orderBy(F.desc("p"), "word").limit(300).collect())
    cand = {r["word"]: r["p"] for r in best}
    if not cand:
        return None
    # greedy cover: which candidate explains which toxic document
    words = arrow_scan(_words_scan, T.ArrayType(T.StringType()))
    has = F.array_intersect(words("s"), F.array(*[F.lit(w) for w in cand]))
    rows = (lines.where("y = 1").select("id", F.explode(has).alias("w")).distinct()
            .groupBy("id").agg(F.collect_set("w").alias("ws")).collect())
    most, left, pos = max(cand.values()), [set(r["ws"]) for r in rows], []
    for w in sorted(cand, key=lambda w: (-cand[w], w)):
        gain = sum(w in ws for ws in left)
        if gain >= 2 or 4 * cand[w] >= most:
            pos.append(w)
            left = [ws for ws in left if w not in ws]
    if not pos:
        return None
    clean = table.where("p = 0")
    common = [r[0] for r in clean.orderBy(F.desc("n"), "word").limit(300).collect()]
    random_ = [r[0] for r in clean.orderBy(F.xxhash64("word")).limit(700).collect()]
    neg = list(dict.fromkeys(common + random_))
    weak = [w[:k] + "x" + w[k:] for w in pos for k in range(1, len(w))]
    import numpy as np
    table_w, _ = _nystroem_svm(pos, weak, neg)
    hard = _hardest(clean, table_w, 400)
    pos = _apart(pos, [h for h, _ in hard] + neg)
    if not pos:
        return None
    weak = [w[:k] + "x" + w[k:] for w in pos for k in range(1, len(w))]
    weights, _ = _nystroem_svm(pos, weak, list(dict.fromkeys([h for h, _ in hard] + neg)))
    hard = _hardest(clean, weights, 1)
    low = hard[0][1] if hard else 0.0
    high = float(np.sort(word_margins(spelled(pos), weights)[2])[len(pos) // 50])
    if high <= low:                              # not separable: the witnesses decide
        low = high - 1.0
    return Model(weights, low, high, pos)


def _apart(pos: list[str], clean: list[str], most: float = 0.75) -> list[str]:
    """The witnesses that no clean word resembles: a cosine of ``most`` in the kernel's space
    or more means that ordinary words share the form, and the label lies elsewhere."""
    import numpy as np
    def unit(words):
        x = features(words)
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    p = unit(pos)
    near = np.max([(p @ unit(clean[k:k + 256]).T).max(1) for k in range(0, len(clean), 256)], 0)
    return [w for w, c in zip(pos, near) if c < most]


def _uses_scan(batches: Iterator) -> Iterator:
    """Every use of a word in each text, as "word before after" (normalised)."""
    import numpy as np
    import pyarrow as pa
    spell = np.frombuffer(b" abcdefghijklmnopqrstuvwxyz~", np.uint8)
    for col in batches:
        out = []
        for v in col:
            text = v.as_py() or ""
            w = ["", *spell[symbols(text.lower().encode("utf-8", "replace"))].tobytes().decode().split(), ""]
            out.append(["%s %s %s" % x for x in zip(w[1:-1], w, w[2:])])
        yield pa.array(out, pa.list_(pa.string()))


def _words_scan(batches: Iterator) -> Iterator:
    """The distinct normalised words of each text."""
    import numpy as np
    import pyarrow as pa
    spell = np.frombuffer(b" abcdefghijklmnopqrstuvwxyz~", np.uint8)
    for col in batches:
        out = []
        for v in col:
            text = v.as_py()
            a = symbols(text.lower().encode("utf-8", "replace")) if text else np.zeros(0, np.uint8)
            out.append(sorted({w.decode() for w in spell[a].tobytes().split()}))
        yield pa.array(out, pa.list_(pa.string()))


def _hardest(words: DataFrame, table, k: int) -> list:
    held = words.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for col in batches:
            yield pa.array(word_margins(spelled(col.to_pylist()), held.value)[2], pa.float64())
    got = words.select("word", arrow_scan(scan, T.DoubleType())("word").alias("m"))
    return [(r["word"], r["m"]) for r in got.orderBy(F.desc("m"), "word").limit(k).collect()]


RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("word", T.StringType())])


def score_texts(docs: DataFrame, model: Model | None, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``into``: score (0 to 1) and the worst word (normalised
    spelling, or NULL). One pass, no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)      # 28**3 floats

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        spell = np.frombuffer(b" abcdefghijklmnopqrstuvwxyz~", np.uint8)
        model = held.value
        kind = pa.struct([("score", pa.float64()), ("word", pa.string())])
        for col in batches:
            best = np.full(len(col), -np.inf)
            words: list = [None] * len(col)
            r = 0
            while r < len(col) and model is not None:
                chunk, size, first = [], 0, r
                while r < len(col) and (not chunk or size < PIECE):
                    text = col[r].as_py()
                    chunk.append(text.lower().encode("utf-8", "replace") if text else b"")
                    size += len(chunk[-1]) + 2
                    r += 1
                for k0, data in _pieces(chunk):
                    arrays = [symbols(d) for d in data]
                    a = np.concatenate(arrays)
                    edge = np.cumsum([len(x) for x in arrays])
                    start, end, m = word_margins(a, model.table)
                    if not len(m):
                        continue
                    doc = np.searchsorted(edge, start, "right")
                    cut = np.flatnonzero(np.diff(doc, prepend=-1))
                    top = np.maximum.reduceat(m, cut)
                    for d, v, lo, hi in zip(doc[cut], top, cut, [*cut[1:], len(m)]):
                        at = first + k0 + int(d)
                        if v > best[at]:
                            best[at] = v
                            j = lo + int(m[lo:hi].argmax())
                            words[at] = spell[a[start[j]:end[j]]].tobytes().decode()
            score = model.score(best) if model is not None else np.zeros(len(col))
            yield pa.StructArray.from_arrays([pa.array(score), pa.array(words, pa.string())], fields=list(kind))
    return docs.withColumn(into, arrow_scan(scan, RESULT)(F.col(text_col)))


def _pieces(chunk: list[bytes]):
    """(first row, byte strings) groups of bounded size; a text beyond it is read in parts cut
    at blanks (a single word beyond it stays whole)."""
    if sum(map(len, chunk)) <= 2 * PIECE:
        yield 0, chunk
        return
    for k, data in enumerate(chunk):
        at = 0
        while at < len(data) or at == 0:
            end = len(data) if len(data) - at <= PIECE else data.rfind(b" ", at + 1, at + PIECE)
            if end <= at:
                end = data.find(b" ", at + PIECE)
                end = len(data) if end < 0 else end
            yield k, [data[at:end]]
            at = end
            if at >= len(data):
                break
