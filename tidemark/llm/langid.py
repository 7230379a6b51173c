"""Language identification by error-correcting output codes (operator 6).

Each language gets a codeword; one binary classifier per code bit is fitted on hashed
byte n-grams (logistic loss, L2). A text is decoded to the language whose codeword has the
smallest total loss over the bits (loss-weighted decoding); a small lead over
the runner-up flags the decision as ambiguous.

Learning uses a bounded, hash-drawn sample of at most ``per_language`` labelled rows of
each language; prediction reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; labels that
are null are not learned; one learned language is always predicted, none gives ``und``;
texts of any length are read whole, in pieces; repeated rows are predicted row by row; extra
columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import arrow_scan

BUCKETS = 1 << 12
PIECE = 1 << 20                                   # bytes featurised at a time


def codewords(k: int, seed: int = 7):
    """A k x bits matrix of -1/+1. Up to 6 languages: the exhaustive code; beyond: random
    codes of about 10 log2(k) bits, the draw with the largest smallest distance."""
    import numpy as np
    if k <= 6:
        cols = [[1] + [1 if m >> r & 1 else -1 for r in range(k - 1)] for m in range(2 ** (k - 1) - 1)]
        return np.array(cols, float).T if k > 1 else np.ones((k, 1))
    rng, best, gap = np.random.default_rng(seed), None, -1
    for _ in range(200):
        c = rng.choice([-1.0, 1.0], (k, math.ceil(10 * math.log2(k))))
        far = ((c.shape[1] - c @ c.T) / 2 + np.eye(k) * c.shape[1]).min()
        if far > gap and (abs(c.sum(0)) < k).all():
            best, gap = c, far
    return best


def _grams(texts: list, buckets: int):
    """Hellinger-scaled n-gram shares [text, bucket]: byte 1- to 3-grams of lower-cased
    words, blanks between words; every byte of the text counts."""
    import numpy as np
    out = np.zeros((len(texts), buckets), np.float32)
    plain = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
    row = 0
    while row < len(texts):
        chunk, size, first = [], 0, row
        while row < len(texts) and (not chunk or (size + len(texts[row]) <= PIECE // 2 and len(chunk) < 256)):
            data = b" " + texts[row].lower().encode("utf-8", "replace").translate(plain) + b" "
            chunk.append(data)
            size += len(data)
            row += 1
        for lo in range(0, size, PIECE):                       # one piece, unless a text is longer
            joined = b"".join(chunk) if lo == 0 else joined
            a = np.frombuffer(joined, np.uint8)[lo:lo + PIECE + 2].astype(np.uint32)
            who = np.repeat(np.arange(len(chunk)), [len(c) for c in chunk])[lo:lo + PIECE + 2]
            n = min(len(a), PIECE)
            counts = np.zeros((len(chunk), buckets), np.float32)
            keep = a[:n] != 32
            for g in (1, 2, 3):
                code = a[:n].copy()
                ok = np.ones(n, bool)
                for d in range(1, g):
                    nxt = np.zeros(n, np.uint32)
                    m = min(n, len(a) - d)
                    nxt[:m] = a[d:d + m]
                    code = code * np.uint32(257) + nxt
                    same = np.zeros(n, bool)
                    same[:m] = who[d:d + m] == who[:m]
                    ok &= same
                if g == 1:
                    ok &= keep
                h = (code[ok] * np.uint32(2654435761) + np.uint32(g * 40503)) >> np.uint32(20)
                flat = who[:n][ok].astype(np.int64) * buckets + (h & np.uint32(buckets - 1))
                counts += np.bincount(flat, minlength=len(chunk) * buckets).reshape(len(chunk), buckets)
            out[first:first + len(chunk)] += counts
    np.sqrt(out, out=out)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-6)


class EcocModel:
    def __init__(self, langs, codes, weights, bias, margin):
        self.langs, self.codes, self.weights, self.bias, self.margin = langs, codes, weights, bias, margin

    def decode(self, x):
        """(language index, score, lead) of feature rows."""
        import numpy as np
        f = x @ self.weights + self.bias
        loss = np.logaddexp(0, -f[:, None, :] * self.codes[None, :, :]).mean(2)
        order = np.sort(loss, 1)
        lead = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(f), 9.0)
        p = np.exp(-(loss - order[:, :1]) * 8)
        return loss.argmin(1), 1 / p.sum(1), lead


def fit_bits(x, y, steps: int = 300, l2: float = 1e-5, rate: float = 20.0):
    """Logistic regressions of all code bits at once (accelerated gradient)."""
    import numpy as np
    w = np.zeros((x.shape[1], y.shape[1]), np.float32)
    b = np.zeros(y.shape[1], np.float32)
    vw, vb = w.copy(), b.copy()
    for s in range(steps):
        m = s / (s + 3)
        pw, pb = w + m * vw, b + m * vb
        p = -y / (1 + np.exp(np.clip(y * (x @ pw + pb), -30, 30)))
        nw = pw - rate * (x.T @ p / len(x) + l2 * pw)
        nb = pb - rate * p.mean(0) * 0.1
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = 400, max_languages: int = 200, margin: float = 0.05) -> EcocModel | None:
    """Fit on at most ``per_language`` rows of each of the (at most ``max_languages``, most
    frequent) languages, drawn by a hash of the id; only their n-gram shares reach the driver."""
    import numpy as np
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(max_languages).collect()
    if not counts:
        return None
    draw = (F.pmod(F.xxhash64(F.col(id_col), F.lit("draw")), F.lit(1_000_000)) / 1e6)
    pick = F.lit(False)
    for r in counts:
        pick = pick | ((F.col(lang_col) == r[0]) & (draw < min(1.0, 1.2 * per_language / r[1])))

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for col in batches:
            x = _grams(col.to_pylist(), BUCKETS)
            yield pa.array([v.astype("<f2").tobytes() for v in x], pa.binary())
    got = (rows.where(pick).select(F.col(lang_col).alias("l"), arrow_scan(scan, T.BinaryType())(F.col(text_col))
                                   .alias("x")).limit(2 * per_language * len(counts)).collect())
    seen: dict = {}
    kept = []
    for r in sorted(got, key=lambda r: (r["l"], bytes(r["x"]))):
        seen[r["l"]] = seen.get(r["l"], 0) + 1
        if seen[r["l"]] <= 2 * per_language:
            kept.append(r)
    langs = sorted(seen)
    if not langs:
        return None
    codes = codewords(len(langs))
    x = np.stack([np.frombuffer(bytes(r["x"]), "<f2") for r in kept]).astype(np.float32)
    y = codes[[langs.index(r["l"]) for r in kept]].astype(np.float32)
    w, b = fit_bits(x, y)
    return EcocModel(langs, codes, w, b, margin)


RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("ambiguous", T.BooleanType())])


def predict(docs: DataFrame, model: EcocModel | None, text_col: str = "text", into: str = "lid") -> DataFrame:
    """``docs`` with a struct column ``into``: lang, score (0 to 1), ambiguous. One pass."""
    held = docs.sparkSession.sparkContext.broadcast(model)       # buckets x bits floats

    def scan(batches: Iterator) -> Iterator:
        import re

        import numpy as np
        import pyarrow as pa
        letter = re.compile(r"[^\W\d_]")
        model = held.value
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])
        for col in batches:
            lang = np.full(len(col), "und", object)
            score, unsure = np.zeros(len(col)), np.zeros(len(col), bool)
            for lo in range(0, len(col), 256):
                texts = col[lo:lo + 256].to_pylist()
                real = [k for k, t in enumerate(texts) if t and letter.search(t)]
                if model is None or not real:
                    continue
                best, p, lead = model.decode(_grams([texts[k] for k in real], BUCKETS))
                at = lo + np.array(real)
                lang[at] = [model.langs[i] for i in best]
                score[at], unsure[at] = p, lead < model.margin
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)],
                                             fields=list(kind))
    return docs.withColumn(into, arrow_scan(scan, RESULT)(F.col(text_col)))
