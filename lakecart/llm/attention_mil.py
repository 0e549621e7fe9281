"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (fixed-length runs of bytes; the whole text is
covered).  Every passage becomes a feature vector: byte-class shares, hashed
byte trigrams, word shape, and shares of words that repeat.  A learned layer
encodes it (``h = tanh(W x + b)``), gated attention weighs it
(``e = w . (tanh(V h) * sigmoid(U h))``, weights = softmax of ``e`` over the
document) and the weighted mean of the encodings is scored by a logistic unit.
All parameters are learned in numpy from document labels only, on a bounded,
class-balanced sample; the score is shifted back to the labelled share of the
classes.

``e`` is bounded by the norm of ``w``, so the softmax needs no maximum and a
document of any length is scored by running sums over its sections: a section
is 64 passages, and the features that look beyond a passage (repeated word
5-grams) look at its section.  Memory is bounded by a section, not a text.

Defined results: null or empty text gets the labelled share of class 1; very
long texts are scored whole; an empty table gives an empty result, equal texts
equal scores; with no labels, or only one class, the score is the
labelled share of class 1 (0.5 without labels); repeated rows score alike;
extra columns pass through (``score`` and ``predicted`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecart.llm.common import utf8_buffers

PASSAGE = 1024  # bytes
SECTION = 64 * PASSAGE
ENCODED, GATE = 24, 12
TRIGRAM_BINS = 64
#: Bounds of the training sample: documents per class, and passages per document.
MAX_DOCS_PER_CLASS = 1200
MAX_PASSAGES = 16
#: Beginnings of 4 to 630 characters that are learned from beside each whole text.
BEGINNINGS = 2
THRESHOLD = 0.3
# Shares count as if the passage had so many more bytes, so that a few bytes prove little.
SHRINK = 40
# Bytes worked on at a time on an executor.
CHUNK = 8 * SECTION

# Byte classes: lower, upper, digit, blank, newline, each ASCII punctuation mark, other control, non-ASCII.
_CLS = np.full(256, 5, np.int64)
_CLS[97:123], _CLS[65:91], _CLS[48:58], _CLS[[32, 9]], _CLS[[10, 13]], _CLS[128:] = 0, 1, 2, 3, 4, 6
_PUNCT = [i for i in range(33, 127) if not chr(i).isalnum()]
_CLS[_PUNCT] = 7 + np.arange(len(_PUNCT))
N_CLS = 7 + len(_PUNCT)
N_FEATURES = N_CLS + TRIGRAM_BINS + 6
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POS = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_NGRAM = _rng.integers(1, 2**63, 6, dtype=np.uint64) | np.uint64(1)


def _repeats(key: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    out = np.empty(len(key), bool)
    out[order] = same[:-1] | same[1:]
    return out


def passage_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of sections ``raw[starts[i]:ends[i]]`` (adjacent runs), and each passage's section."""
    length = ends - starts
    n_pass = np.maximum(1, -(-length // PASSAGE))
    base = np.concatenate([[0], np.cumsum(n_pass)])
    sec_of_pass = np.repeat(np.arange(len(starts)), n_pass)
    n = int(base[-1])
    x = np.zeros((n, N_FEATURES), np.float32)
    if not len(raw):
        return x, sec_of_pass
    sec = np.repeat(np.arange(len(starts)), length)
    pid = base[sec] + (np.arange(len(raw)) - starts[sec]) // PASSAGE
    size = (np.bincount(pid, minlength=n) + SHRINK)[:, None]
    x[:, :N_CLS] = np.sqrt(np.bincount(pid * N_CLS + _CLS[raw], minlength=n * N_CLS).reshape(n, -1) / size)
    b = raw.astype(np.int64) | 32  # folds ASCII case
    tri = ((b[:-2] * 7919 + b[1:-1] * 104729 + b[2:] * 1299709) >> 7) % TRIGRAM_BINS
    at = (pid[:-2] * TRIGRAM_BINS + tri)[sec[:-2] == sec[2:]]  # none runs over the end of its section
    x[:, N_CLS:N_CLS + TRIGRAM_BINS] = np.sqrt(
        np.bincount(at, minlength=n * TRIGRAM_BINS).reshape(n, -1) / size)
    space = _SPACE[raw]
    first = np.zeros(len(raw), bool)
    first[starts[length > 0]] = True
    ws = np.flatnonzero(~space & (first | np.concatenate([[True], space[:-1]])))
    if not len(ws):
        return x, sec_of_pass
    inside = np.cumsum(~space)
    n_chars = np.diff(np.append(inside[ws] - 1, inside[-1]))
    at = np.arange(len(raw)) - np.repeat(np.append(0, ws), np.diff(np.concatenate([[0], ws, [len(raw)]])))
    val = np.where(space, np.uint64(0), _BYTE[b] * _POS[np.minimum(at, 63)])
    h = np.add.reduceat(val, ws)
    h ^= h >> np.uint64(29)
    wp, wsec = pid[ws], sec[ws]
    n_words = np.bincount(wp, minlength=n)
    words = n_words + SHRINK / 8

    def share(flag, of):
        return np.bincount(of, weights=flag, minlength=n) / words

    f = x[:, N_CLS + TRIGRAM_BINS:]
    f[:, 0] = np.minimum(share(n_chars, wp) / 10, 5)
    f[:, 1] = np.log1p(n_words) / 6
    f[:, 2] = share(_repeats(h ^ (wp.astype(np.uint64) * _NGRAM[5])), wp)
    if len(ws) > 1:
        f[:, 3] = share((h[1:] == h[:-1]) & (wsec[1:] == wsec[:-1]), wp[1:])
    if len(ws) > 4:
        m = len(ws) - 4
        g = wsec[:m].astype(np.uint64) * _NGRAM[5]
        for j in range(5):
            g = g ^ ((h[j:j + m] + _NGRAM[j]) * _NGRAM[j])
        whole = wsec[:m] == wsec[4:]
        f[:, 4] = share(_repeats(g) & whole, wp[:m])
    f[:, 5] = share((raw[ws] >= 65) & (raw[ws] <= 90), wp)
    return x, sec_of_pass


def _sections(raw: np.ndarray, offsets: np.ndarray):
    """(bytes, starts, ends, text of each section) in runs of at most about CHUNK bytes."""
    length = np.diff(offsets)
    n_sec = np.maximum(1, -(-length // SECTION))
    doc = np.repeat(np.arange(len(length)), n_sec)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n_sec) - n_sec, n_sec)
    start = offsets[doc] + k * SECTION
    end = np.minimum(start + SECTION, offsets[doc + 1])
    cut = 0
    while cut < len(doc):
        stop = max(cut + 1, int(np.searchsorted(end, start[cut] + CHUNK, side="right")))
        stop = min(stop, cut + 4096)  # many empty texts
        lo, hi = start[cut], end[stop - 1]
        yield raw[lo:hi], start[cut:stop] - lo, end[cut:stop] - lo, doc[cut:stop]
        cut = stop


@dataclass
class MilModel:
    encode: np.ndarray
    encode_b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    out: np.ndarray
    out_b: float
    prior_shift: float


def _attend(m: MilModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(x @ m.encode + m.encode_b)
    return h, (np.tanh(h @ m.v) / (1 + np.exp(-(h @ m.u)))) @ m.w


def score_bytes(m: MilModel, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of each text from running sums of attention weight and weighted encoding."""
    n = len(offsets) - 1
    num, den = np.zeros((n, ENCODED)), np.zeros(n)
    for part, starts, ends, doc in _sections(raw, offsets):
        x, sec = passage_features(part, starts, ends)
        h, e = _attend(m, x)
        a = np.exp(e)
        np.add.at(num, doc[sec], h * a[:, None])
        np.add.at(den, doc[sec], a)
    z = num / den[:, None]
    score = 1 / (1 + np.exp(-(z @ m.out + m.out_b + m.prior_shift)))
    return np.where(np.diff(offsets) == 0, 1 / (1 + np.exp(-m.prior_shift)), score)  # nothing but the labelled share to go by


def train(bags: list[tuple[np.ndarray, int]], share_of_1: float, steps: int = 400, batch: int = 64,
          seed: int = 11) -> MilModel:
    """Adam on the logistic loss of bag labels; batches hold both classes alike."""
    rng = np.random.default_rng(seed)
    by = [[x for x, y in bags if y == c] for c in (0, 1)]
    shift = float(np.log(share_of_1 / (1 - share_of_1)))
    p = [rng.normal(0, 1 / np.sqrt(20), (N_FEATURES, ENCODED)), np.zeros(ENCODED),
         rng.normal(0, 0.3, (ENCODED, GATE)), rng.normal(0, 0.3, (ENCODED, GATE)), rng.normal(0, 0.3, GATE),
         rng.normal(0, 0.3, ENCODED), np.zeros(1)]
    m1, m2 = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p]
    for step in range(1, steps + 1):
        y = rng.integers(0, 2, batch)
        picked = [by[c][rng.integers(len(by[c]))] for c in y]
        x = np.concatenate(picked)
        seg = np.repeat(np.arange(batch), [len(q) for q in picked])
        W, b, V, U, w, c, c0 = p
        h = np.tanh(x @ W + b)
        t, g = np.tanh(h @ V), 1 / (1 + np.exp(-(h @ U)))
        a = np.exp((t * g) @ w)
        a = a / np.bincount(seg, weights=a, minlength=batch)[seg]
        z = np.zeros((batch, ENCODED))
        np.add.at(z, seg, h * a[:, None])
        prob = 1 / (1 + np.exp(-(z @ c + c0[0])))
        d = (prob - y) / batch
        dz = d[:, None] * c
        da = (dz[seg] * h).sum(1)
        de = a * (da - np.bincount(seg, weights=a * da, minlength=batch)[seg])
        dt, dg = de[:, None] * w * g * (1 - t * t), de[:, None] * w * t * g * (1 - g)
        dh = (dz[seg] * a[:, None] + dt @ V.T + dg @ U.T) * (1 - h * h)
        grads = [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ dg, (t * g).T @ de, z.T @ d, np.array([d.sum()])]
        rate = 1e-2 * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, gr, s, r in zip(p, grads, m1, m2, strict=True):
            gr = gr + 1e-4 * q
            s += 0.1 * (gr - s)
            r += 0.01 * (gr * gr - r)
            q -= rate * (s / (1 - 0.9**step)) / (np.sqrt(r / (1 - 0.99**step)) + 1e-8)
    return MilModel(*p[:6], float(p[6][0]), shift)


def training_bags(docs: DataFrame, labels: DataFrame, text_col: str, key_col: str, label_col: str,
                  max_docs: int = MAX_DOCS_PER_CLASS) -> tuple[list[tuple[np.ndarray, int]], float | None]:
    """Passage features of a bounded sample, computed on the executors, and the labelled share of class 1.

    ``docs`` and ``labels`` hold only rows that may be learned from.  A key
    labelled twice counts with its lowest label.  The sample is the ``max_docs``
    labelled keys of each class with the smallest key hash, so the broadcast
    side of the join has at most ``2 * max_docs`` rows and the result at most
    ``1 + BEGINNINGS`` bags for each of them (of several texts with one key, the
    one with the smallest features); of a long document, ``MAX_PASSAGES`` evenly
    spaced passages are learned from.
    """
    one = (labels.filter(F.col(label_col).isin(0, 1) & F.col(key_col).isNotNull())
           .groupBy(key_col).agg(F.min(label_col).alias("_y")))
    share = {r["_y"]: r["n"] for r in one.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(share.values())
    if len(share) < 2:
        return [], (share.get(1, 0) / total if total else None)
    h = F.xxhash64(F.col(key_col).cast("string"), F.lit("quality-sample"))
    picked = [r for c in (0, 1)
              for r in one.filter(F.col("_y") == c).orderBy(h, key_col).limit(max_docs).collect()]
    sample = docs.sparkSession.createDataFrame(picked, one.schema)

    @F.arrow_udf("binary")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raw, offsets = utf8_buffers(texts)
            bags = [[] for _ in range(len(texts))]
            for part, starts, ends, doc in _sections(raw, offsets):
                x, sec = passage_features(part, starts, ends)
                of = doc[sec]
                for d in np.unique(of):
                    bags[d].append(x[of == d])
            out = []
            for bag in bags:
                x = np.concatenate(bag)
                keep = np.unique(np.linspace(0, len(x) - 1, min(len(x), MAX_PASSAGES)).astype(int))
                out.append(x[keep].tobytes())
            yield pa.array(out, pa.binary())

    found = docs.select(key_col, F.col(text_col).alias("_t")).join(F.broadcast(sample), key_col)
    # Beside each whole text some beginnings of it, of both classes alike: they teach how little a short text tells.
    cut = lambda i: F.pow(F.lit(10.0), 0.6 + 2.2 * F.pmod(F.xxhash64(F.col(key_col).cast("string"), F.lit(i)), F.lit(1000)) / 1000)
    texts = F.explode(F.array(F.struct(F.lit(0).alias("i"), F.col("_t").alias("t")), *[
        F.struct(F.lit(i).alias("i"), F.substring(F.col("_t"), F.lit(1), cut(i).cast("int")).alias("t")) for i in range(1, BEGINNINGS + 1)]))
    # One row of a key and beginning, however often the key occurs.
    rows = (found.select(F.col(key_col).alias("_k"), "_y", texts.alias("b")).select("_k", "_y", "b.i", features("b.t").alias("_x"))
            .groupBy("_k", "_y", "i").agg(F.min("_x").alias("_x")).collect())
    rows.sort(key=lambda r: (r["_k"], r["i"], r["_x"]))
    return [(np.frombuffer(r["_x"], np.float32).reshape(-1, N_FEATURES), r["_y"]) for r in rows], share[1] / total


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", key_col: str = "doc_id",
        label_col: str = "quality") -> MilModel | float:
    """A model, or the constant score where there aren't two classes to learn from."""
    bags, share = training_bags(docs, labels, text_col, key_col, label_col)
    if len({y for _, y in bags}) < 2:
        return 0.5 if share is None else float(share)
    return train(bags, share)


def score_column(model: MilModel | float, text: Column) -> Column:
    """Probability of label 1 of a text."""
    if isinstance(model, float):
        return F.lit(model)

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(np.clip(np.round(score_bytes(model, *utf8_buffers(texts)), 6), 0.0, 1.0))

    return rate(text)


def score(docs: DataFrame, model: MilModel | float, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted``."""
    scored = docs.withColumn("score", score_column(model, F.col(text_col)))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
