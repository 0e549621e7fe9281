"""Language identification with a small byte convolutional network.

Training (numpy, on the driver, over a bounded labelled sample): bytes are
folded to classes (ASCII letters by case-folded letter, every non-ASCII byte
by itself, everything else one class), embedded, convolved with filters of
several widths, max-pooled over a fixed-length window and classified with a
softmax.

Application (Arrow batches on the executors): every text is cut into
fixed-length windows that overlap by the largest width less one, so no n-gram
is lost at a cut; all bytes of all texts are read.  A filter over w embedded
bytes is a sum of per-byte terms, so trained filters are turned into lookup
tables over byte-class pairs and a window costs a few table reads per byte.
Window probabilities are averaged with the number of letter bytes as weight.

Defined results: null text, or text without any letter -> ``und`` with score
0; nothing to learn from -> every text ``und`` with score 0; one learned
language -> that language with score 1; repeated rows get equal results; extra
columns pass through untouched (the two result columns replace columns of the
same name).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecart.llm.common import free_name, utf8_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Bounds of the training sample: documents per language, documents in all, windows per document.
MAX_DOCS_PER_LANG = 700
MAX_DOCS = 180_000
#: Every language is learned; more than these are an error.
MAX_LANGS = 4096
WINDOWS_PER_DOC = 3
UNDETERMINED = "und"

# Byte classes: 0 everything else, 1-26 ASCII letters, 27-154 the bytes 128-255.
N_CLASSES = 27 + 128
_CLASS = np.zeros(256, np.int64)
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, N_CLASSES)


@dataclass
class ByteConvNet:
    langs: list[str]
    embed: np.ndarray  # (classes, EMBED)
    filters: dict[int, np.ndarray]  # width -> (width, EMBED, FILTERS)
    bias: dict[int, np.ndarray]
    dense: np.ndarray  # (len(WIDTHS) * FILTERS, langs)
    dense_bias: np.ndarray


def training_sample(labelled: DataFrame, text_col: str, lang_col: str, key_col: str,
                    max_docs: int = MAX_DOCS_PER_LANG) -> list[tuple[str, list[str]]]:
    """(lang, windows) of a bounded, hash-chosen sample with up to about ``max_docs`` documents a language.

    One column-pruned count per language gives each language's sampling rate;
    the sample itself is a filter on a hash of the key and a top-k by it.  All
    languages take part; where they are many, each has ``MAX_DOCS`` divided by
    their number of documents.  More than ``MAX_LANGS`` raise a ValueError.
    """
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = rows.groupBy(lang_col).count().limit(MAX_LANGS + 1).collect()
    if not counts:
        return []
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    max_docs = min(max_docs, MAX_DOCS // len(counts))
    h = F.xxhash64(F.col(key_col).cast("string"), F.lit("language-sample"))
    unit = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    # A quarter more than asked for, so that the cut below rarely binds unevenly.
    rates = F.from_json(F.lit(json.dumps({r[lang_col]: min(1.0, 1.25 * max_docs / r["count"]) for r in counts})), "map<string,double>")
    keep = unit < F.try_element_at(rates, F.col(lang_col))
    n = F.length(text_col)
    starts = [F.lit(1), F.greatest(F.lit(1), F.floor(n / 2).cast("int")), F.greatest(F.lit(1), n - WINDOW)]
    picked = (rows.filter(keep)
              .select(F.col(lang_col).alias("lang"), unit.alias("u"),
                      F.array_distinct(F.array(*[F.substring(F.col(text_col), s, F.lit(WINDOW))
                                                 for s in starts[:WINDOWS_PER_DOC]])).alias("w"))
              .orderBy("u", "lang", "w").limit(int(1.5 * max_docs * len(counts))).collect())
    return [(r["lang"], list(r["w"])) for r in picked]


def _windows(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), WINDOW), np.int64)
    for i, b in enumerate(texts):
        raw = np.frombuffer(b[:WINDOW], np.uint8)
        out[i, :len(raw)] = _CLASS[raw]
    return out


def train(sample: list[tuple[str, list[str]]], steps: int | None = None, batch: int = 64, seed: int = 7) -> ByteConvNet | None:
    """Adam on the cross entropy of window labels, every language equally often (500 steps, or 10 a language)."""
    langs = sorted({lang for lang, _ in sample})
    steps = max(500, 10 * len(langs)) if steps is None else steps
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    net = ByteConvNet(
        langs, rng.normal(0, 0.3, (N_CLASSES, EMBED)),
        {w: rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS},
        {w: np.zeros(FILTERS) for w in WIDTHS},
        rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))), np.zeros(len(langs)))
    if len(langs) == 1:
        return net
    by_lang = [_windows([t.encode() for lang, ws in sample if lang == name for t in ws]) for name in langs]
    params = [net.embed, *net.filters.values(), *net.bias.values(), net.dense, net.dense_bias]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        y = rng.integers(0, len(langs), batch)
        x = np.stack([by_lang[k][rng.integers(len(by_lang[k]))] for k in y])
        e = net.embed[x]
        pooled, patches, args = [], {}, {}
        for w in WIDTHS:
            p = WINDOW - w + 1
            conv = sum(e[:, j:j + p] @ net.filters[w][j] for j in range(w)) + net.bias[w]
            args[w] = conv.argmax(1)
            pooled.append(np.take_along_axis(conv, args[w][:, None], 1)[:, 0])
            at = args[w][..., None] + np.arange(w)
            patches[w] = (x[np.arange(batch)[:, None, None], at], e[np.arange(batch)[:, None, None], at])
        z = np.concatenate(pooled, 1)
        a = np.maximum(z, 0)
        logit = a @ net.dense + net.dense_bias
        prob = np.exp(logit - logit.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        d = prob
        d[np.arange(batch), y] -= 1
        d /= batch
        g_dense, g_db = a.T @ d, d.sum(0)
        dz = (d @ net.dense.T) * (z > 0)
        g_embed, g_f, g_b = np.zeros_like(net.embed), [], []
        for i, w in enumerate(WIDTHS):
            dm = dz[:, i * FILTERS:(i + 1) * FILTERS]
            cls, emb = patches[w]
            g_f.append(np.einsum("bf,bfwd->wdf", dm, emb))
            g_b.append(dm.sum(0))
            np.add.at(g_embed, cls, dm[:, :, None, None] * net.filters[w].transpose(2, 0, 1)[None])
        rate = 4e-3 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, u, v in zip(params, [g_embed, *g_f, *g_b, g_dense, g_db], m1, m2, strict=True):
            u += 0.1 * (g - u)
            v += 0.01 * (g * g - v)
            p -= rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def _tables(net: ByteConvNet) -> dict[int, list[np.ndarray]]:
    """Filters as tables over byte-class pairs (and one class, for odd widths)."""
    out = {}
    for w in WIDTHS:
        term = [(net.embed @ net.filters[w][j]).astype(np.float32) for j in range(w)]
        term[0] = term[0] + net.bias[w].astype(np.float32)
        parts = [(term[j][:, None] + term[j + 1][None]).reshape(-1, FILTERS) for j in range(0, w - 1, 2)]
        out[w] = parts + ([term[w - 1]] if w % 2 else [])
    return out


def _window_probs(net: ByteConvNet, tables, cls: np.ndarray) -> np.ndarray:
    """Softmax of windows given as byte classes, shape (WINDOW, windows)."""
    n = cls.shape[1]
    pair = cls[:-1] * N_CLASSES + cls[1:]
    pooled = []
    for w in WIDTHS:
        p = WINDOW - w + 1
        conv = tables[w][0][pair[:p]]
        for i, t in enumerate(tables[w][1:], 1):
            conv += t[pair[2 * i:2 * i + p]] if 2 * i + 1 < w else t[cls[2 * i:2 * i + p]]
        pooled.append(conv.reshape(p, n * FILTERS).max(0).reshape(n, FILTERS))
    logit = np.maximum(np.concatenate(pooled, 1), 0) @ net.dense + net.dense_bias
    prob = np.exp(logit - logit.max(1, keepdims=True))
    return prob / prob.sum(1, keepdims=True)


def predict_bytes(net: ByteConvNet, tables, raw: np.ndarray, offsets: np.ndarray, chunk: int = 64) -> np.ndarray:
    """Class probabilities of each text; ``chunk`` windows are held at a time."""
    step = WINDOW - max(WIDTHS) + 1
    length = np.diff(offsets)
    n_win = np.maximum(1, -(-(length - max(WIDTHS) + 1) // step))
    first = np.concatenate([[0], np.cumsum(n_win)])
    total = np.zeros((len(length), len(net.langs)))
    weight = np.zeros(len(length))
    for a in range(0, int(first[-1]), chunk):
        win = np.arange(a, min(a + chunk, int(first[-1])))
        doc = np.searchsorted(first, win, side="right") - 1
        start = offsets[doc] + (win - first[doc]) * step
        at = start + np.arange(WINDOW)[:, None]
        inside = at < offsets[doc + 1]
        cls = np.where(inside, _CLASS[raw[np.minimum(at, len(raw) - 1)]], 0) if len(raw) else np.zeros(at.shape, np.int64)
        letters = np.maximum((cls > 0).sum(0), 1e-6)
        np.add.at(total, doc, _window_probs(net, tables, cls) * letters[:, None])
        np.add.at(weight, doc, letters)
    return total / np.maximum(weight, 1e-12)[:, None]


def identify(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})

    @F.arrow_udf("i int, p double")
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = _tables(net)
        for texts in batches:
            raw, offsets = utf8_buffers(texts)
            prob = predict_bytes(net, tables, raw, offsets)
            best = prob.argmax(1)
            score = np.clip(np.round(prob[np.arange(len(best)), best], 6), 0.0, 1.0)
            yield pa.StructArray.from_arrays([pa.array(best.astype(np.int32)), pa.array(score)], ["i", "p"])

    names = F.array(*[F.lit(x) for x in net.langs])
    lid = free_name("_lid", docs.columns)
    out = docs.withColumn(lid, classify(F.when(has_letter, F.col(text_col))))
    return out.withColumns({
        "lang_pred": F.when(has_letter, F.get(names, F.col(f"{lid}.i"))).otherwise(F.lit(UNDETERMINED)),
        "score": F.when(has_letter, F.col(f"{lid}.p")).otherwise(F.lit(0.0)),
    }).drop(lid)
