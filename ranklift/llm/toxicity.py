"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs per word: an embedding of the word (hashed) and the mean embedding of its byte
trigrams.  A text is read as overlapping windows of ``WINDOW`` words every ``STRIDE``
words; the network reads a window in both directions, attention pools the states, and a
logistic unit scores it.  The score of a text is that of its highest window, so whole
texts of any length are scored.

Learning (numpy, on the driver) uses a bounded sample of labelled documents, ``SAMPLE``
per label at most by smallest hash of doc_id.  A document's loss flows through its
highest window.  The first component of the embeddings starts from the log-odds of the
sampled labels, the rest at random; Adam does the steps.

Defined results: a text that is null or has no word scores 0; without labelled rows of both
kinds every score is 0; repeated rows are each scored; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import table
from ranklift.llm.words import mix, split_words, text_slices

WINDOW, STRIDE = 32, 16
WORD_SLOTS, CHAR_SLOTS = 1 << 15, 1 << 13
WORD_DIM, CHAR_DIM, HIDDEN = 8, 4, 6
SAMPLE = 1500
#: ASCII punctuation counts as space, so that a word is the same with a comma behind it.
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
_CLEAN[65:91] += 32


class Inputs:
    """Windows of a slice of texts: distinct words with their slots, and each window's words."""

    def __init__(self, buf: np.ndarray, bounds: np.ndarray):
        w = split_words(_CLEAN[buf], bounds)
        distinct, where, self.word = np.unique(w.hash, return_index=True, return_inverse=True)
        self.slot = (mix(distinct, 31) % np.uint64(WORD_SLOTS)).astype(np.int64)
        start, n = w.start[where], (w.end - w.start)[where]
        self.char_at = np.cumsum(n) - n
        self.char_n = n
        pos = np.arange(int(n.sum())) - np.repeat(self.char_at, n)
        at = pos + np.repeat(start, n)
        b = w.buf.astype(np.uint64)
        last = np.repeat(n, n) - 1
        before = np.where(pos > 0, b[np.maximum(at - 1, 0)], 1)
        after = np.where(pos < last, b[np.minimum(at + 1, max(len(b) - 1, 0))], 2)
        self.char = (mix((before << np.uint64(16)) | (b[at] << np.uint64(8)) | after, 33)
                     % np.uint64(CHAR_SLOTS)).astype(np.int64)
        words = np.diff(w.first)
        windows = np.where(words > 0, np.maximum(1, -(-(words - WINDOW) // STRIDE) + 1), 0)
        self.first = np.cumsum(np.r_[0, windows])  # windows of text i
        text = np.repeat(np.arange(len(words)), windows)
        no = np.arange(len(text)) - self.first[text]
        begin = w.first[text] + no * STRIDE
        self.index = begin[None, :] + np.arange(WINDOW)[:, None]  # (step, window)
        self.mask = self.index < w.first[text + 1][None, :]
        self.index = np.minimum(self.index, max(len(w.hash) - 1, 0))


def initial(seed: int = 3) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    r = lambda *s: (g.standard_normal(s) * 0.3).astype(np.float32)
    p = {"word": r(WORD_SLOTS, WORD_DIM) * 0.1, "char": r(CHAR_SLOTS, CHAR_DIM) * 0.1,
         "att": r(2 * h), "out": r(2 * h), "bias": np.array([-1.0], np.float32)}
    for k in "fb":
        p |= {f"w{k}": r(d, 3 * h), f"u{k}": r(h, 3 * h), f"c{k}": np.zeros(3 * h, np.float32)}
    return p


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-x))


def embed(p, x: Inputs) -> np.ndarray:
    """Inputs of the distinct words."""
    sums = np.add.reduceat(p["char"][x.char], x.char_at) if len(x.char) else np.zeros((0, CHAR_DIM), np.float32)
    return np.concatenate([p["word"][x.slot], sums / x.char_n[:, None].astype(np.float32)], axis=1)


def _read(pre, u, word, mask, steps, keep=None):
    """States of one direction, (step, window, HIDDEN); ``keep`` collects what learning needs."""
    h = HIDDEN
    state = np.zeros((word.shape[1], h), np.float32)
    out = np.empty((word.shape[0], word.shape[1], h), np.float32)
    for t in steps:
        x, hu = pre[word[t]], state @ u
        gate = _sigmoid(x[:, :2 * h] + hu[:, :2 * h])
        z, r = gate[:, :h], gate[:, h:]
        new = np.tanh(x[:, 2 * h:] + r * hu[:, 2 * h:])
        m = mask[t][:, None]
        if keep is not None:
            keep[t] = (state, z, r, new, hu[:, 2 * h:], m)
        state = np.where(m, new + z * (state - new), state)
        out[t] = state
    return out


def logits(p, x: Inputs, windows=None, keep=None) -> np.ndarray:
    """Logit of each window (or of the chosen ones)."""
    index, mask = (x.index, x.mask) if windows is None else (x.index[:, windows], x.mask[:, windows])
    if not index.shape[1]:
        return np.zeros(0, np.float32)
    word = x.word[index]
    e = embed(p, x)
    steps = list(range(WINDOW))
    kf, kb = ({}, {}) if keep is not None else (None, None)
    hs = np.concatenate([_read(e @ p["wf"] + p["cf"], p["uf"], word, mask, steps, kf),
                         _read(e @ p["wb"] + p["cb"], p["ub"], word, mask, steps[::-1], kb)], axis=2)
    a = np.where(mask, hs @ p["att"], np.float32(-1e9))
    a = np.exp(a - a.max(axis=0))
    a /= a.sum(axis=0)
    pooled = (a[:, :, None] * hs).sum(axis=0)
    if keep is not None:
        keep.update(e=e, word=word, hs=hs, a=a, pooled=pooled, f=kf, b=kb)
    return pooled @ p["out"] + p["bias"][0]


def _back(pre_grad, u, word, dh, saved, steps):
    """Gradient of one direction: fills ``pre_grad`` (distinct words), returns the one of ``u``."""
    h = HIDDEN
    du, carry = np.zeros_like(u), np.zeros(dh.shape[1:], np.float32)
    for t in steps:
        state, z, r, new, hun, m = saved[t]
        d = carry + dh[t]
        dm = np.where(m, d, 0)
        dnew = dm * (1 - z) * (1 - new * new)
        dz = dm * (state - new) * z * (1 - z)
        dr = dnew * hun * r * (1 - r)
        dhu = np.concatenate([dz, dr, dnew * r], axis=1)
        np.add.at(pre_grad, word[t], np.concatenate([dz, dr, dnew], axis=1))
        du += state.T @ dhu
        carry = np.where(m, dm * z, d) + dhu @ u.T
    return du


def gradient(p, x: Inputs, windows, label) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss over the chosen windows."""
    k: dict = {}
    d = (_sigmoid(logits(p, x, windows, k)) - label) / len(label)
    d = d.astype(np.float32)
    g = {"bias": np.array([d.sum()], np.float32), "out": k["pooled"].T @ d}
    dp = d[:, None] * p["out"][None, :]
    da = (k["hs"] * dp[None]).sum(axis=2)
    ds = k["a"] * (da - (k["a"] * da).sum(axis=0))
    g["att"] = (ds[:, :, None] * k["hs"]).sum(axis=(0, 1))
    dh = k["a"][:, :, None] * dp[None] + ds[:, :, None] * p["att"]
    de = np.zeros_like(k["e"])
    steps = list(range(WINDOW))
    for name, part, order in (("f", dh[:, :, :HIDDEN], steps[::-1]), ("b", dh[:, :, HIDDEN:], steps)):
        pre = np.zeros((len(k["e"]), 3 * HIDDEN), np.float32)
        g[f"u{name}"] = _back(pre, p[f"u{name}"], k["word"], part, k[name], order)
        g[f"w{name}"] = k["e"].T @ pre
        g[f"c{name}"] = pre.sum(axis=0)
        de += pre @ p[f"w{name}"].T
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], x.slot, de[:, :WORD_DIM])
    np.add.at(g["char"], x.char, np.repeat(de[:, WORD_DIM:] / x.char_n[:, None].astype(np.float32), x.char_n, axis=0))
    return g


def _inputs(texts: list[str]) -> Inputs:
    raw = [t.encode("utf-8") for t in texts]
    return Inputs(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *[len(r) for r in raw]]))


def highest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Position of the highest window of each text; -1 if it has none."""
    out = np.full(len(first) - 1, -1)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if b > a:
            out[i] = a + int(values[a:b].argmax())
    return out


def train(texts: list[str], labels: list[int], epochs: int = 5, batch: int = 32, rate: float = 0.02,
          seed: int = 3) -> dict[str, np.ndarray]:
    """Network parameters learnt from whole labelled texts."""
    p, y = initial(seed), np.array(labels, np.float32)
    counts = {"word": np.ones((2, WORD_SLOTS)), "char": np.ones((2, CHAR_SLOTS))}
    for t, c in zip(texts, labels, strict=True):
        x = _inputs([t])
        counts["word"][c, np.unique(x.slot)] += 1
        counts["char"][c, np.unique(x.char)] += 1
    for k, n in counts.items():
        odds = np.log(n[1] / (1 + y.sum())) - np.log(n[0] / (1 + (1 - y).sum()))
        p[k][:, 0] = np.clip(odds, -2, 4)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    rng, step = np.random.default_rng(seed), 0
    order = np.arange(len(texts))
    for _ in range(epochs):
        rng.shuffle(order)
        for a in range(0, len(order), batch):
            part = order[a:a + batch]
            x = _inputs([texts[i] for i in part])
            top = highest(logits(p, x), x.first)
            has = top >= 0
            if not has.any():
                continue
            g = gradient(p, x, top[has], y[part][has])
            step += 1
            fade = max(0.05, 1 - step * batch / (epochs * len(order)))
            for k, v in g.items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                p[k] = (p[k] - rate * fade * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p


def score_buffer(p, buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Score of each text of a UTF-8 buffer."""
    x = Inputs(buf, bounds)
    value = logits(p, x)
    out, has = np.zeros(len(bounds) - 1), np.diff(x.first) > 0
    if has.any():
        out[has] = _sigmoid(np.maximum.reduceat(value, x.first[:-1][has]).astype(np.float64))
    return out


def _score(sent):
    def run(batches):
        for b in batches:
            ids = b.column("doc_id")
            for at, rows, buf, bounds in text_slices(b.column("text"), 1 << 19):
                yield pa.RecordBatch.from_arrays([ids.slice(at, rows), pa.array(score_buffer(sent.value, buf, bounds))],
                                                 names=["doc_id", "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray] | None:
    """Parameters learnt from the labelled rows (doc_id, toxic) of ``labels``; ``None`` without both labels."""
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = known.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= sample)
    # one text for each picked doc_id, so that no repeated row can push a label out; at most ``sample`` rows a label
    rows = (docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id")
            .groupBy("doc_id", "toxic", "r").agg(F.min("text").alias("text")).orderBy("toxic", "r").collect())
    y = [int(r.toxic) for r in rows]
    return train([r.text for r in rows], y) if len(set(y)) == 2 else None


def toxicity(docs: DataFrame, params: dict[str, np.ndarray] | None) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    if params is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(params)
    return docs.select("doc_id", "text").mapInArrow(_score(sent), f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    params = fit(docs, labels.select("doc_id", "toxic").filter(~held))
    return toxicity(docs, params).select("doc_id", held.alias("held_out"), "score",
                                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
