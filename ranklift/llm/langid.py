"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (one to three code points of the text with letters
in lower case, digits and punctuation as blanks).  Document frequencies are counted over
all learning documents.  The weights are learnt with follow-the-regularised-leader
(per-coordinate steps, elastic net: l1 keeps them sparse) on a bounded sample of learning
documents, and a temperature is then calibrated on another part of that sample.  Every
text is scored whole, with numpy inside the tasks.

Bounds: ``SAMPLE`` documents per language at most (by smallest hash of doc_id, one text of
each) go to the driver for learning; scoring has no bound and sums a long text in pieces.
Defined results: a text that is null or has no letter is ``und`` with score 0; repeated rows
are each scored, and learnt from once; without learning rows every text is ``und``; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import table, written
from ranklift.llm.words import text_slices

BITS = 15
SAMPLE = 600
_RNG = np.random.Generator(np.random.PCG64(77))
_MUL = _RNG.integers(1, 2 ** 62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
UND = "und"


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Per code point below 65536: lower-case code (0 for what is no letter), and whether it is a letter."""
    code = np.zeros(65536, np.uint32)
    for c in range(65536):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            code[c] = ord(low[0])
    return code, code > 0


_CODE, _LETTER = _classes()


def grams(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, first slot of each text, letters of each text) of the hashed n-grams of the texts in a UTF-8 buffer."""
    chars = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.cumsum(np.r_[0, (buf & 0xC0) != 0x80])
    first = lead[bounds]
    inside = chars < 65536
    code = np.where(inside, _CODE[np.where(inside, chars, 0)], 0).astype(np.uint64)
    if not inside.all():
        far, at = np.unique(chars[~inside], return_inverse=True)
        code[~inside] = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in far], np.uint64)[at]
    letters = np.cumsum(np.r_[0, code > 0])
    blank = code == 0
    keep = ~(blank & np.r_[False, blank[:-1]])  # runs of non-letters are one blank
    keep[first[:-1][first[:-1] < len(chars)]] = True
    text_of = np.cumsum(np.r_[0, keep])
    code, first_kept = code[keep], text_of[first]
    n = len(code)
    h1 = code * _MUL[0]
    nxt, nxt2 = np.r_[code[1:], np.uint64(0)], np.r_[code[2:], np.zeros(min(2, n), np.uint64)]
    h2 = h1 + nxt * _MUL[1] + _MUL[3]
    h3 = h2 + nxt2[:n] * _MUL[2] + _MUL[3]
    slots = np.stack([h >> np.uint64(64 - BITS) for h in (h1 * _MUL[3], h2 * _MUL[3], h3 * _MUL[3])], axis=1)
    last = first_kept[1:][np.diff(first_kept) > 0] - 1  # n-grams do not cross texts
    slots[last, 1:] = slots[last, :1]
    before = last - 1
    before = before[before >= 0]
    slots[before, 2] = slots[before, 1]
    return slots.reshape(-1).astype(np.int64), first_kept * 3, np.diff(letters[first])


@dataclass
class Model:
    languages: list[str]
    weight: np.ndarray  # (slots, languages), idf included
    bias: np.ndarray
    temperature: float


def _df(batches):
    """(slot, n): in how many texts of the partition each n-gram occurs."""
    total = np.zeros(1 << BITS, np.int64)
    for b in batches:
        for _, _, buf, bounds in text_slices(b.column("text"), 1 << 19):
            slots, first, _ = grams(buf, bounds)
            for a, z in zip(first[:-1], first[1:], strict=True):
                seen = np.zeros(1 << BITS, bool)
                seen[slots[a:z]] = True
                total += seen
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])


def _counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slots, term frequency) of each text."""
    out = []
    for t in texts:
        raw = np.frombuffer(t.encode("utf-8"), np.uint8)
        slots, _, _ = grams(raw, np.array([0, len(raw)]))
        at, n = np.unique(slots, return_counts=True)
        out.append((at, n / max(len(slots), 1)))
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows, label, k: int, idf: np.ndarray, scale: float = 30.0, alpha: float = 0.5, beta: float = 1.0,
             l1: float = 0.02, l2: float = 0.02, epochs: int = 4, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights (slots, k) and bias by FTRL-proximal steps, one document at a time."""
    z, n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))
    order = np.random.default_rng(seed)

    def weights(at):
        zz, nn = z[at], n[at]
        w = -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2)
        return np.where(np.abs(zz) <= l1, 0.0, w)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, tf = rows[i]
            at, x = np.r_[at, len(idf)], np.r_[tf * idf[at] * scale, 1.0]
            w = weights(at)
            p = _softmax(x @ w)
            p[label[i]] -= 1.0
            g = x[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(len(idf) + 1))
    return w[:-1] * (idf * scale)[:, None], w[-1]


def calibrate(logits: np.ndarray, label: np.ndarray) -> float:
    """Temperature with the least log loss, by golden-section search on a log scale.

    The true label counts (n + 1) / (n + 2), the others share the rest, so that the least
    lies inside the search bounds also when every row is right.
    """
    k, rest = logits.shape[1], 1 / (len(label) + 2)
    aim = np.full(logits.shape, rest / max(k - 1, 1))
    aim[np.arange(len(label)), label] = 1 - rest if k > 1 else 1.0

    def loss(t):
        return -(aim * np.log(np.maximum(_softmax(logits / np.exp(t)), 1e-12))).sum(axis=1).mean()

    a, b, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Model from (doc_id, text, lang) learning rows; ``None`` if there are none."""
    docs = docs.filter(F.col("lang").isNotNull())
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # one text for each (lang, doc_id), the least by hash; ``sample`` of them for each language
    usable = docs.filter(F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    one = usable.groupBy("lang", "doc_id").agg(F.min("h").alias("h"))
    picked = written(one.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= sample))
    texts = usable.join(picked, (usable["lang"] == picked["lang"]) & usable["doc_id"].eqNullSafe(picked["doc_id"]) & (usable["h"] == picked["h"]))
    texts = texts.select(picked["lang"], "r", "text").dropDuplicates(["lang", "r"])
    rows = texts.orderBy("lang", "r").collect()
    if not rows:
        return None
    df = np.zeros(1 << BITS)
    for r in docs.select("text").mapInArrow(_df, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        df[r.slot] = r.n  # a fixed number of slots
    idf = np.log((1 + df.max()) / (1 + df)) + 1
    names = sorted({r.lang for r in rows})
    label = np.array([names.index(r.lang) for r in rows])
    held = np.array([r.r % 5 == 0 for r in rows])
    x = _counts([r.text for r in rows])
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    w, bias = fit_ftrl([x[i] for i in fit], label[fit], len(names), idf)
    rest = np.flatnonzero(held)
    t = calibrate(np.stack([x[i][1] @ w[x[i][0]] + bias for i in rest]), label[rest]) if len(rest) else 1.0
    return Model(names, w.astype(np.float32), bias, t)


def _sums(weight: np.ndarray, slots: np.ndarray, first: np.ndarray, cells: int = 1 << 22) -> np.ndarray:
    """Sum of the weights of each text's n-grams, at most ``cells`` weights at once."""
    out = np.zeros((len(first) - 1, weight.shape[1]))
    some = np.flatnonzero(np.diff(first))
    start, step = first[some], max(1, cells // weight.shape[1])
    for a in range(0, len(slots), step):
        z = min(a + step, len(slots))
        lo, hi = np.searchsorted(start, a, side="right") - 1, np.searchsorted(start, z)
        cut = np.maximum(start[lo:hi], a) - a
        out[some[lo:hi]] += np.add.reduceat(weight[slots[a:z]], cut, axis=0, dtype=np.float64)
    return out


def _score(model):
    def run(batches):
        m = model.value
        names = np.array([*m.languages, UND], object)
        for b in batches:
            ids = b.column("doc_id")
            for at, rows, buf, bounds in text_slices(b.column("text"), 1 << 19):
                slots, first, letters = grams(buf, bounds)
                n = np.maximum(np.diff(first), 1)[:, None]
                p = _softmax((_sums(m.weight, slots, first) / n + m.bias) / m.temperature)
                best = p.argmax(axis=1)
                none = letters == 0
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, rows), pa.array(names[np.where(none, len(m.languages), best)], pa.string()),
                     pa.array(np.where(none, 0.0, p[np.arange(len(best)), best]))], names=["doc_id", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs``."""
    if model is None:
        return docs.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(_score(sent), f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def held_out(modulus: int, rest: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


@register("op5_language_id")
def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.filter(~held_out(4, 2)))
    return identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
