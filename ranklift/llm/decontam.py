"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test string is a window of ``size`` consecutive words of a benchmark item; an item of
fewer words is one window.  Windows of one length m are searched together:

* a shift table over hashed blocks of two neighbouring words says how far the search may
  move on from a position; a block that no window holds moves it m - 1 words;
* where the shift is 0, windows whose last block has the same hash form a bucket, kept in
  the order of their first block's hash, and binary search picks those that agree in both;
* those windows' words are compared with the text byte by byte.  Only that decides.

Hashes cover a word's first bytes and its length, and are taken only where the search
stops.  The search runs with numpy over many stretches of the words at once, so a position
is skipped without being hashed.  Documents are read once, in one stage without a shuffle.

The tables are broadcast, and only up to ``limit`` bytes of windows at once: a larger
benchmark is cut into parts by the windows' digests, each part searched by a pass of its
own, and the passes' spans and items are put together by the text's digest.

Defined results: null text and text without words has no words and no hit; an item
without words has no window; rows that share an item_id are one item; windows of items
whose item_id is null are hit but count as no item; each row of ``docs`` gets a row, also
repeated ones and those with a null doc_id; a text of many megabytes is searched in pieces
that overlap by a window; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import table, written
from ranklift.llm.words import mix, text_slices

#: Bytes of a text that one piece holds about, and words of a stretch searched by one pointer.
PIECE, STRETCH = 4 << 20, 256
#: Bytes of windows that one broadcast holds at most.
LIMIT = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.arange(256)
_WORD = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80)
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2 ** 64 - 1], np.uint64)
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Words:
    """Lower-cased bytes of some texts and the spans of their words; text i has words first[i] .. first[i + 1] - 1."""

    def __init__(self, buf: np.ndarray, bounds: np.ndarray):
        self.buf = np.zeros(len(buf) + 8, np.uint8)
        self.buf[:len(buf)] = _LOWER[buf]
        word = _WORD[self.buf[:len(buf)]]
        edge = np.empty(len(buf) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(word[1:], word[:-1], out=edge[1:-1])
        edge[bounds] = True
        at = np.flatnonzero(edge)
        inside = word[at[:-1]]
        self.start, self.end = at[:-1][inside], at[1:][inside]
        self.first = np.searchsorted(self.start, bounds)

    def code(self, at: np.ndarray) -> np.ndarray:
        """Hash of the words ``at``: first eight bytes and length."""
        start = self.start[at]
        n = self.end[at] - start
        eight = np.ndarray((len(self.buf) - 7,), np.uint64, self.buf, strides=(1,))  # the eight bytes from each on
        return (eight[start] & _FIRST[np.minimum(n, 8)]) * _K[0] + n.astype(np.uint64) * _K[1]

    def block(self, last: np.ndarray, size: int) -> np.ndarray:
        """Hash of the block of ``size`` words (1 or 2) that ends at ``last``."""
        own = self.code(last)
        return mix(own + self.code(last - 1) * _K[2] if size == 2 else own)


class Windows:
    """Wu-Manber tables of distinct windows of m words each, given as space-joined bytes with their items."""

    def __init__(self, m: int, texts: list[bytes], items: list[list[int]]):
        self.m, self.block = m, min(m, 2)
        data = b" ".join(texts)
        self.words = w = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        last = np.arange(len(texts)) * m + m - 1
        blocks = np.stack([w.block(last - k, self.block) for k in range(m - self.block + 1)])  # k words before the end
        self.bits = min(24, max(14, int(16 * blocks.size).bit_length()))  # a shared slot only shortens a shift
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.uint8 if m < 256 else np.int32)
        for k in range(m - self.block, -1, -1):
            self.shift[self._slot(blocks[k])] = k
        code = self._both(blocks[0], blocks[-1])
        self.order = np.argsort(code, kind="stable")
        self.code = code[self.order]
        self.first_item = np.r_[0, np.cumsum([len(x) for x in items])]
        self.items = np.array([x for own in items for x in own], np.int64)

    def _slot(self, block):
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def _both(suffix, prefix):
        return mix(suffix * _K[1] + prefix, 3)

    def stops(self, w: Words) -> np.ndarray:
        """Last words of the positions where the shift is 0, ascending."""
        n = len(w.start)
        if n < self.m:
            return np.empty(0, np.int64)
        at = np.maximum(np.arange(0, n, STRETCH), self.m - 1)
        end = np.minimum(np.arange(STRETCH, n + STRETCH, STRETCH), n)
        found = []
        while True:
            live = at < end
            at, end = at[live], end[live]
            if not len(at):
                return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
            step = self.shift[self._slot(w.block(at, self.block))]
            if not step.all():
                found.append(at[step == 0])
            at = at + np.maximum(step, 1)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first word, window) of all occurrences."""
        last = self.stops(w)
        begin = last - self.m + 1
        text = np.searchsorted(w.first, begin, side="right") - 1
        whole = last < w.first[text + 1]
        last, begin, text = last[whole], begin[whole], text[whole]
        code = self._both(w.block(last, self.block), w.block(begin + self.block - 1, self.block))
        lo, hi = np.searchsorted(self.code, code), np.searchsorted(self.code, code, side="right")
        n = hi - lo
        own = np.repeat(np.arange(len(begin)), n)
        window = self.order[np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + lo[own]]
        same = self._equal(w, begin[own], window)
        return text[own][same], begin[own][same], window[same]

    def _equal(self, w: Words, begin: np.ndarray, window: np.ndarray) -> np.ndarray:
        """Whether the words from ``begin`` on are the window's, byte by byte."""
        p, ok = self.words, np.ones(len(begin), bool)
        for k in range(self.m):
            here = np.flatnonzero(ok)
            a, b = begin[here] + k, window[here] * self.m + k
            n = w.end[a] - w.start[a]
            alike = n == p.end[b] - p.start[b]
            ok[here[~alike]] = False
            here, a, b, n = here[alike], a[alike], b[alike], n[alike]
            if len(here):
                at = np.cumsum(n) - n
                inner = np.arange(int(n.sum())) - np.repeat(at, n)
                ok[here] = np.logical_and.reduceat(
                    w.buf[inner + np.repeat(w.start[a], n)] == p.buf[inner + np.repeat(p.start[b], n)], at)
        return ok


def _pieces(texts: pa.Array, overlap: int):
    """(row, rows, words, first word) of slices of whole texts, or of pieces of a long text.

    A piece begins ``overlap`` words before the end of the one before it, so every
    window of ``overlap`` + 1 words is whole in a piece; ``first word`` is the number of
    the piece's first word in its text.
    """
    for at, rows, buf, bounds in text_slices(texts):
        if len(buf) <= PIECE:
            yield at, rows, Words(buf, bounds), 0
            continue
        a = word = 0  # a slice above PIECE is one text
        while a < len(buf):
            b = min(a + PIECE, len(buf))
            while b < len(buf) and _WORD[_LOWER[buf[b]]]:  # to the end of the word
                b += 1
            w = Words(buf[a:b], np.array([0, b - a]))
            yield at, rows, w, word
            back = min(overlap, len(w.start)) if b < len(buf) else 0
            again = a + int(w.start[-back]) if back else b
            a, word = (again, word + len(w.start) - back) if again > a else (b, word + len(w.start))


def _span_union(begin: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ascending spans that cover the same words."""
    out = []
    for a, b in sorted(zip(begin.tolist(), stop.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _search(sent):
    """Per row: n_words, spans (first word, word after the last) and items of all hits."""
    def run(batches):
        tables = sent.value
        overlap = max((t.m for t in tables), default=1) - 1
        for b in batches:
            n_words, spans, items = np.zeros(b.num_rows, np.int64), {}, {}
            for at, rows, w, word in _pieces(b.column("text"), overlap):
                ends = at + np.arange(rows)
                n_words[ends] = np.maximum(n_words[ends], np.diff(w.first) + (word if rows == 1 else 0))
                for t in tables:
                    text, begin, window = t.find(w)
                    cut = np.flatnonzero(np.diff(text)) + 1
                    for a, z in zip(np.r_[0, cut], np.r_[cut, len(text)], strict=True):
                        if z > a:
                            row = at + int(text[a])
                            own = begin[a:z] - w.first[text[a]] + word
                            spans.setdefault(row, []).append((own, own + t.m))
                            seen = np.unique(window[a:z])
                            items.setdefault(row, set()).update(
                                x for p in seen for x in t.items[t.first_item[p]:t.first_item[p + 1]].tolist())
            merged = [_span_union(*(np.concatenate(x) for x in zip(*spans[r], strict=True))) if r in spans else []
                      for r in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in b.schema.names if c != "text"), pa.array(n_words),
                 pa.array([[{"begin": x, "stop": y} for x, y in m] for m in merged],
                          pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))),
                 pa.array([sorted(items.get(r, ())) for r in range(b.num_rows)], pa.list_(pa.int64()))],
                names=[*(c for c in b.schema.names if c != "text"), "n_words", "spans", "items"])
    return run


def _windows(size: int):
    def run(batches):
        for b in batches:
            ids = b.column("item_id").to_pylist()
            for at, _, buf, bounds in text_slices(b.column("text")):
                w = Words(buf, bounds)
                for i, (x, y) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                    words = [w.buf[s:e].tobytes() for s, e in zip(w.start[x:y], w.end[x:y], strict=True)]
                    m = min(size, len(words))
                    grams = list(dict.fromkeys(b" ".join(words[k:k + m]) for k in range(len(words) - m + 1))) if m else []
                    for k in range(0, len(grams), 4096):
                        own = grams[k:k + 4096]
                        yield pa.RecordBatch.from_arrays([pa.array([ids[at + i]] * len(own), pa.int64()), pa.array(
                            [m] * len(own), pa.int32()), pa.array(own, pa.binary())], names=["item_id", "m", "window"])
    return run


def benchmark_windows(items: DataFrame, size: int = 10) -> DataFrame:
    """(window, m, items): the distinct windows of all items; ``items`` is ascending, without null."""
    rows = (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
            .mapInArrow(_windows(size), "item_id long, m int, window binary"))
    return rows.groupBy("window", "m").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def _tables(rows) -> list[Windows]:
    by: dict[int, tuple[list, list]] = {}
    for window, m, items in sorted(rows):
        texts, own = by.setdefault(m, ([], []))
        texts.append(window)
        own.append(items)
    return [Windows(m, *by[m]) for m in sorted(by)]


def occurrences(docs: DataFrame, items: DataFrame, size: int = 10, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of ``docs``: word spans hit by windows of ``items``, and whose."""
    sc = docs.sparkSession.sparkContext
    found = written(benchmark_windows(items, size))
    total = found.agg(F.sum(F.length("window") + 8 * F.size("items") + 64)).first()[0] or 0
    parts = -(-2 * total // limit) if total > limit else 1  # parts of a digest's hash are about equal, hence the 2
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = "n_words long, spans array<struct<begin:long,stop:long>>, items array<long>"

    def sent(part):
        own = found if parts == 1 else found.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == part)
        return sc.broadcast(_tables([(bytes(r.window), r.m, r.items) for r in own.toLocalIterator()]))

    if parts == 1:
        return docs.mapInArrow(_search(sent(0)), f"doc_id long, {out}")
    key = F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")
    hits = []
    for part in range(parts):  # texts without a hit in the part leave nothing behind
        one = docs.select(key, "text").mapInArrow(_search(sent(part)), f"key string, {out}")
        hits.append(written(one.filter(F.size("spans") > 0).dropDuplicates(["key"])))
    some = reduce(DataFrame.unionByName, hits).groupBy("key").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = sc.broadcast([])
    rows = docs.select("doc_id", key, "text").mapInArrow(_search(none), f"doc_id long, key string, {out}")
    return (rows.select("doc_id", "key", "n_words").join(some, "key", "left")
            .select("doc_id", "n_words", F.coalesce("spans", F.array()).cast("array<struct<begin:long,stop:long>>").alias("spans"),
                    F.coalesce("items", F.array()).cast("array<long>").alias("items")))


def hit_words(spans: Column) -> Column:
    """Number of words in the union of ascending spans, which may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(spans, zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(s["stop"] - F.greatest(s["begin"], a["upto"]), F.lit(0).cast("long"))).alias("n"),
        F.greatest(a["upto"], s["stop"]).alias("upto")), lambda a: a["n"])


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: words, hit words, items found and a digest of their ids."""
    rows = occurrences(docs, items, size, limit).withColumn("n_hit", hit_words(F.col("spans")))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS re),
d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), re) AS w
      FROM documents, word),
i AS (SELECT item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), re) AS w
      FROM benchmark, word),
iw AS (SELECT item_id, least(len(w), 10) AS m, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[k:k + m - 1], ' ') AS g FROM iw),
dw AS (SELECT r, m, k, array_to_string(w[k:k + m - 1], ' ') AS g
       FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT r, k, dw.m, item_id FROM dw JOIN win ON dw.m = win.m AND dw.g = win.g),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS p FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS t
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS t FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""


@register("op13_decontamination", SQL)
def op13_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
