"""Substring deduplication by hashing normalised text units and passages.

Units are the sentences of each line (a unit ends after a word that ends in ``.``, ``!``
or ``?`` and at every line feed); a unit of more than ``LONG`` words is cut further after
words chosen by their hash.  A unit is normalised (letters A-Z in lower case, white space
runs as one space) by hashing its words, 128 bits in all.

Anchors find passages that start or end anywhere: of every ``window`` neighbouring runs of
``size`` words the one with the smallest hash is an anchor, whatever sentences it crosses,
and size + window - 1 = ``PASSAGE``, so two texts that share ``PASSAGE`` words in a row
share an anchor.  The first and the last matched anchor of a run of repeats are extended word by word
to the left and to the right against the occurrence that stays; an end that lies ``window``
words off has an anchor of its own, so ``window`` - 1 words a side are enough.  Shorter repeats are found where they are whole units or hold an
anchor.

Digests are grouped over the whole corpus; the occurrence with the smallest (doc_id, word
number) stays, every other one is a repeat.  Repeats that overlap or touch are one run,
and a run is removed if it has at least ``min_words`` words, so that short sentences that
chance repeats stay in clean documents.  Spans are offsets in code points of the original
text.  If the earliest occurrence of a passage's outermost anchor is a shorter copy, up to
``window`` - 1 words at that end of the passage may stay.

The first pass counts digests; what occurs twice or more marks a byte array of fixed size
that the second pass uses to send only units and anchors that may repeat.  A third pass
reads the words beside the matched passages.

Defined results: null and empty texts have no units; equal rows (doc_id, text) are the same
document (equal units of theirs are one occurrence).  Other texts under one doc_id, and
rows without a doc_id, are documents of their own that rank behind all others; spans are
told apart by ``text_hash`` there.  Further columns pass through ``remove_repeats``; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import slot_sketch, table, written
from ranklift.llm.words import Words, mix, powers, word_slices

LONG = 32
MIN_WORDS = 25
#: Digests with more than one row in HOT are joined by broadcast.
HOT = 1000
_OTHER = np.uint64(0xD1342543DE82EF95)
#: Repeats of so many words are found wherever they start and end.
PASSAGE = 50


def anchor_sizes(passage: int) -> tuple[int, int]:
    """(words of an anchor, anchors to choose from) that find every repeat of ``passage`` words."""
    return passage // 2 + 1, passage - passage // 2


def units(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each unit, words, two 64-bit digests) for all units of a slice."""
    n = len(w.start)
    if not n:
        z = np.empty(0, np.uint64)
        return z.astype(np.int64), z.astype(np.int64), z, z
    feeds = np.cumsum(np.r_[0, w.buf == 10])
    after = np.r_[w.start[1:], len(w.buf)]
    last = np.isin(w.buf[w.end - 1], np.frombuffer(b".!?", np.uint8)) | (feeds[after] > feeds[w.end])
    last[w.first[1:][w.first[1:] > 0] - 1] = True  # a text's last word
    begin = np.flatnonzero(np.r_[True, last[:-1]])
    size = np.diff(np.r_[begin, n])
    long_word = np.repeat(size > LONG, size)
    last |= long_word & (w.hash % np.uint64(8) == 0)
    begin = np.flatnonzero(np.r_[True, last[:-1]])
    size = np.diff(np.r_[begin, n])
    pos = np.arange(n) - np.repeat(begin, size)
    most = int(size.max())
    one = mix(np.add.reduceat(w.hash * powers(most)[pos], begin), 21)
    two = mix(np.add.reduceat(mix(w.hash, 22) * powers(most, _OTHER)[pos], begin), 23)
    return begin, size, one, two


def _sums(hashes: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every run of ``size`` words."""
    n = len(hashes)
    upto = np.r_[np.uint64(0), np.cumsum(hashes * powers(n, base)[:n])]
    back = powers(n, np.uint64(pow(int(base), -1, 1 << 64)))
    return (upto[size:] - upto[:-size]) * back[:n - size + 1]


def anchors(w: Words, size: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word of each anchor, two 64-bit digests): the smallest of ``window`` runs of ``size`` words."""
    n = len(w.start) - size + 1
    if n < window:
        z = np.empty(0, np.uint64)
        return z.astype(np.int64), z, z
    one = mix(_sums(w.hash, size, _OTHER), 24)
    at, reach = np.arange(n), 1
    while reach < window:
        step = min(reach, window - reach)
        at = np.where(one[at[:-step]] <= one[at[step:]], at[:-step], at[step:])
        reach += step
    end = np.repeat(w.first[1:], np.diff(w.first))[:len(at)]
    chosen = np.zeros(n, bool)
    chosen[at[np.arange(len(at)) + window + size - 1 <= end]] = True  # windows inside one text
    at = np.flatnonzero(chosen)
    return at, one[at], mix(_sums(mix(w.hash, 26), size, _OTHER)[at], 25)


def _digests(size, window):
    """(h1, n) of the units and anchors of each slice."""
    def run(batches):
        for b in batches:
            for _, _, w in word_slices(b.column("text")):
                one, n = np.unique(np.r_[units(w)[2], anchors(w, size, window)[1]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(n.astype(np.int32))], names=["h1", "n"])
    return run


def _candidates(sketch, size, window):
    """(doc_id, word, words, begin, end, h1, h2, anchor) of the units and anchors whose digest may occur elsewhere."""
    def run(batches):
        slots = sketch.value
        mask = np.uint64(len(slots) - 1)
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for at, rows, w in word_slices(b.column("text")):
                begin, words, one, two = units(w)
                if not len(begin):
                    continue
                far, h1, h2 = anchors(w, size, window)
                anchor = np.repeat([False, True], [len(begin), len(far)])
                one, two = np.r_[one, h1], np.r_[two, h2]
                keep = np.flatnonzero(slots[one & mask])
                first = np.r_[begin, far][keep]
                words = np.r_[words, np.full(len(far), size)][keep]
                doc = np.searchsorted(w.first, first, side="right") - 1
                chars = np.cumsum(np.r_[0, (w.buf & 0xC0) != 0x80])
                base = chars[w.bounds[doc]]
                lo, hi = chars[w.start[first]] - base, chars[w.end[first + words - 1]] - base
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at + doc]), *[pa.array(x.astype(np.int32)) for x in (first - w.first[doc], words, lo, hi)],
                     pa.array(one[keep].view(np.int64)), pa.array(two[keep].view(np.int64)), pa.array(anchor[keep])],
                    names=["doc_id", "word", "words", "begin", "end", "h1", "h2", "anchor"])
    return run


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    width = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _beside(side):
    """(doc_id, code, near, edge): the ``side`` words beside a word border of a document.

    Code 2 * i asks for the words before word i, nearest first, 2 * i + 1 for those from
    word i on; ``near`` has their hashes (0 beyond the text), ``edge`` the offset at which a
    span that takes them in begins or ends.
    """
    def run(batches):
        for b in batches:
            ids, codes = b.column("doc_id").to_numpy(zero_copy_only=False), b.column("codes")
            for at, rows, w in word_slices(b.column("text")):
                part = codes.slice(at, rows)
                code = part.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(rows), np.diff(part.offsets.to_numpy()))
                if not len(w.start):
                    continue
                chars = np.cumsum(np.r_[0, (w.buf & 0xC0) != 0x80])
                for a in range(0, len(code), 1 << 14):
                    c, d = code[a:a + (1 << 14)], doc[a:a + (1 << 14)]
                    after = (c & 1)[:, None] == 1
                    word = (w.first[d] + (c >> 1))[:, None] + np.where(after, np.arange(side), -1 - np.arange(side))
                    inside = (word >= w.first[d][:, None]) & (word < w.first[d + 1][:, None])
                    word = np.clip(word, 0, len(w.start) - 1)
                    near = np.where(inside, (w.hash[word] >> np.uint64(32)) | np.uint64(1), np.uint64(0)).astype("<u4")
                    edge = chars[np.where(after, w.end[word], w.start[word])] - chars[w.bounds[d]][:, None]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at + d]), pa.array(c), _binary(near), _binary(edge.astype("<i4"))],
                                                     names=["doc_id", "code", "near", "edge"])
    return run


def _extended(side):
    """Runs (doc_id, word, stop, begin, end, n_units, kept_doc_id, kept_anchor), with the words beside them that the kept one has too.

    The first anchor (head) may reach further to the left than the run, the last one (tail) to the right.
    """
    def run(batches):
        for b in batches:
            def matrix(name, kind):
                cells = b.column(name).fill_null(bytes(4 * side)).to_pylist()  # noqa: B023
                return np.frombuffer(b"".join(cells), kind).reshape(-1, side)

            def numbers(name):
                return b.column(name).fill_null(0).to_numpy().copy()  # noqa: B023

            word, stop, begin, end = (numbers(c) for c in ("word", "stop", "begin", "end"))
            row = np.arange(len(word))
            for k in (0, 1):
                own = matrix(f"near{k}", "<u4")
                more = np.cumprod((own == matrix(f"near{k + 2}", "<u4")) & (own > 0), axis=1).sum(axis=1)
                offset = matrix(f"edge{k}", "<i4")[row, np.maximum(more - 1, 0)]
                if k:
                    far = numbers("tail_stop") + more
                    beyond = (more > 0) & (far > stop)
                    end, stop = np.where(beyond, offset, end), np.where(beyond, far, stop)
                else:
                    far = numbers("head_word") - more
                    beyond = (more > 0) & (far < word)
                    begin, word = np.where(beyond, offset, begin), np.where(beyond, far, word)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(x.astype(np.int32)) for x in (word, stop, begin, end)],
                                              b.column("n_units"), b.column("kept_doc_id"), b.column("kept_anchor")],
                                             names=["doc_id", "word", "stop", "begin", "end", "n_units", "kept_doc_id", "kept_anchor"])
    return run


def _runs(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``run``: rows (word, stop) with equal ``by`` that overlap or touch have the same number."""
    upto = Window.partitionBy(*by).orderBy("word", "stop")
    gap = F.col("word") > F.max("stop").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("gap", F.coalesce(gap.cast("int"), F.lit(0)))
            .withColumn("run", F.sum("gap").over(upto.rowsBetween(Window.unboundedPreceding, 0))).drop("gap"))


def _grown(docs: DataFrame, again: DataFrame, side: int) -> DataFrame:
    """Runs of repeats (doc_id, word, stop, begin, end, n_units, kept_doc_id, kept_anchor), extended at ends with an anchor.

    ``kept_doc_id`` keeps the first unit or anchor, ``kept_anchor`` is the smallest document that keeps an anchor.
    """
    anchor = F.col("anchor")
    runs = written(_runs(again, ["doc_id"]).groupBy("doc_id", "run").agg(
        *[F.min(c).alias(c) for c in ("word", "begin")], *[F.max(c).alias(c) for c in ("stop", "end")],
        F.count("*").alias("n_units"), F.min_by("kept_doc_id", F.struct("word", "kept_doc_id")).alias("kept_doc_id"),
        F.min(F.when(anchor, F.col("kept_doc_id"))).alias("kept_anchor"), F.min(F.when(anchor, F.struct("word", "kept_doc_id", "kept_word"))).alias("head"),
        F.max(F.when(anchor, F.struct("stop", "kept_doc_id", (F.col("kept_word") + F.col("stop") - F.col("word")).alias("kept_stop"))))
        .alias("tail")))

    def ask(part, end, doc, code):
        near = (F.col("head.word") - F.col("word") if end == "head" else F.col("stop") - F.col("tail.stop")) <= side
        return F.when(near, F.struct(F.lit(part).alias("part"), F.col(doc).alias("d"), code.cast("long").alias("code")))

    asked = runs.filter("head is not null").select("doc_id", "run", F.explode(F.filter(F.array(
        ask(0, "head", "doc_id", 2 * F.col("head.word")), ask(1, "tail", "doc_id", 2 * F.col("tail.stop") + 1),
        ask(2, "head", "head.kept_doc_id", 2 * F.col("head.kept_word")),
        ask(3, "tail", "tail.kept_doc_id", 2 * F.col("tail.kept_stop") + 1)), lambda x: x.isNotNull())).alias("ask"))
    asked = asked.select("doc_id", "run", "ask.*")
    codes = asked.groupBy(F.col("d").alias("doc_id")).agg(F.collect_set("code").alias("codes"))  # two a word at most
    beside = (docs.join(codes, "doc_id").mapInArrow(_beside(side), "doc_id long, code long, near binary, edge binary")
              .withColumnRenamed("doc_id", "d"))
    found = asked.join(beside, ["d", "code"]).select("doc_id", "run", "part", "near", F.when(F.col("part") < 2, F.col("edge")).alias("edge"))
    both = F.struct("near", "edge")  # rows that share a doc_id: one of them
    found = found.groupBy("doc_id", "run").agg(*[F.min(F.when(F.col("part") == k, both)).alias(f"c{k}") for k in range(4)])
    found = found.select("doc_id", "run", *[F.col(f"c{k}.near").alias(f"near{k}") for k in range(4)],
                         *[F.col(f"c{k}.edge").alias(f"edge{k}") for k in range(2)])
    flat = runs.select("*", F.col("head.word").alias("head_word"), F.col("tail.stop").alias("tail_stop")).drop("head", "tail")
    return flat.join(found, ["doc_id", "run"], "left").mapInArrow(
        _extended(side), "doc_id long, word int, stop int, begin int, end int, n_units long, kept_doc_id long, "
                         "kept_anchor long")


def with_row_id(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with ``row_id`` and ``text_hash``, the pairs (row_id, id) whose row_id is not the doc_id).

    row_id is the doc_id where that names one text; the other texts of a doc_id, and rows
    without one, get a hash of both, above 2**62.
    """
    docs = docs.withColumn("text_hash", F.xxhash64("text")).withColumn("id", F.col("doc_id").cast("long"))
    several = docs.groupBy("id").agg(F.min("text_hash").alias("lo"), F.max("text_hash").alias("hi"))
    several = written(several.filter("id is not null and lo <> hi").select(F.col("id").alias("s"), "lo"))  # mostly empty
    high = F.lit(1 << 62)
    own = F.xxhash64("id", "text", F.lit(7)).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(high)
    rows = docs.join(several, F.col("id") == F.col("s"), "left").withColumn("row_id", F.when(
        F.col("id").isNull() | (F.col("text_hash") != F.col("lo")), own).otherwise(F.col("id")))
    return rows.drop("s", "lo"), rows.filter((F.col("row_id") >= high) & ~F.col("row_id").eqNullSafe(F.col("id"))).select("row_id", "id").distinct()


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, bits: int = 24) -> DataFrame:
    """(doc_id, begin, end, n_units, n_words, kept_doc_id, text_hash): spans to remove, end exclusive.

    ``n_units`` counts the repeated units and anchors in the span; ``kept_doc_id`` is the
    smallest document that keeps one of the span's anchors or, if it has none, the first unit.
    """
    rows, odd = with_row_id(docs.select("doc_id", "text"))
    spans = row_spans(rows.select(F.col("row_id").alias("doc_id"), "text"), min_words, bits)
    odd = written(odd)
    for c in ("doc_id", "kept_doc_id"):
        name = odd.select(F.col("row_id").alias("r"), F.col("id").alias("own"), F.lit(True).alias("odd"))
        spans = spans.join(name, F.col(c) == F.col("r"), "left")
        if c == "doc_id":
            spans = spans.withColumn("row", F.col(c))
        spans = spans.withColumn(c, F.when(F.col("odd"), F.col("own")).otherwise(F.col(c))).drop("r", "own", "odd")
    hashes = rows.select(F.col("row_id").alias("row"), "text_hash").distinct()
    return spans.join(hashes, "row").drop("row")


def row_spans(docs: DataFrame, min_words: int = MIN_WORDS, bits: int = 24) -> DataFrame:
    """As ``repeated_spans``, for rows whose doc_id is not null and names one text."""
    size, window = anchor_sizes(PASSAGE)
    often = (docs.select("text").mapInArrow(_digests(size, window), "h1 long, n int").repartition("h1")
             .groupBy("h1").agg(F.sum("n").alias("n")))
    often = written(often.filter("n > 1"))
    sketch = slot_sketch(often.select(F.col("h1").alias("key"), F.lit(1).alias("level")), bits)
    sent = docs.sparkSession.sparkContext.broadcast(sketch)
    rows = docs.mapInArrow(_candidates(sent, size, window), "doc_id long, word int, words int, begin int, end int, "
                                                            "h1 long, h2 long, anchor boolean")
    # at most HOT digests have a share of 1 / HOT of the repeated units and anchors; what they keep is
    # broadcast, the others meet by digest
    total = often.agg(F.sum("n")).first()[0] or 0
    hot = [r.h1 for r in often.filter(F.col("n") * HOT > total).select("h1").collect()]
    kept = F.min(F.struct("doc_id", "word"))
    if hot:
        rows = written(rows)
        often_met = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in hot], "h1 long"))
        first = rows.join(often_met, "h1", "left_semi").groupBy("h1", "h2").agg(kept.alias("kept"))
        met = rows.join(F.broadcast(first), ["h1", "h2"])
        rows = rows.join(often_met, "h1", "left_anti")
    again = rows.withColumn("kept", kept.over(Window.partitionBy("h1", "h2")))
    if hot:
        again = again.unionByName(met)
    again = (again.filter((F.col("doc_id") != F.col("kept.doc_id")) | (F.col("word") != F.col("kept.word")))
             .select("doc_id", "word", (F.col("word") + F.col("words")).alias("stop"), "begin", "end", "anchor",
                     F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.word").alias("kept_word")))
    return (_runs(_grown(docs, again, window - 1), ["doc_id"]).groupBy("doc_id", "run").agg(
        F.min("begin").cast("long").alias("begin"), F.max("end").cast("long").alias("end"), F.sum("n_units").alias("n_units"),
        (F.max("stop") - F.min("word")).cast("long").alias("n_words"),
        F.coalesce(F.min("kept_anchor"), F.min_by("kept_doc_id", F.struct("word", "kept_doc_id"))).alias("kept_doc_id"))
        .filter(F.col("n_words") >= min_words).drop("run"))


def cut(text, spans):
    """``text`` without the sorted array of spans (begin, end)."""
    piece = lambda a, b: F.substring(text, a + 1, b - a)
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"].cast("int")))
    begins = F.concat(F.transform(spans, lambda s: s["begin"].cast("int")), F.array(F.length(text)))
    return F.array_join(F.zip_with(ends, begins, piece), "")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated spans taken out of ``text``; ``n_chars``, if there, follows the text."""
    rows, _ = with_row_id(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")))
    rows = rows.select("row_id", "text", "__row")
    spans = (row_spans(rows.select(F.col("row_id").alias("doc_id"), "text"), min_words).groupBy(F.col("doc_id").alias("row_id"))
             .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("__spans")))
    out = rows.join(spans, "row_id", "left").select(*[F.col(f"__row.`{c}`").alias(c) for c in docs.columns], "__spans")
    out = out.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut(F.col("text"), F.col("__spans"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


@register("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents"))
