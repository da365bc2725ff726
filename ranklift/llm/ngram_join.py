"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set holds its distinct 5-word shingles (64-bit hashes).  Documents with
equal sets form a class, found by a 128-bit digest, and one class takes part once.

Tokens are ordered by document frequency class, rarest first, and by a mixer of the
token inside a class; each mixer gives another global order.  Two sets of Jaccard
similarity t share a token in their prefixes (the first n - ceil(t n) + 1 tokens) under
every such order.  Tokens that occur once in the corpus are first in all orders and match
nothing, so they fill the prefixes of ordinary documents and are not sent anywhere; only
documents whose prefix under each order holds a repeated token remain.  Frequencies are
counted over all documents; the classes travel as a byte array of fixed size (``bits``),
where a slot shared by tokens shows the highest class: that can only add candidates.

Candidates are verified on the whole sets.  Rounds of star-shaped candidates (each
document with the centre it shares most prefix tokens with) join large groups of near
copies without forming all pairs; then every pair that shares prefix tokens under all
orders and is still in two components is verified, so no link between components is lost.
That last step leaves out the commonest tokens that a pair must share anyway
(``_across``), so heavily edited copies of one text hardly form pairs.

Defined results: null text and text without words has an empty set and links with
nothing; fewer than 5 words are one shingle; repeated rows are members of one class and
each gets a row; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import components, saved, slot_sketch, table
from ranklift.llm.words import mix, shingle_sets, word_slices

#: Hashes of tokens are cut to this many bits above log2(tokens) for counting.
SPARE_BITS = 13


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _count_tokens(size: int, keep: int):
    """(tok, n) over slices of the texts; tok is the token's hash cut to ``keep`` bits."""
    mask = np.uint64((1 << keep) - 1)

    def run(batches):
        for b in batches:
            for _, _, w in word_slices(b.column("text")):
                sets = list(shingle_sets(w, size))
                tok, n = np.unique(np.concatenate(sets) & mask, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tok.view(np.int64)), pa.array(n.astype(np.int32))],
                                                 names=["tok", "n"])
    return run


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(size: int, percent: int, orders: int, sketch):
    """(doc_id, node, n, order columns): the set's digest and size, and the repeated tokens of each prefix."""
    def run(batches):
        level = sketch.value
        mask = np.uint64(len(level) - 1)
        for b in batches:
            ids = b.column("doc_id")
            for at, rows, w in word_slices(b.column("text")):
                node, count, found = [], [], [[] for _ in range(orders)]
                for s in shingle_sets(w, size):
                    node.append(_digest(s))
                    count.append(len(s))
                    own = level[s & mask] if len(s) else np.empty(0, np.uint8)
                    p = prefix_length(len(s), percent)
                    alone = int((own == 0).sum())
                    for k in range(orders):
                        if not len(s) or alone >= p:
                            found[k].append(b"")
                            continue
                        rest = np.flatnonzero(own)  # the prefix: all tokens seen once, then these
                        rest = rest[np.lexsort((mix(s[rest], 10 + k), own[rest]))[:p - alone]]
                        found[k].append(s[rest].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, rows), pa.array(node, pa.binary()), pa.array(count, pa.int64()),
                     *[pa.array([np.frombuffer(x, np.int64) for x in f], pa.list_(pa.int64())) for f in found]],
                    names=["doc_id", "node", "n", *[f"p{k}" for k in range(orders)]])
    return run


def _sets(size: int, wanted):
    """(node, tokens) of the documents whose id falls into a wanted slot."""
    def run(batches):
        slots = wanted.value
        mask = np.uint64(len(slots) - 1)
        for b in batches:
            ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            keep = pa.array(slots[mix(ids, 1) & mask] > 0)
            for _, _, w in word_slices(b.column("text").filter(keep)):
                sets = [s for s in shingle_sets(w, size) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s) for s in sets], pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "tokens"])
    return run


def _slot_keys(batches):
    """Slot keys of document ids, as ``_sets`` computes them."""
    for b in batches:
        ids = b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(mix(ids, 1).view(np.int64)), pa.array(np.ones(len(ids), np.int32))],
                                         names=["key", "level"])


def _verify(percent: int):
    def run(batches):
        for b in batches:
            ta, tb = b.column("ta"), b.column("tb")
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = (t[i].values.to_numpy() for t in (ta, tb))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield b.select(["a", "b"]).filter(pa.array(ok))
    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    withs = (pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a")
             .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b"))
    return saved(withs.select("a", "b", "ta", "tb").mapInArrow(_verify(percent), "a binary, b binary"))


def _comparable(x: str, y: str, percent: int):
    """Sizes that allow the similarity."""
    return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows (tok, node, ...) whose token occurs in two nodes at least, with that number as ``df``."""
    df = rows.groupBy("tok").agg(F.count("*").alias("df")).filter("df > 1")
    return rows.join(df, "tok")


def links(docs: DataFrame, size: int = 5, percent: int = 80, orders: int = 3, bits: int = 24,
          star_rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """(members, component edges): rows (doc_id, node, n), and verified links (a, b) between nodes.

    Links found suffice to connect every component of the full link graph.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0  # at least as many as there are tokens
    keep = min(63, max(bits, int(total).bit_length() + SPARE_BITS))

    counts = docs.select("text").mapInArrow(_count_tokens(size, keep), "tok long, n int").repartition("tok")
    often = counts.groupBy("tok").agg(F.sum("n").alias("n")).filter("n > 1")
    level = sc.broadcast(slot_sketch(often.select(F.col("tok").alias("key"), F.least(
        F.floor(F.log2("n")), F.lit(255)).cast("int").alias("level")), bits))

    found = [f"p{k}" for k in range(orders)]
    marks = saved(docs.mapInArrow(_prefixes(size, percent, orders, level), "doc_id long, node binary, n long, " + ", ".join(
        f"{p} array<bigint>" for p in found)))
    members = marks.select("doc_id", "node", "n")

    # one row for each class that has repeated prefix tokens
    classes = (marks.filter(F.size(found[0]) > 0).groupBy("node")
               .agg(F.min(F.struct("doc_id", "n", *found)).alias("r")).select("node", "r.*"))
    rows, live = [], None
    for p in found:  # a document has to share a prefix token under every order
        at = classes if live is None else classes.join(live, "node", "left_semi")
        shared = saved(_repeated(at.select("node", "n", F.explode(p).alias("tok"))))
        live = shared.select("node").distinct()
        rows.append(shared)
    live = saved(live)
    classes = saved(classes.join(live, "node", "left_semi"))
    group = rows[0].join(live, "node", "left_semi")

    wanted = slot_sketch(classes.select("doc_id").mapInArrow(_slot_keys, "key long, level int"), bits)
    sets = saved(docs.mapInArrow(_sets(size, sc.broadcast(wanted)), "node binary, tokens array<bigint>")
                 .join(live, "node", "left_semi").dropDuplicates(["node"]))

    weight = group.groupBy("node").agg(F.sum("df").alias("weight"))
    group = saved(group.join(weight, "node").select("tok", "node", "n", "df", "weight"))
    verified, tried, comp = [], None, None
    for _ in range(star_rounds):
        here = group if comp is None else _open(group, comp)
        star = _star(here, percent, comp is not None)
        if tried is not None:
            star = star.join(tried, ["a", "b"], "left_anti")
        best = Window.partitionBy("a").orderBy(F.desc("shared"), "b")
        pairs = saved(star.withColumn("r", F.row_number().over(best)).filter("r = 1").select("a", "b"))
        verified.append(_linked(pairs, sets, percent))
        tried = pairs if tried is None else tried.union(pairs)
        comp = components(reduce(DataFrame.union, verified))
    here = _open(group, comp)
    pairs = _across(here, percent).join(tried, ["a", "b"], "left_anti")
    for k in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(k), *[F.col(p).alias(p + k) for p in found]), k)
    for p in found:  # intersect the filters of all orders
        pairs = pairs.filter(F.size(F.array_intersect(p + "a", p + "b")) >= F.col("least"))
    verified.append(_linked(saved(pairs.select("a", "b")), sets, percent))
    return members, reduce(DataFrame.union, verified)


def _open(group: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of tokens whose documents are in two components at least, with ``component``."""
    named = group.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    many = named.groupBy("tok").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    return saved(named.join(many.filter("lo <> hi").select("tok"), "tok", "left_semi"))


def _star(group: DataFrame, percent: int, parted: bool) -> DataFrame:
    """(a, b, shared): each document a with the centres b of its tokens' groups."""
    more = ["component"] if parted else []
    top = group.groupBy("tok").agg(F.max(F.struct("weight", "node", "n", *more)).alias("c"))
    pairs = group.join(top, "tok").filter((F.col("node") != F.col("c.node")) & _comparable("n", "c.n", percent))
    if parted:
        pairs = pairs.filter(F.col("component") != F.col("c.component"))
    return pairs.groupBy(F.col("node").alias("a"), F.col("c.node").alias("b")).agg(F.count("*").alias("shared"))


def _across(group: DataFrame, percent: int) -> DataFrame:
    """Comparable pairs (a, b, least) in two components that may share enough (``least``) prefix tokens.

    With n_a - p_a tokens behind the prefix that ends first, two sets that overlap in o
    tokens share at least c = o - max(n - p) tokens of their prefixes.  Each document
    ranks its tokens by the group's size; a shared token that is the c-th or a later one
    of those the two share has rank c or more in both, so the c - 1 top ranks are left out.
    """
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("df"), "tok"))
    behind = F.ceil(F.col("n") * percent / 100) - 1
    group = saved(group.select("tok", "node", "n", "component", rank.alias("rank"), behind.alias("behind")))
    x, y = (group.select("tok", *[F.col(c).alias(c + k) for c in group.columns[1:]]) for k in "xy")
    least = F.ceil((F.col("nx") + F.col("ny")) * percent / (100 + percent)) - F.greatest("behindx", "behindy")
    return (x.join(y, "tok").filter((F.col("nodex") < F.col("nodey")) & (F.col("componentx") != F.col("componenty"))
                                    & _comparable("nx", "ny", percent) & (F.least("rankx", "ranky") >= least))
            .select(F.col("nodex").alias("a"), F.col("nodey").alias("b"), F.greatest(F.lit(1), least).alias("least")).distinct())


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    members, edges = links(docs, size, percent)
    comp = components(edges)
    first = (members.groupBy("node").agg(F.min("doc_id").alias("first")).join(comp, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    name = first.groupBy("component").agg(F.min("first").alias("component_id"))
    named = first.join(name, "component").select("node", "component_id")
    return members.join(named, "node").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with the columns of ``docs``: that with the smallest doc_id (null last).

    Rows are told apart by a hash of doc_id and text, which also decides between rows with
    one doc_id.  A text without words is in no component: it stays, once for each doc_id and text.
    """
    rows = docs.withColumn("__key", F.xxhash64("doc_id", "text"))
    named = near_duplicates(rows.select(F.col("__key").alias("doc_id"), "text"), size, percent)
    named = named.select(F.col("doc_id").alias("__key"), "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key"))
    kept = (rows.select("__key", "doc_id").join(named, "__key").groupBy("component_id").agg(first.alias("first"))
            .select(F.col("first.__key").alias("__key")))
    return (rows.join(kept, "__key", "left_semi").dropDuplicates(["__key"])
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


@register("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
