"""Prefix trie over rebuilt conversations, by composable fingerprints.

A conversation c is rebuilt from a head, the first h(c) turns of its base conversation, and
its own turns after its first h(c).  The rebuilt sequences are never put together.  A turn
is the map x -> B x + t over the integers modulo the prime 2**127 - 1, where t comes from
the turn's SHA-256; a sequence is the product of its turns' maps, applied to 1.  Such
products compose: with H the prefix products of stored turns, the fingerprint of the head
and the own turns up to the k-th is

    H_own[k] + (H_base[m] - H_own[h]) * B ** (k - h)

with m the number of head turns there are.  The parent's fingerprint is (f - t) / B.

Conversations with one fingerprint form a prefix group, a node.  A group is checked
through the references of its members' last turns, the other half of the turns' SHA-256:
if they agree in every group, then by induction along the parents all members of a group
have equal turns.  A group that fails has the run repeated with another B.

Prefix products are taken along a global order cut into ranges, so a conversation may be
spread over many tasks; two rows for each range reach the driver.  Sums over subtrees need
no walk: a node belongs to its smallest member, whose nodes are a path down to its end,
and a subtree is the rest of that path and the paths that leave it.

Defined results: turns of one conversation are ordered by (turn with null first, role,
text); repeated rows are turns of their own; null role and null text are empty; rows
without a conv_id belong to no conversation; for a negative id, c % 5 is negative or 0, as
in Spark and DuckDB; a conversation may have no turns at all after rebuilding and is then
a member of the root alone; further columns are ignored; an empty table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import table, written

PRIME = (1 << 127) - 1
#: Depths and ids are summed and listed in blocks of so many, so that no task holds a whole path or list.
DEPTH_BITS, ID_BLOCK = 12, 1 << 16
_LOW = (1 << 64) - 1


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % 9


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def _ints(high: pa.Array, low: pa.Array) -> list[int]:
    return [(h << 64) | (x & _LOW) for h, x in zip(high.to_pylist(), low.to_pylist(), strict=True)]


def _halves(values: list[int]) -> list[pa.Array]:
    return [pa.array([v >> 64 for v in values], pa.int64()),
            pa.array(np.array([v & _LOW for v in values], np.uint64).view(np.int64))]


def _products(base: int):
    """(conv_id, pid, k, H, t, r, bytes) of rows in order: prefix products within a range and conversation."""
    def run(batches):
        pid, conv, k, h = TaskContext.get().partitionId(), None, 0, 1
        for b in batches:
            refs = b.column("ref").to_pylist()
            ks, hs = [], []
            ts = [int.from_bytes(r[:16], "big") % PRIME for r in refs]
            for c, t in zip(b.column("conv_id").to_pylist(), ts, strict=True):
                if c != conv:
                    conv, k, h = c, 0, 1
                k, h = k + 1, (h * base + t) % PRIME
                ks.append(k)
                hs.append(h)
            rest = np.frombuffer(b"".join(r[16:] for r in refs), ">i8").astype(np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(np.full(len(ks), pid)), pa.array(ks, pa.int64()), *_halves(hs), *_halves(ts),
                 pa.array(rest[:, 0].copy()), pa.array(rest[:, 1].copy()), b.column("bytes")],
                names=["conv_id", "pid", "k", "h1", "h2", "t1", "t2", "r1", "r2", "bytes"])
    return run


_TURN = "conv_id long, pid long, k long, h1 long, h2 long, t1 long, t2 long, r1 long, r2 long, bytes long"


def _continue(base: int, sent):
    """``k`` and ``H`` of the conversation, for rows of a range that goes on with one begun in an earlier range."""
    def run(batches):
        before = sent.value
        for b in batches:
            ks, hs = b.column("k").to_pylist(), _ints(b.column("h1"), b.column("h2"))
            for i, at in enumerate(zip(b.column("pid").to_pylist(), b.column("conv_id").to_pylist(), strict=True)):
                if at in before:
                    n, start = before[at]
                    hs[i] = (hs[i] + (start - 1) * pow(base, ks[i], PRIME)) % PRIME
                    ks[i] += n
            out = {n: b.column(n) for n in b.schema.names}
            out["k"] = pa.array(ks, pa.int64())
            out["h1"], out["h2"] = _halves(hs)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    return run


def stored_turns(turns: DataFrame, base: int) -> DataFrame:
    """Every turn's place k (from 1) in its conversation, prefix product, value and reference; no text."""
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role"]
    ref = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    rows = (rows.repartitionByRange(*order, F.left("text", F.lit(64))).sortWithinPartitions(*order, "text")
            .select("conv_id", ref.alias("ref"), F.octet_length("text").cast("long").alias("bytes")))
    parts = written(rows.mapInArrow(_products(base), _TURN), "turns")
    last = F.max(F.struct("k", "h1", "h2")).alias("s")
    crossing = (parts.groupBy("conv_id", "pid").agg(last).groupBy("conv_id")
                .agg(F.array_sort(F.collect_list(F.struct("pid", "s"))).alias("parts")).filter(F.size("parts") > 1))
    before = {}
    for r in crossing.toLocalIterator():  # a range has one such conversation at its start and one at its end
        n, start = 0, 1
        for pid, (k, h1, h2) in r.parts:
            before[pid, r.conv_id] = (n, start)
            n, start = n + k, (((h1 << 64) | (h2 & _LOW)) + (start - 1) * pow(base, k, PRIME)) % PRIME
    before = {at: x for at, x in before.items() if x[0]}
    return parts.mapInArrow(_continue(base, turns.sparkSession.sparkContext.broadcast(before)), _TURN).drop("pid")


def _rebuilt(base: int):
    """(conv_id, depth, node, parent, reference, bytes, last) from stored products and the products at the joint."""
    inverse = pow(base, -1, PRIME)

    def run(batches):
        for b in batches:
            own, t = _ints(b.column("h1"), b.column("h2")), _ints(b.column("t1"), b.column("t2"))
            head, gone = _ints(b.column("b1"), b.column("b2")), _ints(b.column("c1"), b.column("c2"))
            node = [(x + (y - z) * pow(base, e, PRIME)) % PRIME if y != z else x for x, y, z, e in
                    zip(own, head, gone, b.column("after").to_pylist(), strict=True)]
            parent = [(f - x) * inverse % PRIME for f, x in zip(node, t, strict=True)]
            keep = [b.column(c) for c in ("r1", "r2", "bytes", "last")]
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("depth"), *_halves(node), *_halves(parent), *keep],
                names=["conv_id", "depth", "n1", "n2", "p1", "p2", "r1", "r2", "bytes", "last"])
    return run


_MEMBER = ("conv_id long, depth long, n1 long, n2 long, p1 long, p2 long, r1 long, r2 long, bytes long, last boolean")


def members(turns: DataFrame, base: int) -> DataFrame:
    """One row for every conversation and depth of its rebuilt sequence, the root included."""
    stored = stored_turns(turns, base)
    first = F.when(F.col("k") <= 8, F.struct("k", "h1", "h2", "t1", "t2", "r1", "r2", "bytes"))
    conv = written(stored.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(first)).alias("first"))
                   .withColumn("h", head_length(F.col("conv_id"))), "heads")
    one = F.struct(F.lit(0).cast("long").alias("x"), F.lit(1).cast("long").alias("y"))
    at = lambda arr, k, x, y: F.coalesce(F.try_element_at(arr, k.cast("int"))[x], one[y])
    joint = (conv.withColumn("base", base_of(F.col("conv_id")))
             .join(conv.select(F.col("conv_id").alias("base"), F.col("first").alias("lent")), "base", "left")
             .withColumn("head", F.coalesce(F.slice("lent", F.lit(1), F.col("h").cast("int")),
                                            F.array().cast(conv.schema["first"].dataType)))
             .withColumn("m", F.size("head").cast("long"))
             .withColumn("total", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))))
    end = lambda half, arr, k: F.when(k == 0, one["x" if half == 1 else "y"]).otherwise(
        F.try_element_at(arr, F.greatest(k, F.lit(1)).cast("int"))[f"h{half}"])
    took = F.least("h", "n")
    joint = written(joint.select("conv_id", "h", "m", "total", "head", *[
        end(i, F.col("head"), F.col("m")).alias(f"b{i}") for i in (1, 2)], *[
        end(i, F.col("first"), took).alias(f"c{i}") for i in (1, 2)]), "joints")
    cols = ["conv_id", "depth", "h1", "h2", "t1", "t2", "r1", "r2", "bytes", "b1", "b2", "c1", "c2", "after", "last"]
    zero = F.lit(0).cast("long")
    heads = joint.select("conv_id", "total", F.explode("head").alias("s")).select(
        "conv_id", F.col("s.k").alias("depth"), *[F.col(f"s.{c}").alias(c) for c in cols[2:9]],
        *[zero.alias(c) for c in cols[9:14]], (F.col("s.k") == F.col("total")).alias("last"))
    tails = (stored.join(joint.drop("head"), "conv_id").filter(F.col("k") > F.col("h"))
             .withColumn("after", F.col("k") - F.col("h")).withColumn("depth", F.col("m") + F.col("after"))
             .withColumn("last", F.col("depth") == F.col("total")).select(*cols))
    roots = joint.select("conv_id", zero.alias("depth"), zero.alias("n1"), F.lit(1).cast("long").alias("n2"),
                         *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")],
                         *[zero.alias(c) for c in ("r1", "r2", "bytes")], (F.col("total") == 0).alias("last"))
    return written(heads.unionByName(tails).mapInArrow(_rebuilt(base), _MEMBER).unionByName(roots), "members")


def _digest(batches):
    """(n1, n2, ends_sha256) from ascending blocks of ids, fed to the hash as they come."""
    at, h = None, None
    for b in batches:
        out = []
        for n1, n2, ids in zip(*(b.column(c).to_pylist() for c in ("n1", "n2", "ids")), strict=True):
            if (n1, n2) != at:
                if at:
                    out.append((*at, h.hexdigest()))
                at, h = (n1, n2), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield _digests(out)
    if at:
        yield _digests([(*at, h.hexdigest())])


def _digests(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
        (pa.int64(), pa.int64(), pa.string()))], names=["n1", "n2", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of the nodes where conversations end.

    SHA-256 takes its input in order, so one task reads a node's list; it comes as ready
    blocks of text, sorted by Spark, of which the task holds a batch at a time.
    """
    block = F.floor(F.col("conv_id") / ID_BLOCK).alias("block")
    lists = rows.filter("last").groupBy("n1", "n2", block).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return (lists.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "block")
            .select("n1", "n2", "ids").mapInArrow(_digest, "n1 long, n2 long, ends_sha256 string"))


def _nodes(rows: DataFrame) -> DataFrame:
    """One row a node; ``whole`` says that its members agree in depth, parent and last turn."""
    pairs = ("depth", "p1", "p2", "r1", "r2")
    same = [F.coalesce(F.col(c) == F.col(f"{c}_"), F.col(c).isNull()) for c in pairs]
    whole = same[0]
    for s in same[1:]:
        whole = whole & s
    return (rows.groupBy("n1", "n2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"),
                                         *[F.min(c).alias(c) for c in pairs], *[F.max(c).alias(f"{c}_") for c in pairs])
            .withColumn("whole", whole).drop(*[f"{c}_" for c in pairs], "r1", "r2"))


def _below(nodes: DataFrame, rows: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sums of ``values`` over subtrees, in two parts by node: along the own path, and from paths that leave it."""
    block = nodes.withColumn("block", F.shiftright("depth", DEPTH_BITS))
    inner = Window.partitionBy("conv_id", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    deeper = (block.groupBy("conv_id", "block").agg(*[F.sum(v).alias(v) for v in values])
              .select("conv_id", "block", *[F.sum(v).over(outer).alias(f"deeper_{v}") for v in values])
              .filter(f"deeper_{values[0]} is not null"))  # only of paths longer than a block
    path = (block.withColumns({f"in_{v}": F.sum(v).over(inner) for v in values}).join(deeper, ["conv_id", "block"], "left")
            .select("n1", "n2", *[(F.col(f"in_{v}") + F.coalesce(f"deeper_{v}", F.lit(0))).alias(f"own_{v}") for v in values]))
    whole = nodes.groupBy("conv_id").agg(F.min("depth").alias("from"), *[F.sum(v).alias(v) for v in values])
    left = (rows.select("conv_id", "depth", "n1", "n2").join(whole, "conv_id").filter(F.col("depth") < F.col("from"))
            .groupBy("n1", "n2").agg(*[F.sum(v).alias(f"off_{v}") for v in values]))
    return path, left


def prefix_trie(turns: DataFrame, tries: int = 8) -> DataFrame:
    """One row for each node of the trie over the rebuilt conversations."""
    for k in range(tries):
        base = int.from_bytes(hashlib.sha256(f"prefix trie {k}".encode()).digest(), "big") % PRIME
        rows = members(turns, base)
        nodes = written(_nodes(rows), "nodes")
        if not nodes.filter(~F.col("whole")).limit(1).count():
            break
    else:
        raise RuntimeError("no base tells all prefixes apart")
    children = nodes.filter("p1 is not null").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, ["n1", "n2"], "left").select(
        "n1", "n2", "p1", "p2", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf")), "nodes")
    path, left = _below(nodes, rows, ["saved", "leaf"])
    up = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    total = lambda v: (F.col(f"own_{v}") + F.coalesce(f"off_{v}", F.lit(0))).cast("long")
    return (nodes.join(path, ["n1", "n2"]).join(left, ["n1", "n2"], "left").join(ends(rows), ["n1", "n2"], "left")
            .join(up, ["p1", "p2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", total("leaf").alias("n_leaves"),
                    total("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT b::UBIGINT AS b, b AS v0 FROM range(256) r(b)),
c8 AS (
  WITH RECURSIVE s AS (SELECT b, b AS v, 0 AS i FROM bits
    UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, i + 1 FROM s WHERE i < 8)
  SELECT list(v ORDER BY b) AS tab FROM s WHERE i = 8),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t),
crc AS (
  WITH RECURSIVE w AS (SELECT conv_id, s, 1 AS i, 4294967295::UBIGINT AS v FROM ids
    UNION ALL SELECT conv_id, s, i + 1, xor(v >> 8, tab[1 + (xor(v, ascii(s[i])::UBIGINT) & 255)::BIGINT])
    FROM w, c8 WHERE i <= length(s))
  SELECT conv_id, (xor(v, 4294967295::UBIGINT) % 9)::BIGINT AS h FROM w WHERE i = length(s) + 1),
seq AS (
  SELECT c.conv_id, t.k AS d, t.role, t.text FROM crc c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.k <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, (SELECT count(*) FROM t b WHERE b.conv_id = c.conv_id - c.conv_id % 5)) + t.k - c.h, t.role, t.text
  FROM crc c JOIN t ON t.conv_id = c.conv_id AND t.k > c.h),
full_ AS (
  SELECT ids.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY d) FILTER (d IS NOT NULL), []) AS p,
         coalesce(list(strlen(text) ORDER BY d) FILTER (d IS NOT NULL), []) AS b
  FROM ids LEFT JOIN seq USING (conv_id) GROUP BY ids.conv_id),
m AS (SELECT conv_id, d, p[1:d] AS node, CASE WHEN d > 0 THEN p[1:d - 1] END AS parent, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes, d = len(p) AS fin
      FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM full_)),
n AS (SELECT node, d AS depth, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs,
             (count(*) - 1) * max(bytes) AS val,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (fin), '')) AS ends_sha256
      FROM m GROUP BY node, d),
ch AS (SELECT parent AS node, count(*) AS n FROM n WHERE parent IS NOT NULL GROUP BY parent),
up AS (SELECT v.node[1:a] AS node, sum(v.val) AS saved, count(*) FILTER (ch.n IS NULL) AS leaves
       FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM n) v LEFT JOIN ch ON ch.node = v.node GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(ch.n, 0)::BIGINT AS n_children,
       up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN up ON up.node = n.node LEFT JOIN ch ON ch.node = n.node LEFT JOIN n q ON q.node = n.parent
"""


@register("op11_prefix_trie", SQL)
def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
