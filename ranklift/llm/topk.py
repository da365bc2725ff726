"""Exact top-k search by distributed histogram selection.

Vectors are turned into integers (floor(scale * x)); the score is the integer inner
product.  For a block of queries (a stated set, ``block`` at a time) every candidate is
scored in Spark tasks with one matrix product per batch, and the k-th highest score of
each query is located by refining global score histograms: each round bins the scores
inside the query's current range, Spark sums the bins, and the bin that holds the k-th
score becomes the next range, until it is one integer wide.  A last pass keeps the
scores at or above that value; ties go to the smaller vec_id.

A task sends only what can matter: bins at or above its own k-th score, and in the last
pass its own best k rows per query (score, then smaller vec_id).  The global k-th score
is never below a task's own, so nothing is lost, and a value shared by a third of all
rows costs no more than any other.  The driver holds one row per query of the block.

Defined results: vectors that are null or hold null, NaN or infinite components take no
part; vectors of another length than the query's are not its candidates; a query that
has fewer than k candidates returns all; rows with the query's vec_id are never its
candidates; of several query rows with one vec_id the smallest vector is the query;
repeated candidate rows each count; an empty table gives no rows.  Components have to
keep every inner product below 2**62 in size (an error says so otherwise).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.llm.catalog import register
from ranklift.llm.common import saved, table


def _vectors(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vec_id, integer-valued float64 matrix) for each vector length in the batch."""
    ids = batch.column("vec_id")
    vec = batch.column("embedding")
    lengths = vec.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    lengths = np.where(ids.is_valid().to_numpy(zero_copy_only=False), lengths, -1)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths[lengths >= 0]):
        at = np.flatnonzero(lengths == n)
        flat = vec.take(pa.array(at)).flatten()
        x = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(len(at), n)
        ok = np.isfinite(x).all(axis=1)
        yield ids[at[ok]], np.floor(scale * x[ok])


def _measure(scale: float):
    def run(batches):
        for b in batches:
            for ids, x in _vectors(b, scale):
                if len(ids):
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([x.shape[1]], pa.int32()),
                                                      "norm": [float(np.sqrt((x * x).sum(axis=1).max(initial=0)))]})
    return run


def _scores(q: np.ndarray, x: np.ndarray, exact_float: bool) -> np.ndarray:
    if exact_float:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _bins(blocks, scale: float, k: int, width: int, bins: int, exact_float: bool):
    """Histogram pass.  blocks: dim -> (positions, ids, vectors, range [low, high) of each query)."""
    def run(batches):
        sums = {d: np.zeros((len(b[0]), bins), np.int64) for d, b in blocks.items()}
        for batch in batches:
            for ids, x in _vectors(batch, scale):
                if x.shape[1] not in blocks:
                    continue
                _, own, q, low, high = blocks[x.shape[1]]
                for a in range(0, len(ids), 4096):
                    s = _scores(q, x[a:a + 4096], exact_float)
                    at = (s - low[:, None]) // width
                    at[(own[:, None] == ids[None, a:a + 4096]) | (s >= high[:, None])] = -1
                    row, col = np.nonzero((at >= 0) & (at < bins))
                    flat = np.bincount(row * bins + at[row, col], minlength=sums[x.shape[1]].size)
                    sums[x.shape[1]] += flat.reshape(-1, bins)
        for d, h in sums.items():
            before = h[:, ::-1].cumsum(axis=1)[:, ::-1] - h  # own scores in higher bins
            row, col = np.nonzero((h > 0) & (before < k))
            yield pa.RecordBatch.from_pydict({"q": pa.array(blocks[d][0][row], pa.int32()),
                                              "bin": pa.array(col, pa.int32()), "n": pa.array(h[row, col], pa.int64())})
    return run


def _best(ids, score, k):
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def _pick(blocks, scale: float, k: int, exact_float: bool):
    """Last pass: the task's best k rows per query at or above the query's k-th score."""
    def run(batches):
        kept = {}
        for batch in batches:
            for ids, x in _vectors(batch, scale):
                if x.shape[1] not in blocks:
                    continue
                pos, own, q, low, _ = blocks[x.shape[1]]
                for a in range(0, len(ids), 4096):
                    part = ids[a:a + 4096]
                    s = _scores(q, x[a:a + 4096], exact_float)
                    hit = (s >= low[:, None]) & (own[:, None] != part[None, :])
                    for r in np.flatnonzero(hit.any(axis=1)):
                        i, v = part[hit[r]], s[r][hit[r]]
                        if (p := pos[r]) in kept:
                            i, v = np.concatenate([kept[p][0], i]), np.concatenate([kept[p][1], v])
                        kept[p] = _best(i, v, k)
        for p, (i, v) in kept.items():
            yield pa.RecordBatch.from_pydict({"q": pa.array(np.full(len(i), p), pa.int32()),
                                              "vec_id": pa.array(i, pa.int64()), "score": pa.array(v, pa.int64())})
    return run


def _search_block(vectors: DataFrame, queries: list, norms: dict, k: int, scale: float, bins: int) -> DataFrame:
    ids = np.array([r.vec_id for r in queries], np.int64)
    low, high = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    above = np.zeros(len(ids), np.int64)
    by_dim: dict[int, list[int]] = {}
    grid = [np.floor(scale * np.array(r.embedding, np.float64)) for r in queries]
    for i, x in enumerate(grid):
        by_dim.setdefault(len(x), []).append(i)
        bound = math.ceil(math.sqrt(float((x * x).sum())) * norms.get(len(x), 0.0)) + 1
        if bound >= 2 ** 62:
            raise OverflowError("an inner product may not fit into 64 bits")
        low[i], high[i] = -bound, bound + 1
    exact_float = int(high.max()) < 2 ** 52

    def blocks():
        return {d: (np.array(at, np.int32), ids[at], np.stack([grid[i] for i in at]).reshape(len(at), d), low[at], high[at])
                for d, at in by_dim.items()}

    columns = vectors.select("vec_id", "embedding")
    while (span := int((high - low).max())) > 1:
        width = -(-span // bins)
        hist = columns.mapInArrow(_bins(blocks(), scale, k, width, bins, exact_float), "q int, bin int, n long")
        total = hist.groupBy("q", "bin").agg(F.sum("n").alias("n"))
        reach = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0))
        base = spark_array(above)
        found = (total.withColumn("reach", reach + F.element_at(base, F.col("q") + 1)).filter(F.col("reach") >= k)
                 .groupBy("q").agg(F.max(F.struct("bin", "reach", "n")).alias("m")).select("q", "m.*").collect())
        done = np.zeros(len(ids), bool)
        for r in found:  # one row for each query of the block
            done[r.q] = True
            above[r.q] = r.reach - r.n
            low[r.q] += r.bin * width
            high[r.q] = min(high[r.q], low[r.q] + width)
        high = np.where(done, high, low + 1)  # fewer than k candidates: all of them count
    rows = columns.mapInArrow(_pick(blocks(), scale, k, exact_float), "q int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return (rows.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select(F.element_at(spark_array(ids), F.col("q") + 1).alias("query_id"), "rank", "vec_id", "score"))


def spark_array(values: np.ndarray):
    return F.array(*[F.lit(int(v)) for v in values]).cast("array<bigint>")


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: float = 1024.0, bins: int = 2048,
          block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row of ``vectors`` that meets the condition ``is_query``."""
    vectors = vectors.select("vec_id", "embedding")
    norms = {r.dim: r.norm for r in vectors.mapInArrow(_measure(scale), "dim int, norm double")
             .groupBy("dim").agg(F.max("norm").alias("norm")).collect()}
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < float("inf")))
    queries = vectors.filter(is_query & usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    found, last = [], None
    while True:
        rest = queries if last is None else queries.filter(F.col("vec_id") > last)
        part = rest.orderBy("vec_id").limit(block).collect()  # at most ``block`` rows
        if part:
            last = part[-1].vec_id
            found.append(saved(_search_block(vectors, part, norms, k, scale, bins)))
        if len(part) < block:
            break
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, found)


SQL = """
WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
WHERE rank <= 10
"""


@register("op2_exact_topk", SQL)
def op2_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
