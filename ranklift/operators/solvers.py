"""Solvers over sparse rows that are packed in blocks (M2, M5, M6).

A solver passes over its rows many times.  They are packed once into blocks, rows of Parquet that
numpy reads without unpacking; a pass is one Spark job that adds up one array a task.  The
driver holds the parameters and these sums, never a row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklift.session import scratch, settings

DIRECT = 2048        # weights up to which Newton steps take the whole matrix of second derivatives
WIDE = 256           # of more weights only those that some rows hold are multiplied
DIRECT_SUM = 1 << 15  # numbers that every task may send to the driver; longer arrays are added up by Spark, in pieces
ROWS = 2048          # rows of a block
#: A block has megabytes; readers hold a few at once, not the thousands that they hold of short rows.
FEW = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


# blocks ----------------------------------------------------------------------
def vector_parts(rows: DataFrame, features: str) -> Column:
    """A struct that holds ``indices`` and ``values``: the column itself, or what an MLlib vector is made of."""
    return F.col(features) if dict(rows.dtypes)[features].startswith("struct") else F.unwrap_udt(features)


def width(rows: DataFrame, features: str) -> int:
    """Length of the vectors; a struct column has it in its metadata."""
    if "size" in (meta := rows.schema[features].metadata):
        return meta["size"]
    v = F.unwrap_udt(features)
    one = rows.select(F.coalesce(v["size"], F.size(v["values"])).alias("n")).first()
    if one is None:
        raise ValueError("no training rows")
    return one.n


def entries(v: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of entries, indices, values) of all rows; dense vectors have no list of indices."""
    parts = dict(zip([f.name for f in v.type], v.flatten(), strict=True))
    n = pc.list_value_length(parts["values"]).to_numpy(zero_copy_only=False).astype(np.int64)
    values = parts["values"].flatten().to_numpy(zero_copy_only=False)
    indices = parts["indices"].flatten().to_numpy(zero_copy_only=False)
    if len(indices) < len(values):
        dense = np.repeat(pc.is_null(parts["indices"]).to_numpy(zero_copy_only=False), n)
        some, indices = indices, (np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        indices[~dense] = some
    return n, indices, values


def packed(rows: DataFrame, features: str, label: str | None = None) -> DataFrame:
    """(y, n, indices, values): blocks of rows; ``label`` has to be 0 or 1."""
    y = F.col(label).cast("double") if label else F.lit(0.0)

    def run(batches):
        for b in batches:
            if b.num_rows:
                n, indices, values = entries(b.column("v"))
                y = b.column("y").to_numpy(zero_copy_only=False)
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1")
                if not np.isfinite(values).all():
                    raise ValueError("features must be finite numbers")
                ends = np.concatenate([[0], np.cumsum(n)])
                for at in range(0, len(y), ROWS):
                    part = slice(ends[at], ends[min(at + ROWS, len(y))])
                    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                        y[at:at + ROWS].astype(np.int8), n[at:at + ROWS].astype(np.int32), indices[part].astype(np.int32), values[part].astype(float))],
                        names=["y", "n", "indices", "values"])

    return rows.select(y.alias("y"), vector_parts(rows, features).alias("v")).mapInArrow(
        run, "y binary, n binary, indices binary, values binary")


def _blocks(batch: pa.RecordBatch):
    """(y, row of every entry, indices, values) of each block."""
    for i in range(batch.num_rows):
        y, n, indices, values = (np.frombuffer(batch.column(k)[i].as_buffer(), t) for k, t in enumerate((np.int8, np.int32, np.int32, float)))
        yield y.astype(float), np.repeat(np.arange(len(y)), n), indices, values


def dense(rows: int, wide: int, row: np.ndarray, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Entries as a matrix; entries of one place are added up."""
    return np.bincount(row * wide + indices, weights=values, minlength=rows * wide).reshape(rows, wide)


def summed(blocks: DataFrame, of_rows: Callable[..., np.ndarray], size: int) -> np.ndarray:
    """Sum of the arrays of ``size`` numbers that ``of_rows`` makes of (y, row, indices, values)."""
    def run(batches):
        total = None
        for batch in batches:
            for rows in _blocks(batch):
                x = of_rows(*rows)
                total = x if total is None else total + x
        if total is not None:
            pieces = [total[i:i + DIRECT_SUM] for i in range(0, size, DIRECT_SUM)]
            for k, x in enumerate(pieces):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))], names=["k", "x"])

    parts = blocks.mapInArrow(run, "k int, x array<double>")
    if size > DIRECT_SUM:
        parts = parts.groupBy("k").agg(Summarizer.sum(array_to_vector("x")).alias("x")).select("k", vector_to_array("x").alias("x"))
    out = np.zeros(size)
    with settings(blocks.sparkSession, FEW):
        sums = parts.toArrow()
    for batch in sums.to_batches():
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = x.values.to_numpy(zero_copy_only=False)
            out[k * DIRECT_SUM:k * DIRECT_SUM + len(x)] += x
    return out


# logistic regression ---------------------------------------------------------
def sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1.0, e) / (1.0 + e)


@dataclass(frozen=True)
class Logistic:
    weights: np.ndarray
    intercept: float
    steps: int = 0

    def transform(self, rows: DataFrame, features: str, out: str = "p") -> DataFrame:
        """``rows`` with the probability of 1."""
        weights, intercept = self.weights, self.intercept

        @F.arrow_udf("double")
        def prob(v: pa.Array) -> pa.Array:
            n, indices, values = entries(v)
            z = np.bincount(np.repeat(np.arange(len(n)), n), weights=values * weights[indices], minlength=len(n))
            return pa.array(sigmoid(z + intercept))

        return rows.withColumn(out, prob(vector_parts(rows, features)))


def _margins(w, y, row, indices, values):
    return np.bincount(row, weights=values * w[indices], minlength=len(y)) + w[-1]


def _first(w, y, row, indices, values):
    """(probabilities, [loss, gradient])."""
    z = _margins(w, y, row, indices, values)
    p = sigmoid(z)
    loss = np.sum(np.maximum(z, 0) - y * z + np.log1p(np.exp(-np.abs(z))))
    return p, np.concatenate([[loss], np.bincount(indices, weights=values * (p - y)[row], minlength=len(w) - 1), [np.sum(p - y)]])


def fit_logistic(train: DataFrame, features: str, label: str = "y", penalty: float = 1.0, max_iter: int = 2000, tol: float = 1e-10) -> Logistic:
    """Least sum of log losses plus penalty / 2 times the squared weights (not the intercept), by Newton's method.

    The minimum is the one that L-BFGS approaches; a Newton step is one pass over the rows, and a
    handful suffice.  It ends when the next step would lower the objective by less than ``tol`` of it.
    More than ``DIRECT`` weights are fitted by L-BFGS, each of whose steps is a pass.
    """
    d = width(train, features)
    with scratch(packed(train, features, label), "blocks") as blocks:
        n, pos = summed(blocks, lambda y, *_: np.array([len(y), y.sum()]), 2)
        if not n:
            raise ValueError("no training rows")
        if pos in (0, n):  # nothing to tell apart
            return Logistic(np.zeros(d), np.inf if pos else -np.inf)
        ridge = np.append(np.full(d, float(penalty)), 0.0)
        w, old, step, size, k = np.append(np.zeros(d), np.log(pos / (n - pos))), None, None, 1.0, 0
        if d > DIRECT:
            def fun(at):
                out = summed(blocks, lambda *rows: _first(at, *rows)[1], d + 2)
                return (out[0] + 0.5 * np.sum(ridge * at * at)) / n, (out[1:] + ridge * at) / n

            w = lbfgs(fun, w, max_iter)
            return Logistic(w[:-1].copy(), float(w[-1]))
        for k in range(max_iter):
            loss, grad, second = _derivatives(blocks, w)
            value = loss + 0.5 * np.sum(ridge * w * w)
            if old is not None and not value <= old[0] + 1e-9 * abs(old[0]):  # too far: half of the way
                size /= 2
                if size < 1e-6:
                    w = old[1]
                    break
                w = old[1] + size * step
                continue
            old, size, grad = (value, w), 1.0, grad + ridge * w
            step = -np.linalg.solve(second + np.diag(ridge + 1e-12 * np.trace(second) / len(w)), grad)
            if -(step @ grad) / 2 <= tol * abs(value):
                break
            w = w + step
    return Logistic(w[:-1].copy(), float(w[-1]), k + 1)


def _derivatives(blocks: DataFrame, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient, second derivatives)."""
    m = len(w)

    def of_rows(y, row, indices, values):
        p, first = _first(w, y, row, indices, values)
        root, second = np.sqrt(p * (1 - p)), np.zeros((m, m))
        each = len(y) if m <= WIDE else 256
        for i in range(0, len(y), each):
            lo, hi = np.searchsorted(row, [i, i + each])
            n = min(each, len(y) - i)
            some, inside = (np.arange(m - 1), indices[lo:hi]) if m <= WIDE else np.unique(indices[lo:hi], return_inverse=True)
            x = np.empty((n, len(some) + 1))
            x[:, :-1] = dense(n, len(some), row[lo:hi] - i, inside, values[lo:hi] * root[row[lo:hi]])
            x[:, -1] = root[i:i + n]
            at = np.append(some, m - 1)
            second[at[:, None], at] += x.T @ x
        return np.concatenate([first, second.ravel()])

    out = summed(blocks, of_rows, 1 + m + m * m)
    return out[0], out[1:m + 1], out[m + 1:].reshape(m, m)


# one hidden layer ------------------------------------------------------------
def lbfgs(fun: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> np.ndarray:
    """Minimum of a smooth function; ends when the last 20 values lie within ``tol`` of the first one."""
    f, g = fun(x)
    values, pairs = [f], []
    for _ in range(max_iter):
        q, alphas = g.copy(), []
        for s, y in reversed(pairs):
            alphas.append((s @ q) / (s @ y))
            q -= alphas[-1] * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(alphas), strict=True):
            q += (a - (y @ q) / (s @ y)) * s
        slope, size = -(g @ q), 1.0 if pairs else min(1.0, 1.0 / max(np.linalg.norm(g), 1e-300))
        if slope >= 0:
            break
        for _ in range(30):
            new = x - size * q
            f_new, g_new = fun(new)
            if f_new <= f + 1e-4 * size * slope:
                break
            size *= min(0.5, max(0.1, -slope * size / (2 * (f_new - f - slope * size)))) if np.isfinite(f_new) else 0.1
        else:
            break
        s, y = new - x, g_new - g
        x, f, g = new, f_new, g_new
        if s @ y > 1e-10 * (y @ y):
            pairs = [*pairs, (s, y)][-memory:]
        values = [*values, f][-20:]
        if max(values) - f <= tol * abs(values[0]):
            break
    return x


@dataclass(frozen=True)
class Layers:
    """Sigmoid units between the features and two outputs, whose softmax are the probabilities."""
    parts: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

    def transform(self, rows: DataFrame, features: str, out: str = "p") -> DataFrame:
        parts, d = self.parts, self.parts[0].shape[0]

        @F.arrow_udf("double")
        def prob(v: pa.Array) -> pa.Array:
            made = []
            for at in range(0, len(v), ROWS):
                n, indices, values = entries(v.slice(at, ROWS))
                made.append(_outputs(parts, dense(len(n), d, np.repeat(np.arange(len(n)), n), indices, values))[1][:, 1])
            return pa.array(np.concatenate([*made, np.zeros(0)]))

        return rows.withColumn(out, prob(vector_parts(rows, features)))


def _outputs(parts, x):
    """(units, probabilities) of rows."""
    w1, b1, w2, b2 = parts
    units = sigmoid(x @ w1 + b1)
    z = units @ w2 + b2
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return units, z / z.sum(axis=1, keepdims=True)


def fit_layers(train: DataFrame, features: str, hidden: int, label: str = "y", max_iter: int = 100, seed: int = 0) -> Layers:
    """Least mean log loss by L-BFGS; each of its steps is a pass over the rows."""
    d = width(train, features)
    shapes = [(d, hidden), (hidden,), (hidden, 2), (2,)]
    cuts = np.cumsum([int(np.prod(s)) for s in shapes])
    split = lambda x: tuple(p.reshape(s) for p, s in zip(np.split(x, cuts[:-1]), shapes, strict=True))
    rng = np.random.default_rng(seed)
    start = np.concatenate([(rng.uniform(-1, 1, s) * (6.0 / sum(s)) ** 0.5 if len(s) == 2 else np.zeros(s)).ravel() for s in shapes])
    with scratch(packed(train, features, label), "blocks") as blocks:
        n = summed(blocks, lambda y, *_: np.array([float(len(y))]), 1)[0]
        if not n:
            raise ValueError("no training rows")

        def fun(at):
            parts = split(at)

            def of_rows(y, row, indices, values):
                x = dense(len(y), d, row, indices, values)
                units, p = _outputs(parts, x)
                one = np.stack([1 - y, y], axis=1)
                back = p - one
                inner = back @ parts[2].T * units * (1 - units)
                loss = -np.sum(np.log(np.maximum(np.sum(p * one, axis=1), 1e-300)))
                return np.concatenate([[loss], (x.T @ inner).ravel(), inner.sum(axis=0), (units.T @ back).ravel(), back.sum(axis=0)])

            out = summed(blocks, of_rows, 1 + len(at)) / n
            return out[0], out[1:]

        return Layers(split(lbfgs(fun, start, max_iter)))
