"""Train-only feature fitting and stateless application (inventory D1-D10, J2).

``FeatureEstimator.fit(train)`` returns an immutable ``FeatureModel`` that holds
two small tables (numeric statistics, category codes).  Fitting twice is an
error; there is no transform before fit by construction.  Transforming is a
projection plus lookups, so it also runs on streaming frames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ranklift.functions import scalars as S
from ranklift.operators.derive import add_derived
from ranklift.operators.ordering import prefix_sums_by

UNK_CODE = 0
UNK = "[UNK]"
NUMERIC = ("price", "filter_price_min", "filter_price_max", "net_weight_oz", "nutrition_score",
           "price_pos", "price_per_oz", "dim_length", "dim_width", "dim_height", "dim_volume")
CATEGORICAL = ("category", "brand", "package_size", "unit_of_measure", "storage_type", "allergens",
               "country_of_origin")
TEMPORAL = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos")
#: Admitted columns deliberately not used, with the reason (checked by feature_coverage).
DROPPED = {
    "ingredients": "redundant with category once each list is normalised to its sorted set",
    "timestamp": "no measurable effect; cyclic features available behind use_temporal",
}
#: Raw columns that the numeric and categorical features are made from.
SOURCES = ("price", "filter_price_min", "filter_price_max", "net_weight_oz", "nutrition_score", "dimensions_in", *CATEGORICAL)
BROADCAST_MAX_ROWS = 1_000_000
MAP_MAX_ROWS = 100_000


@dataclass(frozen=True)
class FeatureConfig:
    """Feature switches."""
    numeric: tuple[str, ...] = NUMERIC
    categorical: tuple[str, ...] = CATEGORICAL
    keep_marker: bool = True
    keep_tail: bool = True
    use_cart: bool = False          # leak ablation only
    use_temporal: bool = False
    use_marker_category: bool = False
    scaler: str = "standard"        # or "quantile"

    def numeric_cols(self) -> list[str]:
        cols = list(self.numeric) + (list(TEMPORAL) if self.use_temporal else [])
        return cols + (["cart_num"] if self.use_cart else [])

    def categorical_cols(self) -> list[str]:
        return list(self.categorical) + (["marker"] if self.use_marker_category else [])


def prepare(df: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Derived columns + text segments + target as 0/1 (both when present)."""
    d = add_derived(df, use_temporal=cfg.use_temporal)
    if {"title", "description"} <= set(d.columns):
        a, b = S.text_segments("title", "description", cfg.keep_marker, cfg.keep_tail)
        d = d.withColumns({"text_a": a, "text_b": b})
        d = d.withColumn("text_both", F.concat_ws(" [SEP] ", "text_a", "text_b"))
    if cfg.use_cart:
        d = d.withColumn("cart_num", F.col("cart").cast("double"))
    if "bought" in d.columns:
        d = d.withColumn("y", S.target01("bought"))
    return d


def maybe_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast only after checking the row count; otherwise leave the join to the planner."""
    n = small.count()
    return F.broadcast(small) if n <= max_rows else small


def _long(df: DataFrame, cols: list[str], cast: str) -> DataFrame:
    return df.select([F.col(c).cast(cast).alias(c) for c in cols]).unpivot([], cols, "feature", "value")


# D2 --------------------------------------------------------------------------
#: Reference quantiles of a column, and the decimals at which values are compared with them.
QUANTILES, QUANTILE_DIGITS = 1000, 9


def quantile_grid(rows: DataFrame, by: str, value: str, n: int = QUANTILES) -> DataFrame:
    """(by, quantiles): ``n`` exact linear quantiles of each group, at equal steps from minimum to maximum.

    Distinct values are counted and added up in order (X1 within groups); a value then knows
    by arithmetic which of the n ranks fall on it, so ranks and values meet without a join.
    """
    v = (rows.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(by, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("cnt")))
    sizes = v.groupBy(by).agg((F.sum("cnt") - 1).alias("top"))
    cum = prefix_sums_by(v, [by], "v", ["cnt"]).withColumn("cb", F.col("cum_cnt") - F.col("cnt")).join(sizes, by)
    step = F.greatest(F.col("top"), F.lit(1)) / F.lit(float(n - 1))
    # the ranks whose lower or upper neighbour may lie in [cb, cum)
    first = F.greatest(F.floor((F.col("cb") - 1) / step) - 1, F.lit(0))
    last = F.least(F.ceil(F.col("cum_cnt") / step) + 1, F.lit(n - 1))
    at = cum.filter(first <= last).withColumn("i", F.explode(F.sequence(first, last)))
    at = at.withColumn("pos", F.col("top") * (F.col("i") / F.lit(float(n - 1)))).withColumn("lo", F.floor("pos"))
    at = at.withColumn("hi", F.least(F.col("lo") + 1, F.col("top")))
    here = lambda c: F.max(F.when((F.col("cb") <= F.col(c)) & (F.col(c) < F.col("cum_cnt")), F.col("v")))
    q = at.groupBy(by, "i").agg(here("lo").alias("a"), here("hi").alias("b"), F.max(F.col("pos") - F.col("lo")).alias("w"))
    q = q.select(by, "i", S.rnd(F.col("a") + F.col("w") * (F.col("b") - F.col("a")), QUANTILE_DIGITS).alias("x"))
    return q.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda r: r["x"]).alias("quantiles"))


def _let(value: F.Column, body) -> F.Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def quantile_rank(x: F.Column, quantiles) -> F.Column:
    """Place of ``x`` among ascending quantiles, 0 to 1: between two of them by interpolation, on equal ones their middle.

    ``quantiles`` is a numpy array, one literal of the plan; its last element not above (or
    first not below) x is found by ten halving steps inside the expression.
    """
    n = len(quantiles)
    q = F.lit(quantiles)
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])

    def last(test):
        return F.aggregate(steps, F.lit(-1), lambda i, s: F.when(F.coalesce(test(F.get(q, i + s)), F.lit(False)), i + s).otherwise(i))

    def place(r):
        left, right = F.get(q, r["upto"]), F.get(q, r["upto"] + 1)
        return F.when(r["upto"] < 0, F.lit(0.0)).when(left == x, (r["upto"] + r["below"] + 1) / 2.0).when(
            r["upto"] == n - 1, F.lit(float(n - 1))).otherwise(r["upto"] + (x - left) / (right - left)) / F.lit(float(max(n - 1, 1)))

    found = F.struct(last(lambda v: v <= x).alias("upto"), last(lambda v: v < x).alias("below"))
    return F.when(x.isNotNull(), _let(found, place))


#: Coefficients of a published rational approximation of the normal quantile (relative error below 1.2e-9).
NORMAL_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
NORMAL_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0)
NORMAL_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
NORMAL_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0)
NORMAL_TAIL, NORMAL_CLIP = 0.02425, 1e-7


def normal_quantile(u: F.Column) -> F.Column:
    """Normal quantile of ``u``, which is kept ``NORMAL_CLIP`` off 0 and 1."""
    def poly(c, t):
        out = F.lit(c[0])
        for x in c[1:]:
            out = out * t + F.lit(x)
        return out

    def tail(p):
        return _let(F.sqrt(-2.0 * F.log(p)), lambda t: poly(NORMAL_C, t) / poly(NORMAL_D, t))

    def at(p):
        middle = _let((p - 0.5) * (p - 0.5), lambda r: (p - 0.5) * poly(NORMAL_A, r) / poly(NORMAL_B, r))
        return F.when(p < NORMAL_TAIL, tail(p)).when(p > 1 - NORMAL_TAIL, -tail(1.0 - p)).otherwise(middle)

    return _let(u, lambda v: F.when(v.isNotNull(), _let(F.least(F.greatest(v, F.lit(NORMAL_CLIP)), F.lit(1 - NORMAL_CLIP)), at)))


def quantile_normal(x: F.Column, quantiles: np.ndarray) -> F.Column:
    """``normal_quantile(quantile_rank(x, quantiles))`` by Arrow batch: two binary searches and the same formulas over arrays."""
    n = len(quantiles)

    def rank(v):
        upto, below = np.searchsorted(quantiles, v, "right") - 1, np.searchsorted(quantiles, v, "left") - 1
        left, right = quantiles[np.maximum(upto, 0)], quantiles[np.minimum(upto + 1, n - 1)]
        between = upto + (v - left) / np.where(right > left, right - left, 1.0)
        at = np.where(left == v, (upto + below + 1) / 2.0, np.where(upto == n - 1, float(n - 1), between))
        return np.where(upto < 0, 0.0, at / float(max(n - 1, 1)))

    def poly(c, t):
        out = c[0]
        for k in c[1:]:
            out = out * t + k
        return out

    @F.arrow_udf("double")
    def scaled(values: pa.Array) -> pa.Array:
        null = pc.is_null(values).to_numpy(zero_copy_only=False)
        v = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False)
        p = np.minimum(np.maximum(rank(v), NORMAL_CLIP), 1 - NORMAL_CLIP)
        low, high, r = p < NORMAL_TAIL, p > 1 - NORMAL_TAIL, (p - 0.5) * (p - 0.5)
        t = np.sqrt(-2.0 * np.log(np.where(high, 1.0 - p, p)))
        tail, middle = poly(NORMAL_C, t) / poly(NORMAL_D, t), (p - 0.5) * poly(NORMAL_A, r) / poly(NORMAL_B, r)
        return pa.array(np.where(low, tail, np.where(high, -tail, middle)), mask=null)

    return scaled(x)


class FeatureEstimator:
    def __init__(self, cfg: FeatureConfig | None = None):
        self.cfg = cfg or FeatureConfig()
        self._fitted = False

    def fit(self, train: DataFrame) -> "FeatureModel":
        if self._fitted:
            raise RuntimeError("FeatureEstimator.fit called twice; build a new estimator")
        self._fitted = True
        cfg = self.cfg
        d = prepare(train, cfg)
        if cfg.scaler == "standard":  # D1: population sd, zero sd -> 1; all columns in one row, then turned
            one = d.agg(*[f(F.col(c).cast("double")).alias(f"{k}_{c}") for c in cfg.numeric_cols()
                          for k, f in (("mean", F.avg), ("sd", F.stddev_pop))])
            rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"), F.col(f"sd_{c}").alias("sd"))
                             for c in cfg.numeric_cols()])
            stats = one.select(F.explode(rows).alias("r")).select("r.*")
            stats = stats.withColumn("sd", F.when((F.col("sd") == 0) | F.col("sd").isNull(), 1.0).otherwise(F.col("sd")))
        elif cfg.scaler == "quantile":  # D2: 1,000 reference quantiles per column (bounded)
            num = _long(d, cfg.numeric_cols(), "double")
            stats = quantile_grid(num.withColumn("value", S.rnd("value", QUANTILE_DIGITS)), "feature", "value")
        else:
            raise ValueError(f"unknown scaler {cfg.scaler!r}")
        cat = _long(d, cfg.categorical_cols(), "string").where(F.col("value").isNotNull()).distinct()
        vocab = cat.withColumn("code", F.dense_rank().over(Window.partitionBy("feature").orderBy("value"))).cache()
        model = FeatureModel(cfg, stats.cache(), vocab)
        # One-hot blocks sized from the train codes (max code k -> k+1 slots, slot 0 = UNK)
        from pyspark.ml.feature import OneHotEncoder
        cats = cfg.categorical_cols()
        levels = {r["feature"]: r["n"] + 1 for r in vocab.groupBy("feature").agg(F.max("code").alias("n")).collect()}
        levels = {c: levels.get(c, 1) for c in cats}  # one number a column
        # every code of the vocabulary is one of a train row, so the highest codes say all that a pass over train would
        top = train.sparkSession.createDataFrame([tuple(n - 1 for n in levels.values())], ", ".join(f"{c}_code int" for c in cats))
        ohe = OneHotEncoder(inputCols=[f"{c}_code" for c in cats], outputCols=[f"{c}_oh" for c in cats],
                            dropLast=False, handleInvalid="error").fit(top)
        object.__setattr__(model, "onehot_model", ohe)
        object.__setattr__(model, "levels", levels)
        return model


@dataclass(frozen=True)
class FeatureModel:
    cfg: FeatureConfig
    stats: DataFrame
    vocab: DataFrame
    onehot_model: object = field(default=None, compare=False, repr=False)
    #: Codes of each categorical column, 0 for unseen values included.
    levels: dict = field(default=None, compare=False, repr=False)

    # D4 / J2 ----------------------------------------------------------------
    def encode(self, d: DataFrame) -> DataFrame:
        """Code per categorical column; unseen (and null) -> 0.

        A vocabulary under ``MAP_MAX_ROWS`` entries (checked by a count) becomes a
        literal map per column, so encoding is a projection inside codegen; a
        larger one is joined like any dimension table.
        """
        n = self.vocab.count()
        out = d
        if n <= MAP_MAX_ROWS:
            per = {}
            for r in self.vocab.collect():
                per.setdefault(r["feature"], []).extend([F.lit(r["value"]), F.lit(int(r["code"]))])
            return out.withColumns({
                f"{c}_code": F.coalesce(F.element_at(F.create_map(*per[c]), F.col(c).cast("string"))
                                        if c in per else F.lit(None), F.lit(UNK_CODE)).cast("int")
                for c in self.cfg.categorical_cols()})
        vocab = maybe_broadcast(self.vocab)
        for c in self.cfg.categorical_cols():
            v = vocab.where(F.col("feature") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_code"))
            out = (out.join(v, out[c].cast("string") == v[f"_v_{c}"], "left").drop(f"_v_{c}")
                   .withColumn(f"{c}_code", F.coalesce(F.col(f"{c}_code"), F.lit(UNK_CODE)).cast("int")))
        return out

    # D6 ---------------------------------------------------------------------
    def scale(self, d: DataFrame) -> DataFrame:
        if self.cfg.scaler == "quantile":
            return self._quantile_scale(d)
        rows = {r["feature"]: (r["mean"], r["sd"]) for r in self.stats.collect()}  # one row per numeric column
        return d.withColumns({f"{c}_scaled": (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in rows.items()})

    def _quantile_scale(self, d: DataFrame) -> DataFrame:
        table = {r["feature"]: np.array(r["quantiles"], dtype=float) for r in self.stats.collect()}  # 1,000 numbers a column
        return d.withColumns({f"{c}_scaled": quantile_normal(S.rnd(F.col(c).cast("double"), QUANTILE_DIGITS), q) for c, q in table.items()})

    # D5 / D7 ----------------------------------------------------------------
    def layout(self) -> DataFrame:
        """One-hot block per column including the UNK slot: (feature, offset, width)."""
        widths = self.vocab.groupBy("feature").agg((F.max("code") + 1).alias("width"))
        w = Window.orderBy("feature").rowsBetween(Window.unboundedPreceding, -1)  # one row per column
        return widths.withColumn("offset", F.coalesce(F.sum("width").over(w), F.lit(0)))

    def transform(self, df: DataFrame, with_vectors: bool = True) -> DataFrame:
        d = self.scale(self.encode(prepare(df, self.cfg)))
        if not with_vectors:
            return d
        from pyspark.ml.feature import VectorAssembler
        cats = self.cfg.categorical_cols()
        d = self.onehot_model.transform(d)
        num = [f"{c}_scaled" for c in self.cfg.numeric_cols()]
        d = d.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in num})
        # the entries of features_linear by plain expressions, for solvers that need no MLlib vector
        at = [len(num) + sum(int(self.levels[x]) for x in cats[:i]) for i in range(len(cats) + 1)]
        d = d.withColumn("features_sparse", F.struct(
            F.array(*[F.lit(i) for i in range(len(num))], *[F.lit(k) + F.col(f"{c}_code") for c, k in zip(cats, at)]).alias("indices"),
            F.array(*[F.col(c) for c in num], *[F.lit(1.0)] * len(cats)).alias("values"))).withMetadata("features_sparse", {"size": at[-1]})
        lin = VectorAssembler(inputCols=num + [f"{c}_oh" for c in cats], outputCol="features_linear").transform(d)
        out = VectorAssembler(inputCols=num + [f"{c}_code" for c in cats], outputCol="features_tree").transform(lin)
        # the kind of a column goes with its role, never with its number of levels; slot 0 is there for unseen values
        attrs = {"numeric": [{"idx": i, "name": c} for i, c in enumerate(num)], "nominal": [
            {"idx": len(num) + i, "name": f"{c}_code", "num_vals": max(2, int(self.levels[c]))} for i, c in enumerate(cats)]}
        return out.withMetadata("features_tree", {"ml_attr": {"num_attrs": len(num) + len(cats), "attrs": {
            kind: own for kind, own in attrs.items() if own}}})

    def unpersist(self) -> None:
        """Release the fitted tables."""
        self.stats.unpersist()
        self.vocab.unpersist()

    # D9 ---------------------------------------------------------------------
    def summary(self) -> DataFrame:
        return self.vocab.groupBy("feature").agg(
            (F.count(F.lit(1)) + 1).alias("levels"),
            F.array_join(F.slice(F.array_sort(F.collect_list("value")), 1, 3), ", ").alias("examples"))


# B14 -------------------------------------------------------------------------
def feature_coverage(admitted: list[str], cfg: FeatureConfig, dropped: dict[str, str] = DROPPED) -> dict[str, list[str]]:
    """Every admitted column is used or dropped with a reason; nothing extra."""
    derived_from = {"price_pos": "price", "price_per_oz": "price", "dim_length": "dimensions_in",
                    "dim_width": "dimensions_in", "dim_height": "dimensions_in", "dim_volume": "dimensions_in"}
    used = {derived_from.get(c, c) for c in cfg.numeric_cols() + cfg.categorical_cols()} | {"title", "description"}
    return {"unaccounted": sorted(set(admitted) - used - set(dropped)),
            "extra": sorted(used - set(admitted) - {"marker", "cart_num"}),
            "both": sorted(used & set(dropped))}
