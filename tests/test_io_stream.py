"""Loading with schema checks, a streaming smoke test and the driver contract."""

import pytest
from pyspark.sql import functions as F

from ranklift.operators.derive import add_derived
from ranklift.sources import io
from ranklift.sources.fixtures import IMPRESSION_COLUMNS, impressions
from ranklift.streaming import scoring


def _csv(spark, sf_small, path, drop=None, extra=None):
    df = impressions(spark, sf_small).select(*IMPRESSION_COLUMNS)
    if drop:
        df = df.drop(drop)
    if extra:
        df = df.withColumn(extra, F.lit(1))
    df.write.mode("overwrite").option("header", True).csv(path)


def test_load_roundtrip_and_schema_errors(spark, sf_small, tmpdir_path):
    _csv(spark, sf_small, f"{tmpdir_path}/ok")
    got = io.load_impressions(spark, f"{tmpdir_path}/ok")
    assert got.columns == list(IMPRESSION_COLUMNS)
    assert dict(got.dtypes)["bought"] == "boolean" and dict(got.dtypes)["timestamp"] == "timestamp"
    assert got.count() == impressions(spark, sf_small).count()
    _csv(spark, sf_small, f"{tmpdir_path}/bad", drop="brand", extra="leaky")
    with pytest.raises(io.SchemaError, match="missing=\\['brand'\\] extra=\\['leaky'\\]"):
        io.load_impressions(spark, f"{tmpdir_path}/bad")
    with pytest.raises(FileNotFoundError):
        io.load_impressions(spark, f"{tmpdir_path}/absent")


def test_streaming_derive_matches_batch(spark, sf_small, tmpdir_path):
    src = f"{tmpdir_path}/stream_src"
    batch = impressions(spark, sf_small)
    batch.repartition(3).write.mode("overwrite").parquet(src)
    stream = scoring.read_impressions_stream(spark, src, batch.schema)
    q = scoring.start_to_table(scoring.derive_stream(stream), "derived_stream", f"{tmpdir_path}/ckpt")
    q.processAllAvailable()
    q.stop()
    got = spark.table("derived_stream")
    assert got.count() == batch.count()
    exp = add_derived(batch).agg(F.sum("dim_volume")).first()[0]
    assert got.agg(F.sum("dim_volume")).first()[0] == pytest.approx(exp)


def test_entry_contract(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    assert out.count() > 0 and "rate" in out.columns
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from ranklift.plans import catalog
    assert set(catalog.QUERIES) <= set(qs) and set(catalog.ORACLE) <= set(sql)
    more = set(qs) - set(catalog.QUERIES)  # of the optional subpackage, if it is there
    assert all(n == "pipeline" or n.startswith("op") for n in more)
