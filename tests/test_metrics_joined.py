"""Predictions that a join made: rows that it drops are not checked."""

from pyspark.sql import functions as F

from ranklift.operators import metrics as V


def test_rows_outside_the_join_are_no_predictions(spark):
    docs = spark.createDataFrame([(i, float(i % 7) if i < 50 else 900.0) for i in range(60)], "id long, n double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "id long, y int")
    j = docs.join(labels, "id")
    top = j.select(F.max("n")).scalar()  # 6.0: the rows with 900.0 have no label
    pred = j.select(F.col("id").cast("string").alias("row_id"), F.lit("g").alias("grp"), "y", (F.col("n") / top).alias("p"))
    r = V.binary_metrics(pred).first()
    assert r.n == 50 and r.prevalence == 0.5
