"""Stateless operators on a streaming source.

Derived columns (C14), category codes (D4) and scaling (D6) are projections and
lookups against small fitted tables, so the same code runs on ``readStream``
frames; this module wires them to a file source and a sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ranklift.operators.derive import add_derived
from ranklift.operators.features import FeatureModel, prepare


def read_impressions_stream(spark: SparkSession, path: str, schema: StructType,
                            max_files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def derive_stream(stream: DataFrame, use_temporal: bool = False) -> DataFrame:
    return add_derived(stream, use_temporal=use_temporal)


def featurize_stream(stream: DataFrame, model: FeatureModel) -> DataFrame:
    """Codes and scaled numerics for a stream, using a model fitted on a batch train split.

    The vocabulary is joined as a static table (stream-static join); the scaler
    statistics are literals.
    """
    return model.scale(model.encode(prepare(stream, model.cfg)))


def start_to_table(stream: DataFrame, name: str, checkpoint: str, fmt: str = "memory",
                   path: str | None = None):
    w = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "memory":
        return w.format("memory").queryName(name).start()
    return w.format(fmt).option("path", path).start()
