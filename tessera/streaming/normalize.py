"""Normalisation of a folder of source files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.entities import normalize_entities
from tessera.sources.tsv import SOURCE, fill_blank


def stream_sources(spark: SparkSession, folder: str) -> DataFrame:
    """New tab-separated files of a folder, with the columns of a source record."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in SOURCE])
    raw = spark.readStream.schema(schema).csv(folder, sep="\t", header=True, quote='"', escape='"')
    return normalize_entities(fill_blank(raw))


def write_stream(entities: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append normalised records as Parquet, each file once."""
    return entities.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
