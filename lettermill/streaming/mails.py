"""The row-wise programs over streams: cleaning, and the filter with a trained model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from lettermill.config import DEFAULT
from lettermill.operators import bulk
from lettermill.operators.clean import clean_bodies


def mail_stream(spark: SparkSession, folder: str, schema: str = "eid string, raw_body string") -> DataFrame:
    """Mails as they arrive as JSON lines in ``folder``."""
    return spark.readStream.schema(schema).json(folder)


def clean_stream(mails: DataFrame, body: str = "raw_body") -> DataFrame:
    """No state, no shuffle: the batch expressions run on the stream as they are."""
    return clean_bodies(mails, body)


def filter_stream(mails: DataFrame, model: bulk.BulkModel, text: str = "raw_body", threshold: float = DEFAULT.automation_threshold) -> DataFrame:
    return bulk.classify(bulk.clean_for_model(mails, text), model, threshold)


def to_parquet(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
