"""Stream scoring with an alert filter.

New records arrive as files in a folder; each micro-batch is scored with the
fitted (stateless) scoring transform, rows above the alert threshold are kept,
and the alerts are appended to a parquet sink.  No state, so no watermark; the
checkpoint location makes the query restartable after a failure (exactly-once
file sink).  ``trigger(availableNow=True)`` drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def score_alerts(spark: SparkSession, source_dir: str, schema: T.StructType,
                 score: Callable[[DataFrame], DataFrame], sink_dir: str, checkpoint_dir: str,
                 threshold: float = 0.8, prob: str = "score", key: str = "id",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    alerts = score(stream).where(F.col(prob) > F.lit(threshold)).select(key, prob)
    q = (alerts.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(alerts.schema).parquet(sink_dir)
