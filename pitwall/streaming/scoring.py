"""Stateless race scoring over a file stream (Structured Streaming).

The scoring plan of Q1 has no cross-row state, so the same column
expressions run on ``readStream``: new entry files arriving in a folder are
scored against a static 1-row model (stream-static cross join with a
broadcast of exactly one row) and appended to a parquet sink.  The
checkpoint lives in the shared ``spark.checkpoint.dir`` so a restarted
query resumes exactly once.  Per-race ranking needs the complete grid, so
it runs downstream on the sink (batch), not inside the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.operators.filters import drop_lapped


def score_stream(spark: SparkSession, source_dir: str, schema, model: DataFrame, sink_dir: str,
                 checkpoint_dir: str, x: str = "GridPosition", key: Sequence[str] = K.KEY,
                 available_now: bool = True):
    """Start the streaming query; returns the ``StreamingQuery``."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    scored = (drop_lapped(stream)
              .crossJoin(F.broadcast(model))
              .select(*key, (F.col("intercept") + F.col("slope") * F.col(x).cast("double")).alias("prediction")))
    w = (scored.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_scored(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(sink_dir)
