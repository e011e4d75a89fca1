"""Sinks/sources round trips and streaming restart semantics."""
import json
import os

from pyspark.sql import functions as F

from pitwall.sources import files as IO
from pitwall.streaming.scoring import read_scored, score_stream


def test_category_map_lines_are_bounded(spark):
    rare = spark.range(0, 2500).select(F.lit("Time").alias("column"), F.col("id").cast("string").alias("value")) \
        .unionByName(spark.createDataFrame([("Status", "Retired")], "column string, value string"))
    path = IO.write_category_map(rare, IO.run_folder(spark, "t-map") + "/m", values_per_line=1000)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    assert max(len(v) for obj in lines for v in obj.values()) < 1500     # ~1000 per line
    back = IO.read_category_map(spark, path)
    assert back.filter("column = 'Time'").count() == 2500
    assert back.filter("column = 'Status'").first()["value"] == "Retired"


def test_stream_restart_is_exactly_once(spark):
    folder = IO.run_folder(spark, "t-stream")
    src = spark.range(0, 40).select(F.lit(2000).cast("bigint").alias("Season"),
                                    (F.col("id") % 4 + 1).alias("Round"), F.col("id").alias("DriverNumber"),
                                    (F.col("id") % 20 + 1).alias("GridPosition"),
                                    F.when(F.col("id") % 7 == 0, "Lapped").alias("Status"))
    src.write.parquet(f"{folder}/in")
    model = spark.createDataFrame([(1.5, -2.0)], "intercept double, slope double")
    for _ in range(2):          # second run resumes from the checkpoint: nothing new to emit
        q = score_stream(spark, f"{folder}/in", src.schema, model, f"{folder}/out", f"{folder}/_ckpt")
        q.awaitTermination()
    out = read_scored(spark, f"{folder}/out")
    kept = src.filter(~F.col("Status").eqNullSafe("Lapped")).count()
    assert out.count() == kept
    r = out.filter("DriverNumber = 1").first()
    assert r["prediction"] == 1.5 - 2.0 * 2
    assert os.path.isdir(f"{folder}/_ckpt") or folder.startswith(("hdfs:", "s3"))
