"""Spark session helpers.

The library never creates its own session inside operators; callers pass
one in.  ``get_spark`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(app: str = "pitwall", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("PITWALL_MASTER", "local[*]")
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PITWALL_DRIVER_MEM", "16g"))
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is respected as is.  Only when it is unset (local tests) do we point
    it at a fresh scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pitwall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never localCheckpoint): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set = set()


def ensure_python_package(spark) -> None:
    """Ship the ``pitwall`` package to executor Python workers (the
    ``--py-files`` mechanism) so ``mapInPandas`` functions can import it on
    any cluster, once per application.  The zip is a driver-side build
    artefact that Spark's file server distributes; no data goes through it."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="pitwall-pyfiles-"), "pitwall.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def write_table(df, name: str, partition_by=()):
    """Materialise a reused table as parquet under ``spark.checkpoint.dir``
    and read it back.

    Like ``checkpoint()`` this cuts the lineage and survives executor loss,
    but downstream plans get parquet column pruning, pushed filters and,
    with ``partition_by``, partition pruning (e.g. season splits).
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # the original schema keeps partition-column types and column order
    return spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


def right_size(df, rows_per_partition: int = 500_000):
    """Cache an iterative-ML input with about ``rows_per_partition`` rows per
    partition.

    Spark ML runs one job per iteration over this input; on small inputs the
    per-task overhead dominates, on large ones parallelism does.  Counting
    the cached frame is one cheap job; only coalescing (no shuffle) is used,
    so a big input keeps its partitions.
    """
    import math

    df = df.cache()
    target = max(1, math.ceil(df.count() / rows_per_partition))
    if target < df.rdd.getNumPartitions():
        sized = df.coalesce(target).cache()
        sized.count()
        df.unpersist()
        return sized
    return df
