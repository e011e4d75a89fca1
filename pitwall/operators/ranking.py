"""Exact row numbers within groups (P5, W3, rig positions).

``method="range"`` (default) is one path for every size: a group may hold a
third of all rows, so no task ever takes a whole group.

1. ``repartitionByRange`` on (group, order): the sampled range bounds split a
   hot group across many partitions; sort within partitions;
2. tag rows with ``(partition id, monotonically increasing id)`` and write
   them under ``spark.checkpoint.dir``, so the ids are stable under
   recomputation and executor loss;
3. per (partition, group): first id and count (at most groups + partitions
   rows), prefix-sum counts over partitions per group (a hot group has at
   most ``num_partitions`` rows there);
4. rank = id - first + offset + 1.

Whole rows travel through the ranges and offsets join null-safely, so null
groups, null order values and tied rows rank as in a window.

``method="window"``: ``row_number() OVER (PARTITION BY group ORDER BY ...)``,
for groups that are bounded by construction (a grid of 25 nations).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.session import write_table


def row_number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                      out: str = "rn", method: str = "range",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1..n within each group following ``order``.

    Rows tied on ``order`` get consecutive numbers in no defined order."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    if method != "range":
        raise ValueError(f"unknown method {method!r}")
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group]
    ranged = write_table(df.repartitionByRange(n, *keys, *order)
                         .sortWithinPartitions(*keys, *order)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()), "ranked")
    prior = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_p").rowsBetween(
        Window.unboundedPreceding, -1)
    # written: the join knows its size and leaves the ranked rows where they are
    stats = write_table(ranged.groupBy(F.col("_pid").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)])
                        .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
                        .withColumn("_off", F.coalesce(F.sum("_n").over(prior), F.lit(0))), "rank_offsets")
    on = ranged["_pid"] == stats["_p"]
    for i, g in enumerate(group):
        on = on & ranged[g].eqNullSafe(stats[f"_g{i}"])
    rank = (F.col("_mid") - F.col("_first") + F.col("_off") + 1).cast("bigint").alias(out)
    return ranged.join(stats, on).select(*[ranged[c] for c in df.columns], rank)
