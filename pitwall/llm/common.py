"""Helpers shared by the operators of this package.

* Words are maximal runs of characters outside ASCII white space
  (``[^\\x20\\x09-\\x0D]+``).
* Caller columns never clash with internal ones: an operator that has to keep
  whole rows wraps them in one struct column (``ROW``) and works beside it.
* Reused tables are written as Parquet under ``spark.checkpoint.dir``
  (``pitwall.session.write_table``): shared by all executors, prunable, and
  safe against lost executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import ensure_python_package, write_table

ROW = "__row"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a production query and, where SQL can express it, its oracle."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]++"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def keep_row(df: DataFrame) -> Column:
    """The whole input row as one struct, whatever its column names are."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def unpack(df: DataFrame, like: DataFrame, **replace: Column) -> DataFrame:
    """Undo ``keep_row``: the columns of ``like``, some of them replaced."""
    return df.select(*[(replace[c] if c in replace else F.col(ROW).getField(c)).alias(c)
                       for c in like.columns])


__all__ = ["QUERIES", "ORACLES", "ROW", "query", "table", "words", "n_words", "keep_row",
           "unpack", "ensure_python_package", "write_table"]
