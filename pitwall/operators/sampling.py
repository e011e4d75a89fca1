"""Sorts, top-k, sampling and fold assignment (T1-T6), reshaping.

Randomness is a portable seeded hash of the row key (see
``scalars.portable_bucket``): deterministic under recomputation and
executor loss, reproducible in any SQL engine, and it needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.scalars import portable_bucket, portable_unit


def entry_id(season="Season", rnd="Round", driver="DriverNumber") -> Column:
    """The whole key of a race entry as text (input of the seeded hashes)."""
    return F.concat_ws(":", season, rnd, driver)


# --------------------------------------------------------------------- T2
def top_k(df: DataFrame, k: int, by: str, tiebreak: str | None = None) -> DataFrame:
    """Global top-k (planned as TakeOrderedAndProject: k rows per task, no full sort)."""
    order = [F.col(by).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*order).limit(k)


# --------------------------------------------------------------------- T4
def sample_size(n: int, frac: float, cap: int | None) -> int:
    m = max(1, int(n * frac))
    return min(cap, m) if cap else m


def seeded_sample(df: DataFrame, n: int, key: Column, seed: int = 42) -> DataFrame:
    """Exact-n sample without replacement: the n smallest seeded hashes
    (top-k by hash, tie-broken by the key itself)."""
    h = portable_bucket(key, 2147483647, seed)
    return (df.withColumn("_h", h).withColumn("_k", key)
              .orderBy("_h", "_k").limit(n).drop("_h", "_k"))


# --------------------------------------------------------------------- T5
def seeded_split(df: DataFrame, key: Column, test_frac: float = 0.2, seed: int = 42,
                 out: str = "split") -> DataFrame:
    u = portable_unit(key, seed)
    return df.withColumn(out, F.when(u < test_frac, F.lit("test")).otherwise(F.lit("train")))


# --------------------------------------------------------------------- T6
def assign_folds(df: DataFrame, key: Column, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    return df.withColumn(out, portable_bucket(key, k, seed).cast("int"))


# --------------------------------------------------------------------- U3
def unpivot_wide(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                 var: str = "feature", value: str = "value") -> DataFrame:
    """Wide -> long (``stack`` under the hood; a narrow, shuffle-free op)."""
    return df.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]) \
             .unpivot(list(ids), list(cols), var, value)


# --------------------------------------------------------------------- U5
def flatten_struct(df: DataFrame, struct_col: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, f"{struct_col}.*")
