"""Aggregations.

All aggregates are built-in Spark aggregate functions, so Spark plans them
as partial (map-side) + final aggregation.  Exact medians are selected by
``quantiles`` (no group's values are held); ``exact=False`` takes the one-scan
``percentile_approx`` instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions import scalars as S
from pitwall.operators.quantiles import quantile_groups, quantile_row


def _doubles(cols: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(f"`{c}`").cast("double") for c in cols}


# --------------------------------------------------------------------- A1
def column_medians(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """1-row frame of linear-interpolated medians (NULL and NaN skipped)."""
    if exact:
        return quantile_row(df, _doubles(cols))
    return df.agg(*[F.percentile_approx(x, 0.5, 10000).alias(c) for c, x in _doubles(cols).items()])


# ----------------------------------------------------------------- A2/A4
def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                       group: Sequence[str] = (), dropna: bool = True) -> DataFrame:
    """RMSE, MAE, MSE, R^2 and n over rows with both values present.

    R^2 = 1 - SS_res / SS_tot with SS_tot = var_pop(y) * n (one stable pass);
    a constant truth gives 1.0 if the fit is perfect, else 0.0.
    """
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    if dropna:
        df = df.filter(yc.isNotNull() & pc.isNotNull())
    err = yc - pc
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.sum(err * err).alias("_ss_res"),
        (F.var_pop(yc) * F.count(F.lit(1))).alias("_ss_tot"),
    ]
    g = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    r2 = (F.when(F.col("_ss_tot") > 0, F.lit(1.0) - F.col("_ss_res") / F.col("_ss_tot"))
           .when(F.col("_ss_res") == 0, F.lit(1.0))
           .otherwise(F.lit(0.0)))
    return g.select(*group, F.sqrt("mse").alias("rmse"), "mae", "mse", r2.alias("r2"), "n")


# --------------------------------------------------------------------- A3
def metrics_by_model(df: DataFrame, model: str = "model", y: str = "y_true",
                     p: str = "y_pred") -> DataFrame:
    """Per-model metrics; ``rows`` = rows used.  Sort at the sink by ``rmse``."""
    return (regression_metrics(df, y, p, group=[model])
            .withColumnRenamed("n", "rows"))


# --------------------------------------------------------------------- A5
def group_medians(df: DataFrame, group: str, cols: Sequence[str], exact: bool = True,
                  count_name: str = "n") -> DataFrame:
    n = F.count(F.lit(1)).alias(count_name)
    if not exact:
        return df.groupBy(group).agg(n, *[F.percentile_approx(x, 0.5, 10000).alias(c) for c, x in _doubles(cols).items()])
    return _with_medians(df.groupBy(group).agg(n), quantile_groups(df, group, _doubles(cols)), group)


def _with_medians(groups: DataFrame, medians: DataFrame, group: str) -> DataFrame:
    """Null-safe left join of per-group medians."""
    medians = medians.withColumnRenamed(group, "_group")
    return groups.join(medians, F.col(f"`{group}`").eqNullSafe(F.col("_group")), "left").drop("_group")


# --------------------------------------------------------------------- A6
def group_means_coerced(df: DataFrame, group: str, cols: Sequence[str]) -> DataFrame:
    """Mean per group after coercing to number with bad/NULL -> 0."""
    return df.groupBy(group).agg(*[F.avg(S.safe_number(c, 0.0)).alias(c) for c in cols])


# --------------------------------------------------------------------- A7
def group_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    v = F.col(value).cast("double")
    stats = df.groupBy(group).agg(F.count(v).alias("count"), F.avg(v).alias("mean"),
                                  F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    both = _with_medians(stats, quantile_groups(df, group, {"median": v}), group)
    return both.select(group, "count", "mean", "median", "std", "min", "max")


# ----------------------------------------------------------------- A9/A10
def mean_abs_by_feature(long_df: DataFrame, feature: str = "feature",
                        value: str = "contribution", out: str = "mean_abs_shap") -> DataFrame:
    return long_df.groupBy(feature).agg(F.avg(F.abs(F.col(value))).alias(out))


def ensemble_importance(long_df: DataFrame, fold: str = "fold", feature: str = "feature",
                        value: str = "contribution", out: str = "mean_abs_shap",
                        variant: str = "per_fold_mean") -> DataFrame:
    """A10: (a) ``pooled``: mean |c| over all fold rows pooled; (b)
    ``per_fold_mean``: mean over folds of each fold's mean |c|."""
    if variant == "pooled":
        return mean_abs_by_feature(long_df, feature, value, out)
    per = long_df.groupBy(fold, feature).agg(F.avg(F.abs(F.col(value))).alias("_m"))
    return per.groupBy(feature).agg(F.avg("_m").alias(out))


# -------------------------------------------------------------------- A11
def contingency(df: DataFrame, row: str, col: str, labels: Sequence[str],
                row_name: str = "row_0") -> DataFrame:
    """Crosstab with an explicit label order (pivot values given -> no extra job)."""
    return (df.groupBy(F.col(row).alias(row_name)).pivot(col, list(labels)).count()
              .fillna(0, subset=list(labels))
              .select(row_name, *[F.col(c).cast("bigint").alias(c) for c in labels]))


# -------------------------------------------------------------------- A12
def mean_over_folds(long_df: DataFrame, key: Sequence[str], pred: str = "prediction",
                    out: str = "y_pred") -> DataFrame:
    return long_df.groupBy(*key).agg(F.avg(pred).alias(out))


# -------------------------------------------------------------------- A13
def best_row(df: DataFrame, metric: str, tiebreak: str) -> DataFrame:
    """Row with the smallest non-null ``metric`` (first ``tiebreak`` on ties)."""
    cols = df.columns
    best = df.filter(F.col(metric).isNotNull()).agg(
        F.min_by(F.struct(*cols), F.struct(F.col(metric), F.col(tiebreak))).alias("_b"))
    return best.select("_b.*")


# -------------------------------------------------------------------- A15
def distinct_and_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: number of distinct non-null values and non-null count.

    Each column is grouped by value on its own (its pruned scan, distinct
    values combined map-side) and gives one row; ``count(DISTINCT a), count(
    DISTINCT b)`` in one aggregate would copy every row once per column."""
    out = None
    for c in cols:
        one = df.select(F.col(f"`{c}`").alias("v")).groupBy("v").agg(F.count("v").alias("n")).agg(
            F.count("v").alias(f"{c}__distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias(f"{c}__nonnull"))
        out = one if out is None else out.crossJoin(F.broadcast(one))   # one row each
    return out.select(*[f"`{c}__distinct`" for c in cols], *[f"`{c}__nonnull`" for c in cols])


# -------------------------------------------------------------------- A16
def replacement_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.sum(cond.cast("long")).alias(name) for name, cond in conditions.items()])


# -------------------------------------------------------------------- A17
def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from min to max; the max lands in the last bin."""
    v = F.col(value).cast("double")
    ext = F.broadcast(df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")))
    b = F.when(F.col("_hi") > F.col("_lo"),
               F.least(F.lit(bins).cast("bigint"),
                       F.width_bucket(v, F.col("_lo"), F.col("_hi"), F.lit(bins))))
    b = F.coalesce(b, F.lit(1).cast("bigint"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (df.filter(v.isNotNull()).crossJoin(ext)
              .groupBy(b.alias("bin"), F.col("_lo"), width.alias("_w"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select("bin", (F.col("_lo") + (F.col("bin") - 1) * F.col("_w")).alias("bin_lo"),
                      (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_hi"), "count"))


# -------------------------------------------------------------------- A18
def value_extent(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.least(F.min(a), F.min(b)).alias("lo"),
                  F.greatest(F.max(a), F.max(b)).alias("hi"))


# -------------------------------------------------------------------- A19
def population_std(df: DataFrame, value: str, out: str = "sigma") -> DataFrame:
    return df.agg(F.stddev_pop(F.col(value).cast("double")).alias(out))


# -------------------------------------------------------------------- A20
def rare_categories(df: DataFrame, cols: Iterable[str], min_count: int) -> DataFrame:
    """Values seen fewer than ``min_count`` times per categorical column
    (NULL counted as 'missing'), long form ``(column, value, count)``."""
    cols = list(cols)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias("value"))
        for c in cols])).alias("_kv")).select("_kv.*")
    return (long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
                .filter(F.col("count") < min_count))

