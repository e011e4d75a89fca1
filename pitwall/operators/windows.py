"""Window-shaped operators.

Partitioning notes: W1/W4 partition by driver (and season) — a driver has a
bounded number of races per season.  W5 (race mean) is a group-by + keyed
join instead of a window, so a hot race is pre-aggregated map-side rather
than landing whole in one task; the gap to the car ahead is a keyed
self-join on ``Position - 1``.  W6 uses globally selected exact quantiles (1 row,
broadcast) instead of an un-partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.functions import scalars as S
from pitwall.operators.quantiles import exact_quantiles
from pitwall.operators.ranking import row_number_within
from pitwall.session import write_table


# ------------------------------------------------------------------ W1/W2
def races_prior(df: DataFrame, round_col: str = "Round",
                out: str = "races_prior_this_season") -> DataFrame:
    """Keep an existing ``races_prior_this_season`` (non-numeric -> 0),
    else fall back to ``Round - 1``."""
    if out in df.columns:
        return df.withColumn(out, S.safe_number(out, 0.0))
    return df.withColumn(out, S.safe_number(round_col, None) - F.lit(1.0))


def races_prior_counted(df: DataFrame, season: str = "Season", driver: str = "DriverId",
                        round_col: str = "Round", key: str = "DriverNumber",
                        out: str = "races_prior_counted") -> DataFrame:
    """W2 alternative: the true number of earlier entries of the driver this season."""
    w = (Window.partitionBy(season, driver)
         .orderBy(F.col(round_col).asc_nulls_last(), F.col(key))
         .rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.count(F.lit(1)).over(w).cast("bigint"))


def points_prop(df: DataFrame, season: str = "Season", driver: str = "DriverId",
                round_col: str = "Round", points: str = "Points",
                tiebreak: str = "DriverNumber", out: str = "PointsProp") -> DataFrame:
    """Cumulative points of *prior* rounds / (races_prior x 25), clipped.

    Points are coerced (bad -> 0).  Denominator <= 0 -> 0.0.  A NULL season
    or driver has no history -> NULL when the denominator is positive.
    """
    for c in (points, season, round_col):
        if c not in df.columns:
            raise ValueError(f"input is missing required column {c!r}")
    df = races_prior(df, round_col)
    pts = S.safe_number(points, 0.0)
    rnd = S.safe_number(round_col, None)
    w = (Window.partitionBy(season, driver)
         .orderBy(rnd.asc_nulls_last(), F.col(tiebreak))
         .rowsBetween(Window.unboundedPreceding, -1))
    cum = F.coalesce(F.sum(pts).over(w), F.lit(0.0))
    denom = F.col("races_prior_this_season") * K.MAX_POINTS_PER_RACE
    no_group = F.col(season).isNull() | F.col(driver).isNull()
    prop = (F.when(denom > 0, F.when(no_group, F.lit(None).cast("double")).otherwise(cum / denom))
             .otherwise(F.lit(0.0)))
    return df.withColumn(out, S.clip(prop, 0.0, 1.0))


# --------------------------------------------------------------------- W3
def rank_predictions(df: DataFrame, pred: str = "prediction",
                     race: Sequence[str] = K.RACE, driver: str = "DriverNumber",
                     out: str = "PredictedPosition", method: str = "range") -> DataFrame:
    """Position 1..n per race by predicted deviation ascending (lower is
    better), NULL predictions last, driver number breaks ties."""
    order = [F.col(pred).asc_nulls_last(), F.col(driver).asc()]
    return row_number_within(df, list(race), order, out=out, method=method)


def podium(df: DataFrame, pos: str = "PredictedPosition", k: int = 3) -> DataFrame:
    """First ``k`` of each race's ranking."""
    return df.filter(F.col(pos) <= k)


# --------------------------------------------------------------------- W4
def prior_form(df: DataFrame, value: str = K.TARGET, driver: str = "DriverId",
               season: str = "Season", round_col: str = "Round",
               tiebreak: str = "DriverNumber") -> DataFrame:
    """``_last1`` (lag 1), ``_last2``/``_last5`` (mean of the previous 2/5
    races of the driver), ``_season_to_date`` (mean of earlier races this
    season)."""
    order = [F.col(season), F.col(round_col), F.col(tiebreak)]
    by_driver = Window.partitionBy(driver).orderBy(*order)
    by_season = Window.partitionBy(driver, season).orderBy(*order)
    v = F.col(value)
    return df.withColumns({
        f"{value}_last1": F.lag(v, 1).over(by_driver),
        f"{value}_last2": F.avg(v).over(by_driver.rowsBetween(-2, -1)),
        f"{value}_last5": F.avg(v).over(by_driver.rowsBetween(-5, -1)),
        f"{value}_season_to_date": F.avg(v).over(
            by_season.rowsBetween(Window.unboundedPreceding, -1)),
    })


# --------------------------------------------------------------------- W5
def race_targets(df: DataFrame, finish: str = "FinishTime_s",
                 race: Sequence[str] = K.RACE, position: str = "Position") -> DataFrame:
    """``DeviationFromAvg_s`` = finish time - race mean (group-by + join,
    partial aggregation map-side); ``DeltaFromAhead_s`` = gap to the finisher
    one position ahead (keyed self-join on ``Position - 1``)."""
    race = list(race)
    # written: the join knows its size and leaves ``df`` where it is
    means = write_table(df.groupBy(*race).agg(F.avg(finish).alias("_race_avg")), "race_means")
    ahead = df.select(*race, (F.col(position) + 1).alias(position),
                      F.col(finish).alias("_ahead"))
    return (df.join(means, race)
              .join(ahead, [*race, position], "left")
              .withColumn(K.TARGET, F.col(finish) - F.col("_race_avg"))
              .withColumn("DeltaFromAhead_s", F.col(finish) - F.col("_ahead"))
              .drop("_race_avg", "_ahead"))


# --------------------------------------------------------------------- W6
def tertile_edges(df: DataFrame, value: str) -> DataFrame:
    """1-row frame: min, 1/3 and 2/3 linear-interpolated quantiles, max."""
    v = F.col(value)
    e = exact_quantiles(df, {value: v}, [0.0, 1.0 / 3.0, 2.0 / 3.0, 1.0])
    return e.agg(*[F.max(F.when(F.col("p") == i, F.col("q"))).alias(f"_e{i}") for i in range(4)])


def tertile_label(df: DataFrame, value: str, out: str,
                  edges: DataFrame | None = None) -> DataFrame:
    """Low / med / high with right-closed bins like ``qcut(.., 3)``.

    ``edges`` (default: computed on ``df``) is a 1-row frame, so the
    cross join is a broadcast of exactly one row.  Duplicate edges raise.
    """
    e = F.broadcast(edges if edges is not None else tertile_edges(df, value))
    v = F.col(value)
    dup = ((F.col("_e0") == F.col("_e1")) | (F.col("_e1") == F.col("_e2"))
           | (F.col("_e2") == F.col("_e3")))
    lab = (F.when(dup, F.raise_error(F.lit("tertile bin edges must be unique")))
            .when(v.isNull(), F.lit(None))
            .when(v <= F.col("_e1"), F.lit("low"))
            .when(v <= F.col("_e2"), F.lit("med"))
            .otherwise(F.lit("high")))
    return df.crossJoin(e).withColumn(out, lab.cast("string")).drop("_e0", "_e1", "_e2", "_e3")


# --------------------------------------------------------------------- W7
def top_k_per_row(wide: DataFrame, key: Sequence[str], features: Sequence[str], k: int,
                  feature: str = "feature", value: str = "contribution",
                  out: str = "rank") -> DataFrame:
    """The ``k`` largest |value| per row key (ties by feature name) of
    the columns ``features``.  The wide rows meet by key before they become
    long, so a row is shuffled once and not once a feature."""
    n = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = wide.repartition(n, *key).select(*key, F.inline(F.array(*[
        F.struct(F.lit(c).alias(feature), F.col(f"`{c}`").alias(value)) for c in features])))
    w = Window.partitionBy(*key).orderBy(F.abs(F.col(value)).desc(), F.col(feature))
    return (long.withColumn(out, F.row_number().over(w).cast("bigint"))
                .filter(F.col(out) <= k))
