"""Race feature table: raw entries -> model-ready features (Q4 building blocks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.functions import scalars as S
from pitwall.operators import windows as W
from pitwall.session import write_table
from pitwall.sources.rig import ENTRY_COLUMNS, entry_rows, race_rows


def add_quali_features(df: DataFrame) -> DataFrame:
    """P2 name cleaning + P3 average qualifying time (90.0 when Q columns are absent)."""
    if "Driver" in df.columns:
        df = df.withColumn("DriverRaw", F.col("Driver")).withColumn(
            "Driver", S.clean_driver_name("Driver"))
    if all(q in df.columns for q in ("Q1", "Q2", "Q3")):
        return df.withColumn("AvgQualiTime", S.avg_quali_time("Q1", "Q2", "Q3"))
    return df.withColumn("AvgQualiTime", F.lit(K.DEFAULT_AVG_QUALI_TIME))


def normalize_minimal(df: DataFrame, rain_mode: str = "tokens") -> DataFrame:
    """Rain -> 0/1, minimal numeric features -> double with NULL -> 0."""
    types = dict(df.dtypes)
    out = {}
    if "Rain" in df.columns:
        out["Rain"] = S.normalize_rain("Rain", rain_mode, dtype=types["Rain"])
    for c in ("PointsProp", "weather_tire_cluster", "GridPosition", "AvgQualiTime",
              "races_prior_this_season", *K.TYRES):
        if c in df.columns:
            out[c] = S.safe_number(c, 0.0)
    return df.withColumns(out)


def _texts(df: DataFrame) -> DataFrame:
    """ParsedTime_s, RainRaw and Rain 0/1: column expressions."""
    if "Time" in df.columns:
        df = df.withColumn("ParsedTime_s", S.timedelta_to_seconds("Time"))
    return df.withColumn("RainRaw", F.col("Rain")).withColumn("Rain", S.normalize_rain("Rain"))


def race_features(entries: DataFrame) -> DataFrame:
    """Entries -> cleaned names, AvgQualiTime, Rain 0/1, PointsProp, target,
    prior form.  Every step is a column expression or a keyed window."""
    df = W.race_targets(add_quali_features(entries))
    # Per-driver windows first: their hash partitioning on DriverId also
    # satisfies the (Season, DriverId) windows after them -> one shuffle.
    return _texts(W.points_prop(W.prior_form(df)))


def feature_rows(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """``race_features`` of the rig's entries: joins and windows run over the
    narrow entries, texts and race columns come after them."""
    base, grid, races = entry_rows(spark, sf_dir, grain)
    # the targets' self-join leaves the rows hashed by (Season, Round, Position)
    df = W.race_targets(base).join(grid, [*K.RACE, "Position"])
    df = W.points_prop(W.prior_form(df))
    made = [c for c in df.columns if c not in ENTRY_COLUMNS and c not in base.columns]
    out = _texts(add_quali_features(race_rows(df, races)))
    first = [*K.RACE, "Position"]
    return out.select(*[F.col(f"`{c}`") for c in (*first, *[c for c in ENTRY_COLUMNS if c not in first],
                                                  "DriverRaw", "AvgQualiTime", *made, "ParsedTime_s", "RainRaw")])


_TABLES: dict = {}


def features_memo(memo, build):
    """Get-or-build a session-scoped materialised object (tables are
    checkpointed, models fitted once per application)."""
    if memo not in _TABLES:
        _TABLES[memo] = build()
    return _TABLES[memo]


def race_table(spark: SparkSession, sf_dir: str, grain: str = "nation",
               materialize: bool = True) -> DataFrame:
    """The feature table, written once as parquet partitioned by Season in
    the shared checkpoint folder: every job reads it more than once
    (train/val/test splits, folds, restarts); the cut lineage keeps every
    downstream plan small (analysing and cache-matching a deep lineage had
    dominated the ML jobs); and season filters / column selections prune
    the scan.  Within one Spark application the table is reused."""
    if not materialize:
        return feature_rows(spark, sf_dir, grain)
    memo = (spark.sparkContext.applicationId, sf_dir, grain)
    if memo not in _TABLES:
        _TABLES[memo] = write_table(feature_rows(spark, sf_dir, grain),
                                    f"race_features_{grain}", ["Season"])
    return _TABLES[memo]


def clear_table_cache() -> None:
    for v in _TABLES.values():
        for x in (v if isinstance(v, tuple) else (v,)):
            if hasattr(x, "unpersist"):
                x.unpersist()
    _TABLES.clear()
