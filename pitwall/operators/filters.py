"""Projections, filters and predicates (F1-F11) and feature contracts (V1-V6).

Everything here is a plain ``select``/``filter`` built from the schema on
the driver (metadata only), so Catalyst prunes columns and pushes predicates
into the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall import constants as K
from pitwall.operators.aggregates import column_medians


# --------------------------------------------------------------------- F1
def season_split(df: DataFrame, train=(2023,), val=(2024,), test=(2025,),
                 season: str = "Season", out: str = "split") -> DataFrame:
    s = F.col(season)
    return df.withColumn(out, F.when(s.isin(list(train)), "train")
                                .when(s.isin(list(val)), "val")
                                .when(s.isin(list(test)), "test"))


# --------------------------------------------------------------------- F2
def val_season_or_fallback(df: DataFrame, val_season: int, season: str = "Season") -> DataFrame:
    """1-row frame ``val_season``: the requested season if present, else the
    second-largest distinct season (a scalar subquery, never collected)."""
    seasons = df.select(F.col(season).alias("s")).distinct()
    ranked = seasons.agg(
        F.max(F.when(F.col("s") == val_season, F.col("s"))).alias("_hit"),
        F.sort_array(F.collect_set("s"), asc=False).alias("_all"))
    return ranked.select(F.coalesce(F.col("_hit"), F.try_element_at("_all", F.lit(2)))
                         .alias("val_season"))


# --------------------------------------------------------------------- F3
def drop_null_target(df: DataFrame, target: str = K.TARGET) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


# --------------------------------------------------------------------- F4
def drop_lapped(df: DataFrame, must_keep: bool = False) -> DataFrame:
    """Keep rows whose Status is not 'Lapped' (NULL Status kept); one-hot
    fallback ``Status__Lapped`` / ``Status__Lapped.0`` != 1 (NULL kept).
    ``must_keep`` (training, scoring): raises when nothing is left."""
    kept = df
    if "Status" in df.columns:
        kept = df.filter(~F.col("Status").eqNullSafe("Lapped"))
    else:
        for c in ("Status__Lapped", "Status__Lapped.0"):
            if c in df.columns:
                kept = df.filter(~F.col(f"`{c}`").eqNullSafe(1))
                break
    if must_keep:
        require_rows(kept, "every entry is lapped")
    return kept


# --------------------------------------------------------------------- F5
def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


# --------------------------------------------------------------------- F6
def drop_helpers(df: DataFrame, cols: Iterable[str] = K.DROP_ROLE) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


# --------------------------------------------------------------------- F7
def default_settings() -> dict:
    """The race-day defaults as settings columns (tyre one-hot, Rain 0/1)."""
    s = {k: v for k, v in K.DEFAULT_SETTINGS.items() if k != "tire"}
    return s | {"Rain": int(s["Rain"])} | {t: int(t == K.DEFAULT_SETTINGS["tire"]) for t in K.TYRES}


def settings_frame(df: DataFrame, settings: DataFrame | None = None, columns: Sequence[str] = K.APP_RAW_COLUMNS,
                   on: Sequence[str] | None = None, defaults: bool = False) -> DataFrame:
    """Fixed-column model input: every column of ``columns`` taken from the
    entry row, else from the race settings, else 0.

    ``settings`` is one row per race (joined on ``on``) or a single row
    (``on=None``: cross join with exactly one broadcast row).  Without
    settings, and with ``defaults`` where a race has none, the race-day
    defaults hold.
    """
    given = default_settings() if defaults or settings is None else {}
    if settings is None:
        have = set(df.columns)
        keep = [c for c in K.KEY if c in have]
        return df.select(*keep, *[(F.col(f"`{c}`") if c in have else F.lit(given.get(c, 0))).alias(c) for c in columns])
    if on:
        joined = df.join(settings, list(on), "left")
    else:
        # one row; further settings rows fail the job instead of being dropped
        cols = [c for c in settings.columns]
        one = settings.agg(F.count(F.lit(1)).alias("_n"), *[F.first(F.col(f"`{c}`")).alias(c) for c in cols])
        one = one.filter(F.when(F.col("_n") <= 1, F.col("_n") == 1).otherwise(F.raise_error(
            F.lit("settings must have one row")).cast("boolean"))).drop("_n")
        joined = df.crossJoin(F.broadcast(one))
    have = set(df.columns) | set(settings.columns)
    keep = [c for c in K.KEY if c in df.columns]
    own = set(df.columns)
    return joined.select(*keep, *[
        (F.lit(given.get(c, 0)) if c not in have else F.coalesce(F.col(f"`{c}`"), F.lit(given[c]))
         if c in given and c not in own else F.col(f"`{c}`")).alias(c) for c in columns])


# --------------------------------------------------------------------- F8
def numeric_columns(df: DataFrame) -> list[str]:
    """The numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --------------------------------------------------------------------- F9
def is_leakage(name: str, target: str = K.TARGET) -> bool:
    return (name == target or name in K.LEAKAGE_TARGET_NAMES
            or "DeviationFromAvg" in name or name in K.LEAKAGE_EXACT
            or "time" in name.lower() or name.startswith("ClassifiedPosition")
            or name.startswith(K.LEAKAGE_IDENTITY_PREFIXES))


def mask_leakage(df: DataFrame, cols: Sequence[str] | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Set (not drop) leakage columns to 0.0 so the model width is kept."""
    cols = list(cols or df.columns)
    return df.select(*[
        (F.lit(0.0).alias(c) if (c in cols and c not in keep and is_leakage(c))
         else F.col(f"`{c}`")) for c in df.columns])


# -------------------------------------------------------------------- F10
def name_rule_filter(col: str | Column, exact: Sequence[str] = (), prefixes: Sequence[str] = (),
                     contains: Sequence[str] = (), contains_ci: Sequence[str] = ()) -> Column:
    """Predicate keeping names that hit none of the rules."""
    c = F.col(col) if isinstance(col, str) else col
    cond = F.lit(True)
    if exact:
        cond = cond & ~c.isin(list(exact))
    for p in prefixes:
        cond = cond & ~c.startswith(p)
    for s in contains:
        cond = cond & ~c.contains(s)
    for s in contains_ci:
        cond = cond & ~F.lower(c).contains(s.lower())
    return cond


def summary_name_filter(col: str = "feature") -> Column:
    return name_rule_filter(col, exact=K.SUMMARY_EXACT, prefixes=K.SUMMARY_PREFIXES,
                            contains=("DeviationFromAvg",), contains_ci=("time",))


# -------------------------------------------------------------------- F11
def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------------ V1-V6
def _missing(df: DataFrame, c: str) -> Column:
    v = F.col(f"`{c}`")
    return v.isNull() | F.isnan(v) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else v.isNull()


def contract_report(df: DataFrame, contract: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """U4/V1/V6 as a frame, one scan: (column, position, status, n_rows,
    n_missing) for every contract column (``present`` or ``missing``) and every
    other one but ``keep`` (``extra``, no position).  ``n_missing`` counts NULL
    and NaN; a missing column has none of its rows."""
    want = list(contract)
    rows = [(c, i, "present" if c in df.columns else "missing") for i, c in enumerate(want)]
    rows += [(c, None, "extra") for c in df.columns if c not in want and c not in keep]
    n = F.count(F.lit(1))
    stats = df.agg(n.alias("n"), *[F.count_if(_missing(df, c) if c in df.columns else F.lit(True)).alias(f"m{i}")
                                   for i, (c, _, _) in enumerate(rows)])
    return stats.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(p).cast("int").alias("position"), F.lit(s).alias("status"),
        F.col("n").alias("n_rows"), F.col(f"m{i}").alias("n_missing")) for i, (c, p, s) in enumerate(rows)])).alias("r")).select("r.*")


def missing_column_report(df: DataFrame, expected: Sequence[str] = K.EXPECTED_INPUT_COLUMNS) -> DataFrame:
    """V1: which expected columns are there, and how many of their rows lack a value."""
    return (contract_report(df.select(*[F.col(f"`{c}`") for c in df.columns if c in expected]), expected)
            .select("column", (F.col("status") == "present").alias("present"), "n_rows", "n_missing"))


def fill_absent_from_medians(df: DataFrame, reference: DataFrame,
                             features: Sequence[str] = K.MINIMAL_FEATURES) -> DataFrame:
    """V2: absent features take the reference table's median (else 0)."""
    absent = [c for c in features if c not in df.columns]
    if not absent:
        return df
    present_ref = [c for c in absent if c in reference.columns]
    meds = column_medians(reference, present_ref) if present_ref else None
    out = df.crossJoin(F.broadcast(meds)) if meds is not None else df
    return out.withColumns({c: F.coalesce(F.col(f"`{c}`") if c in present_ref else F.lit(None),
                                          F.lit(0.0)).cast("double") for c in absent})


def align_to_contract(df: DataFrame, contract: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """V3: exactly the contract columns in order; absent ones filled with 0.0."""
    return df.select(*[F.col(f"`{k}`") for k in keep], *[
        (F.col(f"`{c}`").cast("double") if c in df.columns else F.lit(0.0)).alias(c)
        for c in contract])


def assert_contract(columns: DataFrame | Sequence[str], contract: Sequence[str], exact: bool = False) -> None:
    """V4: strict by name — a missing contract column raises (no pad/truncate).
    ``exact`` (a model's matrix): so do extra columns and another order."""
    have = list(columns.columns if isinstance(columns, DataFrame) else columns)
    missing = [c for c in contract if c not in have]
    extra = [c for c in have if c not in set(contract)] if exact else []
    if missing or extra:
        raise ValueError(f"input does not satisfy the model contract; missing {missing}"
                         + (f", extra {extra}" if exact else ""))
    if exact and have != list(contract):
        raise ValueError(f"the model contract has the same columns in another order: {list(contract)}")


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """V6: required-column errors."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing required columns {missing}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"no rows left: {what}")
