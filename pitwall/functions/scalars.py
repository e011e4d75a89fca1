"""Scalar column expressions.

Every function takes Column(s) or column names and returns a ``Column`` built
only from built-in Spark expressions, so it stays inside whole-stage codegen
and runs unchanged in batch and streaming plans.  ANSI mode is on by
default in Spark 4, so parsing uses ``try_cast`` / ``try_element_at``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitwall import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _double(x) -> Column:
    return _c(x).try_cast("double")


def nan_to_null(x) -> Column:
    """NaN and NULL both mean "missing"; normalise NaN to NULL."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


# --------------------------------------------------------------------- P1
def quali_time_to_seconds(x) -> Column:
    """``m:ss.sss`` -> seconds.  NULL/'' -> 0.0; exactly two ``:``-parts
    that both parse -> m*60+s; anything else -> 0.0 (never NULL)."""
    s = _c(x).cast("string")
    parts = F.split(s, ":", -1)
    mins = F.try_element_at(parts, F.lit(1)).try_cast("double")
    secs = F.try_element_at(parts, F.lit(2)).try_cast("double")
    val = mins * F.lit(60.0) + secs
    ok = (F.size(parts) == 2) & val.isNotNull() & ~F.isnan(val) & (F.abs(val) < F.lit(float("inf")))
    return (F.when(s.isNull() | (s == ""), F.lit(0.0))
             .when(ok, val)
             .otherwise(F.lit(0.0)))


# --------------------------------------------------------------------- P2
def trim_unicode(x) -> Column:
    """Strip leading/trailing Unicode whitespace (SQL ``trim`` strips spaces only)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def clean_driver_name(x) -> Column:
    """``'  Max VerstappenVER '`` -> ``'Max Verstappen'``.

    strip -> split lowerUpper -> drop a trailing 2-4 capital code at a word
    boundary -> strip -> collapse whitespace.  NULL stays NULL.
    """
    s = trim_unicode(_c(x))
    s = F.regexp_replace(s, r"([a-z])([A-Z])", "$1 $2")
    s = F.regexp_replace(s, r"(?U)\b[A-Z]{2,4}$", "")
    s = trim_unicode(s)
    return F.regexp_replace(s, r"(?U)\s+", " ")


# --------------------------------------------------------------------- P3
def avg_quali_time(q1, q2, q3) -> Column:
    """Mean of the parsed Q1..Q3 over non-null, non-empty values.

    An unparseable value counts as 0.0 (it drags the mean, as in the
    original behaviour); all three missing -> NULL.
    """
    arr = F.array(_c(q1).cast("string"), _c(q2).cast("string"), _c(q3).cast("string"))
    present = F.filter(arr, lambda t: t.isNotNull() & (t != ""))
    total = F.aggregate(F.transform(present, quali_time_to_seconds),
                        F.lit(0.0), lambda acc, v: acc + v)
    n = F.size(present)
    return F.when(n > 0, total / n)


# --------------------------------------------------------------------- P4
_TIMEDELTA_RE = r"^\s*(-?\d+) days?\s*\+?(\d+):(\d+):(\d+(?:\.\d+)?)\s*$"


def timedelta_to_seconds(x) -> Column:
    """``'0 days 01:32:10.510000'`` -> 5530.51 seconds; unparseable -> NULL."""
    s = _c(x).cast("string")
    ok = s.rlike(_TIMEDELTA_RE)
    d = F.regexp_extract(s, _TIMEDELTA_RE, 1).try_cast("double")
    h = F.regexp_extract(s, _TIMEDELTA_RE, 2).try_cast("double")
    m = F.regexp_extract(s, _TIMEDELTA_RE, 3).try_cast("double")
    sec = F.regexp_extract(s, _TIMEDELTA_RE, 4).try_cast("double")
    return F.when(ok, d * 86400.0 + h * 3600.0 + m * 60.0 + sec)


# --------------------------------------------------------------------- P5
def duration_seconds(start, end) -> Column:
    """``end - start`` in seconds when both are non-null timestamps.

    ``timestamp_diff`` in microseconds works on zone-less timestamps without
    a session-time-zone conversion (no DST shift)."""
    return F.when(_c(start).isNotNull() & _c(end).isNotNull(),
                  F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6))


# ------------------------------------------------------------------ P6/P7
def _token_lookup(s: Column, tokens: dict) -> Column:
    expr = None
    for tok, v in tokens.items():
        expr = (F.when(s == tok, F.lit(v)) if expr is None
                else expr.when(s == tok, F.lit(v)))
    return expr


def normalize_rain(x, mode: str = "tokens", dtype=None) -> Column:
    """Rain -> 0/1 integer.

    ``mode="tokens"`` (default): exact token map, else text containing
    ``rain`` -> 1, else 0.  ``mode="contains"``: 1 iff the text contains
    ``rain`` (so ``NoRain`` -> 1, kept only for comparison).  ``mode="strict"``:
    token map without true/false and without the substring rule.
    Numeric/boolean inputs (``dtype`` given as a Spark type name) are mapped
    by value (non-zero -> 1) instead of via their text form.
    """
    c = _c(x)
    if dtype is not None and dtype != "string":
        v = c.cast("double")
        return F.when(v.isNotNull() & ~F.isnan(v) & (v != 0), F.lit(1)).otherwise(F.lit(0))
    s = F.lower(trim_unicode(c.cast("string")))
    if mode == "contains":
        return F.when(s.contains("rain"), F.lit(1)).otherwise(F.lit(0))
    tokens = K.RAIN_TOKENS if mode == "tokens" else K.RAIN_TOKENS_STRICT
    mapped = _token_lookup(s, tokens)
    if mode == "tokens":
        mapped = mapped.when(s.contains("rain"), F.lit(1))
    return mapped.otherwise(F.lit(0))


# --------------------------------------------------------------------- P8
def safe_number(x, default: float | None = 0.0) -> Column:
    """Coerce to double; unparseable/NaN -> NULL -> ``default``."""
    v = nan_to_null(_double(x))
    return v if default is None else F.coalesce(v, F.lit(float(default)))


# --------------------------------------------------------------------- P9
def wind_sin(x) -> Column:
    return F.sin(F.radians(F.coalesce(_double(x), F.lit(0.0))))


def wind_cos(x) -> Column:
    return F.cos(F.radians(F.coalesce(_double(x), F.lit(0.0))))


# -------------------------------------------------------------------- P11
def map_rare(x, rare_values) -> Column:
    """NULL -> 'missing', then a value in ``rare_values`` -> 'OTHER'."""
    v = F.coalesce(_c(x).cast("string"), F.lit("missing"))
    return F.when(v.isin(list(rare_values)), F.lit("OTHER")).otherwise(v)


# -------------------------------------------------------------------- P12
def _threshold_label(x, table, default: str) -> Column:
    c = _c(x)
    expr = None
    for lo, name in table:
        expr = (F.when(c >= lo, F.lit(name)) if expr is None
                else expr.when(c >= lo, F.lit(name)))
    return expr.otherwise(F.lit(default))


def air_temp_label(x) -> Column:
    return _threshold_label(x, K.AIR_TEMP_LABELS, "cool")


def humidity_label(x) -> Column:
    return _threshold_label(x, K.HUMIDITY_LABELS, "dry")


# -------------------------------------------------------------------- P13
def argmax_name(cols, names=None) -> Column:
    """Name of the largest column, first in order on ties."""
    names = list(names or cols)
    arr = F.array(*[_c(c).cast("double") for c in cols])
    pos = F.array_position(arr, F.array_max(arr))
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), pos.cast("int"))


# -------------------------------------------------------------------- P14
def cluster_description(cluster, n, temp_label, hum_label, tyre) -> Column:
    """``Cluster k: n rows — warm, humid, dominant tyre: SOFT``."""
    parts = F.concat_ws(", ", _c(temp_label), _c(hum_label),
                        F.concat(F.lit("dominant tyre: "), _c(tyre)))
    return F.concat(F.lit("Cluster "), _c(cluster).cast("string"), F.lit(": "),
                    _c(n).cast("string"), F.lit(" rows — "), parts)


# -------------------------------------------------------------------- P15
def residual_bin(resid, sigma) -> Column:
    r, s = _c(resid), _c(sigma)
    return (F.when(r <= -s, F.lit("overperform"))
             .when(r <= s, F.lit("close"))
             .otherwise(F.lit("underperform")))


# -------------------------------------------------------------------- P16
def tyre_flag(choice, tyre: str) -> Column:
    return (_c(choice) == F.lit(tyre)).cast("int")


# -------------------------------------------------------------------- P17
def map_feature_name(x) -> Column:
    """``num__X`` -> ``X``; ``cat__Col_val`` -> ``Col__val``; else unchanged."""
    c = _c(x)
    return (F.when(c.startswith("num__"), F.regexp_replace(c, r"^num__", ""))
             .when(c.startswith("cat__"),
                   F.regexp_replace(F.regexp_replace(c, r"^cat__", ""), r"^([^_]*)_", "$1__"))
             .otherwise(c))


# -------------------------------------------------------------------- P18
def clip(x, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest`` alone would skip it)."""
    c = _c(x)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


# -------------------------------------------------------------------- P19
def display_round(x, digits: int = 3) -> Column:
    return F.round(_c(x), digits)


def display_fixed(x, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", _c(x))


# -------------------------------------------------------------------- P21
def grid_position(x) -> Column:
    """Text grid position -> int; 'NC'/'DQ'/junk -> NULL (reported by contracts)."""
    return trim_unicode(_c(x).cast("string")).try_cast("int")


# ---------------------------------------------------- portable seeded hash
def portable_bucket(key, m: int, seed: int = 0) -> Column:
    """60 bits of ``md5(seed ':' key)``, modulo ``m``.

    Deterministic and identical in any SQL engine; another seed gives an
    independent assignment.  Used for seeded folds / splits / samples (T4-T6).
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"), F.lit(m))


def portable_unit(key, seed: int = 0, buckets: int = 1_000_003) -> Column:
    """Seeded pseudo-uniform value in [0, 1) derived from ``portable_bucket``."""
    return portable_bucket(key, buckets, seed) / F.lit(float(buckets))
