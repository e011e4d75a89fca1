"""Exact quantiles without holding a group's values.

Spark's ``median``/``percentile`` merge a map of all distinct values into one
buffer per group.  Here a quantile is found by selection:

1. one scan gives count, least, largest and a sketch (``approx_percentile``
   on a grid) of every (group, column);
2. the sketch brackets the wanted rank by two values; the next scan counts
   exactly what lies below, on and between them, and sketches what lies
   between; the bracket becomes the part that holds the rank;
3. when at most ``limit`` values are left in every bracket, a last scan counts
   those by value and takes the one at the rank.

All columns, groups and ranks share each scan; a scan keeps one fixed-size
buffer per (group, column, rank), combined map-side.  A pass leaves about
1/300 of a bracket, so 10^12 rows take three passes.  A bracket that shrinks
to one value (constant columns, heavy ties) is done at once.  Brackets are
written tables, so the passes do not nest.

Quantiles are interpolated as Spark's ``percentile`` does, at (n - 1) * p.
NULL and NaN count as missing; a column without values gives NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.session import write_table

LIMIT = 200_000    # values of one bracket that may be counted by value
GRID = 1024        # steps of the sketch
ACCURACY = 10_000  # of the sketch: ranks are off by n / ACCURACY at most


def _sketch(x: Column) -> Column:
    return F.approx_percentile(x, [i / GRID for i in range(GRID + 1)], ACCURACY)


def _joined(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner", more: Column | None = None) -> DataFrame:
    """Null-safe join on ``keys``; the keys of ``a`` stay."""
    b = b.withColumnsRenamed({k: f"_b_{k}" for k in keys})
    on = F.lit(True) if more is None else more
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return a.join(b, on, how).drop(*[f"_b_{k}" for k in keys])


def _inside(long: DataFrame, t: DataFrame, by: Sequence[str]) -> DataFrame:
    """The values within the brackets."""
    return _joined(long, t, by, more=(F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")))


def _bracketed(t: DataFrame) -> DataFrame:
    """Adds a, b: sketched values around the rank (null sketch: the ends)."""
    place = (F.col("k") - F.col("below")) / F.greatest(F.col("inside") - 1, F.lit(1)) * GRID
    a = F.get("grid", F.greatest(F.floor(place) - 1, F.lit(0)).cast("int"))
    b = F.get("grid", F.least(F.ceil(place) + 1, F.lit(GRID)).cast("int"))
    return t.withColumns({"a": F.coalesce(a, F.col("lo")), "b": F.coalesce(b, F.col("hi"))})


def _narrowed(long: DataFrame, t: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The brackets ``t`` after one more scan."""
    t = _bracketed(t)
    key = [*by, "p", "r"]
    inner = _inside(long, t, by)
    x, a, b = F.col("x"), F.col("a"), F.col("b")
    parts = {"lt": x < a, "a": x == a, "mid": (x > a) & (x < b), "b": (x == b) & (a < b), "gt": x > b}
    seen = inner.groupBy(*key).agg(
        *[F.count(F.when(w, 1)).alias(f"n_{n}") for n, w in parts.items()],
        *[f(F.when(parts[n], x)).alias(f"{m}_{n}") for n in ("lt", "mid", "gt") for m, f in (("min", F.min), ("max", F.max))],
        _sketch(F.when(parts["mid"], x)).alias("grid_mid"))
    both = _joined(t, seen, key)
    # the part that holds the rank
    rank, before, pick = F.col("k") - F.col("below"), F.lit(0).cast("long"), None
    for n in parts:
        lo, hi = (F.col(n), F.col(n)) if n in "ab" else (F.col(f"min_{n}"), F.col(f"max_{n}"))
        now = F.struct(lo.alias("lo"), hi.alias("hi"), (F.col("below") + before).alias("below"),
                       F.col(f"n_{n}").alias("inside"),
                       (F.col("grid_mid") if n == "mid" else F.lit(None).cast("array<double>")).alias("grid"))
        before = before + F.col(f"n_{n}")
        pick = F.when(rank < before, now) if pick is None else pick.when(rank < before, now)
    new = both.withColumn("_s", pick)
    return new.select(*[F.col(f"_s.{c}").alias(c) if c in ("lo", "hi", "below", "inside", "grid") else F.col(c)
                        for c in names])


def exact_quantiles(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float],
                    group: Sequence[str] = (), limit: int = LIMIT) -> DataFrame:
    """(group..., column, p, q): quantile ``probs[p]`` of every column per group
    (no row where a group's column has no value)."""
    names = list(values)
    by = [*[f"_g{i}" for i in range(len(group))], "c"]
    long = df.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)], F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), values[n].cast("double").alias("x")) for i, n in enumerate(names)])).alias("_v")
    ).select(*by[:-1], "_v.c", "_v.x").where("x IS NOT NULL AND NOT isnan(x)")
    first = long.groupBy(*by).agg(F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                  _sketch(F.col("x")).alias("grid"))
    place = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("p") + 1) * (F.col("n") - 1)
    targets = (first.withColumn("p", F.explode(F.array(*[F.lit(i) for i in range(len(probs))])))
               .withColumn("place", place)
               .withColumn("r", F.explode(F.array(F.lit(0), F.lit(1))))
               .withColumn("k", F.when(F.col("r") == 0, F.floor("place")).otherwise(F.ceil("place")).cast("long"))
               .withColumns({"below": F.lit(0).cast("long"), "inside": F.col("n")}))
    columns = [*by, "p", "r", "k", "place", "lo", "hi", "below", "inside", "grid"]
    t, done = write_table(targets.select(*columns), "quantiles"), []
    wide = (F.col("lo") < F.col("hi")) & (F.col("inside") > limit)
    while not t.where(wide).isEmpty():
        done.append(t.where(~wide))
        t = write_table(_narrowed(long, t.where(wide), by, columns), "quantiles")
    for d in done:
        t = t.unionByName(d)
    t = t.drop("grid")
    # count what is left by value
    key = [*by, "p", "r"]
    left = t.where("lo < hi")
    counted = _inside(long, left, by).groupBy(*key, "k", "below", "x").agg(F.count(F.lit(1)).alias("m"))
    # the least value with more than k - below values up to it
    of = counted.groupBy(*key, "k", "below").agg(F.sort_array(F.collect_list(F.struct("x", "m"))).alias("v"))  # ``limit`` at most
    up_to = F.aggregate("v", F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("x")),
                        lambda s, e: F.struct((s["n"] + e["m"]).alias("n"), F.when(
                            s["x"].isNull() & (s["n"] + e["m"] > F.col("k") - F.col("below")), e["x"]).otherwise(s["x"]).alias("x")))
    found = of.select(*key, up_to["x"].alias("x"))
    ends = _joined(t, found, key, "left").select(*key, "place", F.coalesce("x", "lo").alias("x"))
    at = ends.groupBy(*by, "p", "place").agg(F.max(F.when(F.col("r") == 0, F.col("x"))).alias("a"),
                                             F.max(F.when(F.col("r") == 1, F.col("x"))).alias("b"))
    up = F.col("place") - F.floor("place")
    q = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((1 - up) * F.col("a") + up * F.col("b"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("c") + 1)
    return write_table(at.select(*[F.col(f"_g{i}").alias(g) for i, g in enumerate(group)], name.alias("column"),
                                 "p", q.alias("q")), "quantiles")


def quantile_row(df: DataFrame, values: Mapping[str, Column], p: float = 0.5, limit: int = LIMIT) -> DataFrame:
    """1-row frame with one column per value: its quantile (NULL without values)."""
    long = exact_quantiles(df, values, [p], limit=limit)
    return long.agg(*[F.max(F.when(F.col("column") == n, F.col("q"))).alias(n) for n in values])


def quantile_groups(df: DataFrame, group: str, values: Mapping[str, Column], p: float = 0.5,
                    limit: int = LIMIT) -> DataFrame:
    """One row per group with a column per value (groups without any value are absent)."""
    long = exact_quantiles(df, values, [p], [group], limit)
    return long.groupBy(group).agg(*[F.max(F.when(F.col("column") == n, F.col("q"))).alias(n) for n in values])
