"""Exact selection against numpy, with brackets forced to shrink over several scans."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.operators import aggregates as A
from pitwall.operators import quantiles as Q
from pitwall.operators import windows as W


def rows(n, seed):
    rnd = random.Random(seed)
    return [(rnd.choice(["a", "b", None]), rnd.random(), math.exp(rnd.gauss(0, 30)), 7.0, float(rnd.choice([0, 0, 0, 0, 1, 2, 50])),
             rnd.choice([None, float("nan"), float(rnd.randint(-5, 5))]), None) for _ in range(n)]


SCHEMA = "g string, uniform double, wide double, constant double, ties double, gaps double, nothing double"
COLS = ["uniform", "wide", "constant", "ties", "gaps", "nothing"]


def want(values, p):
    v = [x for x in values if x is not None and not math.isnan(x)]
    return float(np.quantile(v, p)) if v else None


def near(a, b):
    return a is b if a is None or b is None else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("limit", [1, 40, 10**6])
def test_quantiles_equal_numpy(spark, limit):
    data = rows(5000, limit)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    probs = [0.0, 1 / 3, 0.5, 0.999, 1.0]
    got = {(r.column, r.p): r.q for r in Q.exact_quantiles(df, {c: F.col(c) for c in COLS}, probs, limit=limit).collect()}
    for i, c in enumerate(COLS):
        for p, prob in enumerate(probs):
            assert near(got.get((c, p)), want([r[i + 1] for r in data], prob)), (c, prob)
    groups = {(r.g, r.column): r.q for r in Q.exact_quantiles(
        df, {c: F.col(c) for c in COLS}, [0.5], ["g"], limit).collect()}
    for g in ("a", "b", None):
        for i, c in enumerate(COLS):
            assert near(groups.get((g, c)), want([r[i + 1] for r in data if r[0] == g], 0.5)), (g, c)


def test_medians_hold_no_value_map(spark):
    df = spark.createDataFrame(rows(300, 3), SCHEMA)
    row = A.column_medians(df, COLS)
    plan = row._jdf.queryExecution().toString()
    assert "median(" not in plan and " percentile(" not in plan
    r = row.first()
    assert r.constant == 7.0 and r.nothing is None
    assert A.column_medians(df.limit(0), COLS).first().uniform is None
    assert A.column_medians(df, COLS).count() == 1


def test_tertile_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "v double")
    e = W.tertile_edges(df, "v").first()
    assert (e._e0, e._e1, e._e2, e._e3) == (0.0, 3.0, 6.0, 9.0)
