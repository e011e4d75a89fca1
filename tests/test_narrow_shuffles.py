"""Wide rows are shuffled once and narrow; the results are those of the long forms."""
import datetime as dt

from pyspark.sql import functions as F

from pitwall.operators import joins as J
from pitwall.operators import windows as W
from pitwall.plans.features import feature_rows, race_features
from pitwall.sources import html_tables as H
from pitwall.sources import rig


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def tables(spark, folder) -> str:
    """Two nations and a customer without one; an order without a date, one without lines."""
    orders, lines = [], []
    for i in range(240):
        day = None if i == 7 else dt.datetime(1995 + i % 3, 1 + i % 4, 1 + i % 25)
        orders.append((i, i % 9, "FOP"[i % 3], 1000.0 + 37 * i, day))
        lines += [(i, k + 1, float(1 + i % 40), 900.0 + 13 * i + k, 0.01 * (i % 11), 0.01 * (i % 8), "RAN"[i % 3], "OF"[i % 2])
                  for k in range(i % 5)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp") \
        .write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                                 "l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(9)], "c_custkey long, c_nationkey int") \
        .write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "FRANCE"), (1, "UNITED KINGDOM")], "n_nationkey int, n_name string") \
        .write.parquet(f"{folder}/nation.parquet")
    return str(folder)


def test_feature_rows_travel_narrow(spark, tmp_path):
    sf = tables(spark, tmp_path)
    for grain in ("customer", "nation"):
        got, want = feature_rows(spark, sf, grain), race_features(rig.race_entries(spark, sf, grain))
        assert got.dtypes == want.dtypes and rows(got) == rows(want) and got.count() >= 20
    below = optimized(feature_rows(spark, sf, "customer")).split("Window [", 1)[1]
    # texts and race columns come after the joins and windows; nothing is cached
    assert "AirTemp_C" not in below and " days " not in below and "InMemoryRelation" not in below


def test_dependence_table_joins_wide_rows(spark):
    keys, names = ["s", "r"], ["a", "b", "c%"]
    wide = [(1, 1, 1.0, None, 3.0), (1, 2, 4.0, 5.0, 6.0), (1, 2, 7.0, 8.0, 9.0), (None, 3, 1.0, 1.0, 1.0), (2, 5, 0.0, 0.5, 2.0)]
    v = spark.createDataFrame(wide, "s int, r int, a double, b double, `c%` double")
    c = spark.createDataFrame([(*r[:2], *[None if x is None else -x for x in r[2:]]) for r in wide[:4]], v.schema)
    got = J.dependence_table(v, c, keys, names)
    want = v.unpivot(keys, [F.col(f"`{n}`") for n in names], "feature", "value").join(
        c.unpivot(keys, [F.col(f"`{n}`") for n in names], "feature", "contribution"), [*keys, "feature"])
    assert got.columns == ["s", "r", "feature", "value", "contribution"]
    assert rows(got) == rows(want.select(got.columns)) and got.count() == 15
    assert "Generate" in optimized(got).split("Join ")[0]      # long only after the join


def test_top_k_shuffles_wide_rows(spark):
    data = [(1, 3.0, -4.0, 4.0, None), (1, 9.0, 0.0, 1.0, 2.0), (2, 1.0, 1.0, 1.0, 1.0), (None, 1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(data, "k int, a double, b double, c double, d double")
    got = rows(W.top_k_per_row(df, ["k"], ["a", "b", "c", "d"], 3))
    want = []
    for key in (1, 2, None):
        long = [(n, x) for r in data if r[0] == key for n, x in zip("abcd", r[1:])]
        long.sort(key=lambda p: (p[1] is None, -abs(p[1] or 0.0), p[0]))
        want += [(key, n, x, i + 1) for i, (n, x) in enumerate(long[:3])]
    assert got == sorted(want, key=repr)


def test_extract_tables_with_one_shuffle(spark):
    page = ("<table><thead><tr><th>No.</th><th>Driver</th><th>No.</th></tr></thead><tbody>"
            "<tr><td>1</td><td> Max VerstappenVER</td><td>x</td></tr><tr><td>2</td></tr></tbody></table>")
    pages = spark.createDataFrame([(1, page), (2, page), (2, page), (3, None), (4, "<tbody><tr><td>1</td></tr></tbody>")],
                                  "page_id long, html string")
    got = H.extract_tables(pages, ["No.", "Driver", "Laps"])
    one = [(0, "x", "Max Verstappen", None), (1, "", "", None)]
    assert rows(got) == [(p, *r) for p in (1, 2) for r in one]
    assert optimized(got).count("Aggregate [") == 1
