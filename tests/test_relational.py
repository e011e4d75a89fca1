"""Filters, joins, windows, aggregates: null semantics, ties, duplicates."""
import pytest
from pyspark.sql import functions as F

from pitwall.operators import aggregates as A
from pitwall.operators import filters as FL
from pitwall.operators import joins as J
from pitwall.operators import sampling as SM
from pitwall.operators import windows as W
from pitwall.operators.ranking import row_number_within


def test_drop_lapped_keeps_null(spark):
    df = spark.createDataFrame([("Lapped",), ("Finished",), (None,)], "Status string")
    assert sorted(r[0] or "" for r in FL.drop_lapped(df).collect()) == ["", "Finished"]
    oh = spark.createDataFrame([(1,), (0,), (None,)], "`Status__Lapped` int")
    assert FL.drop_lapped(oh).count() == 2


def test_points_prop(spark):
    rows = [(2024, 1, "a", "25", 0), (2024, 2, "a", "x", 1), (2024, 3, "a", "18", 2),
            (2024, None, "a", "10", 3), (2024, 2, None, "25", 4)]
    df = spark.createDataFrame(rows, "Season int, Round int, DriverId string, Points string, DriverNumber int")
    out = {r["DriverNumber"]: r["PointsProp"] for r in W.points_prop(df).collect()}
    assert out[0] == 0.0                      # races_prior 0 -> 0
    assert out[1] == 1.0                      # 25 / 25
    assert out[2] == pytest.approx(25 / 50)   # 'x' -> 0 points
    assert out[3] == 0.0                      # NULL round -> races_prior 0
    assert out[4] is None                     # no driver id -> no history


def test_points_prop_clip_sprint(spark):
    df = spark.createDataFrame([(1, 1, "a", 33.0, 0), (1, 2, "a", 0.0, 0)],
                               "Season int, Round int, DriverId string, Points double, DriverNumber int")
    assert max(r["PointsProp"] for r in W.points_prop(df).collect()) == 1.0


@pytest.mark.parametrize("method", ["window", "range"])
def test_rank_ties_and_nulls(spark, method):
    rows = [(1, 1, d, p) for d, p in [(3, 1.0), (1, 1.0), (2, None), (4, -2.0)]]
    df = spark.createDataFrame(rows, "Season int, Round int, DriverNumber int, prediction double")
    out = {r["DriverNumber"]: r["PredictedPosition"] for r in W.rank_predictions(df, method=method).collect()}
    assert out == {4: 1, 1: 2, 3: 3, 2: 4}


def test_range_rank_matches_window_on_hot_group(spark):
    df = spark.range(0, 5000).select(F.lit(1).alias("g"), F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
    a = row_number_within(df, ["g"], ["v", "id"], out="r", method="window")
    b = row_number_within(df, ["g"], ["v", "id"], out="r", method="range", num_partitions=16)
    assert a.select("id", "r").exceptAll(b.select("id", "r")).count() == 0
    assert b.count() == 5000


def test_range_rank_keeps_null_and_repeated_rows(spark):
    rows = [(1, None), (1, 2), (None, 1), (None, 3), (None, None), (1, 2), (2, 5)]
    df = spark.createDataFrame(rows, "g int, v int")
    a, b = (sorted(map(tuple, row_number_within(df, ["g"], ["v"], out="r", method=m).collect()), key=repr)
            for m in ("window", "range"))
    assert a == b and len(b) == len(rows)


def test_seeds_give_other_balanced_folds(spark):
    df = spark.sql("SELECT 2000 AS Season, 1 + id DIV 25 AS Round, 1 + id % 25 AS DriverNumber FROM range(2000)")
    folds = {seed: [r.fold for r in SM.assign_folds(df, SM.entry_id(), 5, seed).collect()] for seed in (1, 42)}
    assert sum(a == b for a, b in zip(folds[1], folds[42])) < 0.3 * 2000
    for f in folds.values():
        assert all(330 < f.count(k) < 470 for k in range(5))
        by_driver = [f[i::25] for i in range(25)]
        assert all(len(set(x)) == 5 for x in by_driver)
    samples = [{tuple(r) for r in SM.seeded_sample(df, 100, SM.entry_id(), s).collect()} for s in (1, 2)]
    assert len(samples[0] & samples[1]) < 30
    big = spark.sql("SELECT 2000 AS Season, r AS Round, d AS DriverNumber FROM VALUES (1, 1000005), (2, 5) AS t(r, d)")
    assert big.select(SM.entry_id().alias("k")).distinct().count() == 2


def test_two_settings_rows_fail(spark):
    df = spark.createDataFrame([(1,)], "Season int")
    one = spark.createDataFrame([(25.0,)], "AirTemp_C double")
    assert FL.settings_frame(df, one, ["AirTemp_C"]).first()["AirTemp_C"] == 25.0
    with pytest.raises(Exception, match="one row"):
        FL.settings_frame(df, one.union(one), ["AirTemp_C"]).collect()


def test_duplicate_right_key_raises(spark):
    left = spark.createDataFrame([(1, 1, 1)], "DriverNumber int, Season int, Round int")
    right = spark.createDataFrame([(1, 1, 1, 0.1), (1, 1, 1, 0.2)],
                                  "DriverNumber int, Season int, Round int, PointsProp double")
    with pytest.raises(Exception, match="duplicate join key"):
        J.fallback_join(left, right).collect()


def test_unmatched_left_rows_kept(spark):
    left = spark.createDataFrame([(1, 1, 1), (2, 1, 1)], "DriverNumber int, Season int, Round int")
    right = spark.createDataFrame([(1, 1, 1, 0.1)], "DriverNumber int, Season int, Round int, PointsProp double")
    assert J.fallback_join(left, right).count() == 2


def test_medians(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, None), (4.0, None)], "a double, b double")
    r = A.column_medians(df, ["a", "b"]).first()
    assert r["a"] == 2.5 and r["b"] is None


def test_metrics_constant_truth_and_single_row(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, -1.0)], "y_true double, y_pred double")
    r = A.regression_metrics(df).first()
    assert r["r2"] == 0.0 and r["rmse"] == 1.0 and r["n"] == 2
    one = spark.createDataFrame([(2.0, 2.0)], "y_true double, y_pred double")
    assert A.regression_metrics(one).first()["r2"] == 1.0


def test_tertiles_duplicate_edges_raise(spark):
    df = spark.createDataFrame([(1.0,)] * 6, "v double")
    with pytest.raises(Exception, match="unique"):
        W.tertile_label(df, "v", "t").collect()


def test_histogram_max_in_last_bin(spark):
    df = spark.range(0, 41).select(F.col("id").cast("double").alias("v"))
    h = {r["bin"]: r["count"] for r in A.histogram(df, "v", 40).collect()}
    assert sum(h.values()) == 41 and max(h) == 40 and h[40] == 2


def test_leakage_mask_names():
    assert FL.is_leakage("AvgQualiTime")         # contains 'time' (kept behaviour)
    assert FL.is_leakage("cat__Driver_x") and FL.is_leakage("ClassifiedPosition__1")
    assert not FL.is_leakage("GridPosition")


def test_contract_strict(spark):
    df = spark.createDataFrame([(1.0,)], "GridPosition double")
    with pytest.raises(ValueError):
        FL.assert_contract(df, ["GridPosition", "AvgQualiTime"])
    out = FL.align_to_contract(df, ["AvgQualiTime", "GridPosition"])
    assert out.columns == ["AvgQualiTime", "GridPosition"] and out.first()["AvgQualiTime"] == 0.0
