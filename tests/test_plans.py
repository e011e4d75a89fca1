"""Physical-plan properties the design relies on (checked with explain)."""
import re

from pitwall.sources import rig
from pitwall.plans.features import race_features
from helpers import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lineitem_scan_is_pruned(spark):
    p = plan(rig.per_order_lines(spark, SF_SMALL))
    assert "l_shipdate" not in p and "l_partkey" not in p and "l_suppkey" not in p
    assert "HashAggregate" in p


def test_entry_aggregate_is_hash_based(spark):
    e = rig.race_entries(spark, SF_SMALL, "nation")
    assert "SortAggregate" not in plan(e)


def test_feature_windows_share_one_driver_shuffle(spark):
    e = rig.race_entries(spark, SF_SMALL, "nation")
    p = plan(race_features(e))
    # the per-driver windows and the (Season, DriverId) windows share the
    # DriverId hash partitioning: no separate (Season, DriverId) exchange
    assert "hashpartitioning(DriverId" in p
    assert not re.search(r"hashpartitioning\(Season#\d+L?, DriverId", p)
    assert p.count("Window [") >= 3


def test_orders_scan_projects_needed_columns(spark):
    p = plan(rig.race_entries(spark, SF_SMALL, "customer"))
    assert "o_orderpriority" not in p
    assert "c_acctbal" not in p and "c_mktsegment" not in p


def test_feature_table_scans_prune_seasons_and_columns(spark):
    import __spark_entry__ as E
    q = E.queries()["J3_truth_prediction_join"](spark, SF_SMALL)
    p = plan(q)
    assert "PartitionFilters: [" in p or "PartitionFilters" in q._jdf.queryExecution().toString()
    fmt = q._jdf.queryExecution().explainString(
        q.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Season" in fmt and "= 1999" in fmt
    assert "ReadSchema: struct<Round:bigint,DriverNumber:bigint,DeviationFromAvg_s:double>" in fmt
