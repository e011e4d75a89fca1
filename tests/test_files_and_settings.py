"""S3 over many files of differing headers, F7 defaults, A15, P10 scope."""
import pytest
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.operators import aggregates as A
from pitwall.operators import filters as FL
from pitwall.operators import trees as TR
from pitwall.sources import files as IO


def jobs(spark, run):
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted")
    try:
        out = run()
        return out, len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_of_differing_headers(spark, tmp_path):
    for i in range(300):
        head, line = [("y_true,y_pred", f"{i},1.5"), ("index,y_pred,y_true", f'"7, x",1.5,{i}'),
                      (" y_pred , note,y_true", f"1.5,,{i}")][i % 3]
        (tmp_path / f"val_predictions_m{i}.csv").write_text(f"{head}\n{line}\n\nbad,worse,none\n")
    (tmp_path / "val_predictions_short.csv").write_text("y_true,other\n1,2\n")
    (tmp_path / "val_predictions_empty.csv").write_text("")
    args = (spark, f"file://{tmp_path}/val_predictions_*.csv", r"val_predictions_([^/]+)\.csv")
    (rows, files), n = jobs(spark, lambda: IO.prediction_files(*args))
    assert n <= 5
    got = {(r.model, r.y_true, r.y_pred) for r in rows.where("y_true IS NOT NULL").collect()}
    assert got == {(f"m{i}", float(i), 1.5) for i in range(300)}
    reasons = {r.model: r.reason for r in files.where("reason IS NOT NULL").collect()}
    assert reasons == {"short": "no column y_pred", "empty": "empty or unreadable"}
    assert files.count() == 302
    assert IO.read_prediction_files(spark, f"file://{tmp_path}/none_*.csv", "none_(.*)").count() == 0


def test_race_day_defaults(spark):
    grid = spark.createDataFrame([(2025, 1, 7, 3), (2025, 2, 7, 4)], "Season int, Round int, DriverNumber int, GridPosition int")
    r = FL.settings_frame(grid).orderBy("Round").collect()
    assert [x.GridPosition for x in r] == [3, 4]
    assert (r[0].AirTemp_C, r[0].SOFT, r[0].HARD, r[0].Rain, r[0].races_prior_this_season) == (28.0, 1, 0, 0, 12)
    some = spark.createDataFrame([(2025, 1, 11.0)], "Season int, Round int, AirTemp_C double")
    both = FL.settings_frame(grid, some, on=["Season", "Round"], defaults=True).orderBy("Round").collect()
    assert [x.AirTemp_C for x in both] == [11.0, 28.0] and both[1].TrackTemp_C == 33.0
    assert [x.AirTemp_C for x in FL.settings_frame(grid, some, on=["Season", "Round"]).orderBy("Round").collect()] == [11.0, None]


def test_distinct_counts_copy_no_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), ("b", 2)], "x string, y int")
    out = A.distinct_and_counts(df, ["x", "y"])
    assert out.first().asDict() == {"x__distinct": 2, "y__distinct": 2, "x__nonnull": 3, "y__nonnull": 3}
    assert "Expand" not in out._jdf.queryExecution().toString()
    assert A.distinct_and_counts(df.limit(0), ["x"]).first().asDict() == {"x__distinct": 0, "x__nonnull": 0}


def test_median_scope(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, None), (9.0, 6.0)], f"a double, {K.TARGET} double")
    assert TR.scoped_medians(df, ["a"]).first()[0] == 5.0
    assert TR.scoped_medians(df, ["a"], "all").first()[0] == 2.0
    with pytest.raises(ValueError):
        TR.scoped_medians(df, ["a"], "some")


def test_manifest_streams_large_files(spark, tmp_path):
    import hashlib
    for name, data in (("a.bin", b"x" * 10), ("b.bin", b"yz" * 9_000_000), ("c.bin", b"")):
        (tmp_path / name).write_bytes(data)
    want = {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in ("a.bin", "b.bin", "c.bin")}
    for whole in (IO.WHOLE, 100, -1):
        got = {r.path.split("/")[-1]: (r.sha256, r.length) for r in IO.manifest(spark, f"file://{tmp_path}/*.bin", whole).collect()}
        assert {n: g[0] for n, g in got.items()} == want and got["b.bin"][1] == 18_000_000
