"""Names, unseen categories, the target kept out, exact contracts."""
import pytest
from pyspark.sql import functions as F

from pitwall.operators import filters as FL
from pitwall.operators import trees as TR

SMALL = TR.TreeParams(max_iter=3, max_depth=2)


def test_named_sparse_matrix(spark):
    rows = [(i, float(i % 5), ["red", "blue", None][i % 3], "on" if i % 2 else "off", float(i % 5) * 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, team string, status string, y double")
    fit = TR.categorical_pipeline(["a"], ["team", "status"], SMALL, label="y").fit(TR.wide_inputs(df, ["a"], ["team", "status"], ["id", "y"]))
    out = fit.transform(TR.wide_inputs(df, ["a"], ["team", "status"], ["id", "y"]))
    names = ["num__a", "cat__team_blue", "cat__team_missing", "cat__team_red", "cat__status_off", "cat__status_on"]
    assert TR.matrix_names(out) == names
    new = spark.createDataFrame([(1, 2.0, "green", "on")], "id int, a double, team string, status string")
    scored = fit.transform(TR.wide_inputs(new, ["a"], ["team", "status"], ["id"]))
    FL.assert_contract(TR.matrix_names(scored), names, exact=True)
    assert scored.first().features.toArray().tolist() == [2.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    with pytest.raises(ValueError, match="target"):
        TR.categorical_pipeline(["a", "y"], ["team"], SMALL, label="y")
    with pytest.raises(ValueError, match="order"):
        FL.assert_contract([*names[1:], names[0]], names, exact=True)


def test_missing_values_are_learned(spark):
    # the label depends on missingness alone; the values are noise
    rows = [(float(i % 7) if i % 3 else (None if i % 2 else float("nan")), float(i % 5), 10.0 if i % 3 == 0 else -1.0) for i in range(120)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    out, names = TR.missing_as_values(df, ["a", "b"])
    assert names == ("a", "b", "a__missing", "b__missing")
    model = TR.fit_gbt(TR.assemble(out, names), TR.TreeParams(max_iter=5, max_depth=2, subsample=1.0), "y")
    worst = TR.predict(model, TR.assemble(out, names)).agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert worst < 0.5
