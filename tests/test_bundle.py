"""Stored bundles, contracts, early stopping by truncation, ensemble importance."""
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from pitwall import constants as K
from pitwall.operators import attribution as AT
from pitwall.operators import filters as FL
from pitwall.operators import trees as TR
from pitwall.operators.bundle import MARKER, find_bundle, load_bundle, save_bundle
from pitwall.operators.calibration import fit_linear_calibration
from pitwall.plans import q_ml
from pitwall.sources.files import hadoop_path, write_file_text

FEATURES = ("GridPosition", "AvgQualiTime", "PointsProp")
SMALL = TR.TreeParams(max_iter=4, max_depth=2, seed=3)
KEEP = [*K.KEY, K.TARGET]


@pytest.fixture(scope="module")
def trained(spark):
    train, val, _ = q_ml.splits(spark, SF_SMALL)
    train, val = train.cache(), val.cache()
    ens, oof = TR.oof_ensemble(train, FEATURES, SMALL, k=3)
    ens.calibrator = fit_linear_calibration(ens.predict_mean(val, KEEP), y=K.TARGET)
    return train, val, ens, oof


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_loaded_bundle_scores_the_same(spark, trained, tmp_path):
    _, val, ens, _ = trained
    root = f"file://{tmp_path}/bundle"
    folder = save_bundle(ens, root)
    back = load_bundle(spark, [f"{root}-none", root])
    assert back.folder == folder and back.features == FEATURES and back.label == K.TARGET
    assert rows(back.predict_mean(val, KEEP)) == rows(ens.predict_mean(val, KEEP))
    assert back.calibrator.first() == ens.calibrator.first()


def test_newest_complete_version_wins(spark, trained, tmp_path):
    ens = trained[2]
    root = f"file://{tmp_path}/bundle"
    one, two = save_bundle(ens, root), save_bundle(ens, root)
    assert find_bundle(spark, [root]) == two
    fs, p = hadoop_path(spark, f"{two}/{MARKER}")
    fs.rename(p, hadoop_path(spark, f"{two}/unfinished")[1])     # a save that died before its marker
    assert find_bundle(spark, [root]) == one
    with pytest.raises(FileNotFoundError, match="nowhere"):
        find_bundle(spark, [f"file://{tmp_path}/nowhere"])


def test_a_changed_contract_or_width_raises(spark, trained, tmp_path):
    ens = trained[2]
    root = f"file://{tmp_path}/bundle"
    folder = save_bundle(ens, root)
    write_file_text(spark, f"{folder}/contract", "{}")
    with pytest.raises(ValueError, match="contract"):
        load_bundle(spark, [root])
    single = f"{folder}/models/0"
    with pytest.raises(ValueError, match="takes 3 features"):
        load_bundle(spark, [single], features=FEATURES[:2])
    with pytest.raises(ValueError, match="must be given"):
        load_bundle(spark, [single])
    assert load_bundle(spark, [f"{root}-none", single], features=FEATURES).features == FEATURES


def test_missing_features_raise_and_extra_columns_do_not(trained):
    _, val, ens, _ = trained
    with pytest.raises(ValueError, match="PointsProp"):
        ens.predict_mean(val.drop("PointsProp"), KEEP)
    with pytest.raises(ValueError, match="required"):
        ens.predict_mean(val.drop(K.TARGET), KEEP)
    wide = val.withColumn("another", F.lit(1.0))
    assert rows(ens.predict_mean(wide, KEEP)) == rows(ens.predict_mean(val, KEEP))


def test_exact_contract():
    FL.assert_contract(["a", "b"], ["a", "b"], exact=True)
    for bad, words in ((["b", "a"], "order"), (["a", "b", "c"], "extra"), (["a"], "missing")):
        with pytest.raises(ValueError, match=words):
            FL.assert_contract(bad, ["a", "b"], exact=True)


def test_contract_report_counts_values(spark):
    df = spark.createDataFrame([(1, 1.0, None, "x"), (2, float("nan"), None, "y")], "id int, a double, b string, z string")
    got = {r.column: (r.position, r.status, r.n_rows, r.n_missing) for r in FL.contract_report(df, ["b", "a", "c"], ["id"]).collect()}
    assert got == {"b": (0, "present", 2, 2), "a": (1, "present", 2, 1), "c": (2, "missing", 2, 2), "z": (None, "extra", 2, 0)}
    assert {r.n_rows for r in FL.contract_report(df.limit(0), ["a"]).collect()} == {0}
    assert FL.numeric_columns(df) == ["id", "a"]


def test_all_lapped_raises(spark):
    df = spark.createDataFrame([("Lapped",)], "Status string")
    with pytest.raises(ValueError, match="lapped"):
        FL.drop_lapped(df, must_keep=True)
    assert FL.drop_lapped(df).count() == 0


def test_first_trees_are_what_fewer_rounds_fit(spark, trained, tmp_path):
    train, val, ens, _ = trained
    vec = TR.assemble(ens.inputs(train, KEEP), FEATURES).coalesce(1)
    vva = TR.assemble(ens.inputs(val, KEEP), FEATURES)
    six = TR.fit_gbt(vec, TR.TreeParams(max_iter=6, max_depth=2, seed=3))
    three = TR.fit_gbt(vec, TR.TreeParams(max_iter=3, max_depth=2, seed=3))
    cut = TR.first_trees(six, 3)
    assert cut.getNumTrees == 3 and cut.numFeatures == len(FEATURES)
    assert rows(TR.predict(cut, vva).select(*K.KEY, "prediction")) == rows(TR.predict(three, vva).select(*K.KEY, "prediction"))
    cut.write().overwrite().save(f"file://{tmp_path}/cut")
    model, rounds, curve = TR.early_stopped(vec, vva, TR.TreeParams(max_iter=2, max_depth=2, step_size=0.5, seed=3), patience=3)
    assert model.getNumTrees == rounds == TR.patience_argmin(curve, 3) and TR.stopped(curve, 3)


def test_ensemble_importance_equals_the_long_form(trained):
    train, _, ens, oof = trained
    inp = ens.inputs(train.join(oof.select(*K.KEY, "fold"), list(K.KEY)), [*K.KEY, "fold"])
    got = {r.feature: (r.pooled, r.per_fold_mean) for r in AT.ensemble_importance(ens.models, inp, FEATURES).collect()}
    long = None
    for i, m in enumerate(ens.models):
        part = AT.contributions(m, inp, FEATURES, [*K.KEY, "fold"]).where("feature <> 'bias'").withColumn("model", F.lit(i))
        long = part if long is None else long.unionByName(part)
    long = long.cache()
    size = F.avg(F.abs("contribution"))
    pooled = {r.feature: r[1] for r in long.where("model <> fold").groupBy("feature").agg(size).collect()}
    means = {r.feature: r[1] for r in long.groupBy("model", "feature").agg(size.alias("m")).groupBy("feature").agg(F.avg("m")).collect()}
    for f in FEATURES:
        assert got[f] == pytest.approx((pooled[f], means[f]))


def test_contribution_arrays_and_top_features(trained):
    _, val, ens, _ = trained
    inp = ens.inputs(val, K.KEY)
    arr = AT.contribution_arrays(ens.models[0], inp, FEATURES).cache()
    long = AT.contributions(ens.models[0], inp, FEATURES).where("feature <> 'bias'").collect()
    want = {}
    for r in long:
        want.setdefault((r.Season, r.Round, r.DriverNumber), []).append((-abs(r.contribution), r.feature))
    top = AT.top_contributions(arr, FEATURES, K.KEY, 2).collect()
    assert len(top) == 2 * len(want)
    for r in top:
        assert sorted(want[r.Season, r.Round, r.DriverNumber])[r.rank - 1][1] == r.feature
    both = {r.feature: r.mean_abs_shap for r in AT.mean_abs_contributions(arr, FEATURES).collect()}
    for f in FEATURES:
        assert both[f] == pytest.approx(sum(abs(r.contribution) for r in long if r.feature == f) / len(want))
