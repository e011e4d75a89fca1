"""Boosted-tree regression on Spark ML.

GBTRegressor is the engine (no XGBoost in this environment); the
parameters map as: eta -> stepSize, depth -> maxDepth, subsample ->
subsamplingRate, colsample -> featureSubsetStrategy (per node), gamma ->
minInfoGain.  L1/L2 regularisation has no Spark counterpart.

Scale notes: the assembled training frame is cached once and every fold /
trial filters it; fits of independent folds/trials run as concurrent Spark
jobs from a small driver thread pool; GBT checkpoints its lineage every
``checkpointInterval`` iterations into ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark.errors import IllegalArgumentException
from pyspark import SparkContext
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.operators.filters import assert_contract, require_columns
from pitwall.operators.quantiles import quantile_row
from pitwall.operators.sampling import assign_folds, entry_id
from pitwall.session import ensure_checkpoint_dir, right_size


def _bq(c):
    return F.col(f"`{c}`")


@dataclass(frozen=True)
class TreeParams:
    max_iter: int = 30
    step_size: float = 0.1
    max_depth: int = 3
    subsample: float = 0.8
    col_sample: str = "all"
    min_info_gain: float = 0.0
    seed: int = 42


# -------------------------------------------------------------------- P10
def train_medians(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """1-row frame of exact training medians (A1) — broadcast, never collected."""
    return quantile_row(train, {f"_med{i}": _bq(c) for i, c in enumerate(features)})


def scoped_medians(train: DataFrame, features: Sequence[str], median_scope: str = "labelled",
                   label: str = K.TARGET) -> DataFrame:
    """P10: medians of the training rows with a target (``labelled``) or of
    ``all`` training rows; the published scripts do either."""
    if median_scope not in ("labelled", "all"):
        raise ValueError(f"unknown median_scope {median_scope!r}")
    return train_medians(train.filter(F.col(label).isNotNull()) if median_scope == "labelled" else train, features)


def impute(df: DataFrame, medians: DataFrame | None, features: Sequence[str]) -> DataFrame:
    """Fill NULL/NaN features with the training medians (then 0)."""
    if medians is None:
        return df.withColumns({c: F.coalesce(F.nanvl(_bq(c).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
                               for c in features})
    out = df.crossJoin(F.broadcast(medians))
    out = out.withColumns({c: F.coalesce(F.nanvl(_bq(c).cast("double"), F.lit(None).cast("double")),
                                         F.col(f"_med{i}"), F.lit(0.0)) for i, c in enumerate(features)})
    return out.drop(*[f"_med{i}" for i in range(len(features))])


SENTINEL = -1e12


def missing_as_values(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """Leave missing values to the trees instead of imputing them: a missing
    value becomes ``SENTINEL``, a bin of its own below all others, and every
    feature gets an indicator ``X__missing``, so a split can send missing
    values to either side, or part them from all others.  Returns the frame
    and the feature names to assemble."""
    missing = {c: _bq(c).isNull() | F.isnan(_bq(c).cast("double")) for c in features}
    out = df.withColumns({f"{c}__missing": m.cast("double") for c, m in missing.items()})
    out = out.withColumns({c: F.when(_bq(f"{c}__missing") == 1.0, SENTINEL).otherwise(_bq(c).cast("double")) for c in features})
    return out, (*features, *[f"{c}__missing" for c in features])


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


# --------------------------------------------------------------------- M6
def gbt(params: TreeParams, label: str = K.TARGET, features: str = "features") -> GBTRegressor:
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=params.max_iter,
                        stepSize=params.step_size, maxDepth=params.max_depth,
                        subsamplingRate=params.subsample, featureSubsetStrategy=params.col_sample,
                        minInfoGain=params.min_info_gain, seed=params.seed, checkpointInterval=10)


def fit_gbt(vec_df: DataFrame, params: TreeParams, label: str = K.TARGET):
    ensure_checkpoint_dir(vec_df.sparkSession)
    return gbt(params, label).fit(vec_df)


# --------------------------------------------------------------------- M7
def predict(model, vec_df: DataFrame, out: str = "prediction") -> DataFrame:
    pred = model.transform(vec_df)
    if model.getPredictionCol() != out:
        pred = pred.withColumnRenamed(model.getPredictionCol(), out)
    return pred


# --------------------------------------------------------------------- M8
def patience_argmin(errors: Sequence[float], patience: int) -> int:
    """Number of rounds chosen by early stopping: the best round seen before
    ``patience`` rounds pass without improvement (1-based)."""
    best_i, best = 0, float("inf")
    for i, e in enumerate(errors):
        if e < best:
            best_i, best = i, e
        elif i - best_i >= patience:
            break
    return best_i + 1


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The ensemble of a fitted model's first ``n`` trees (boosting is
    sequential, so it is what ``n`` rounds would have fitted)."""
    sc = SparkContext._active_spark_context
    package = sc._jvm.org.apache.spark.ml.regression
    trees, weights = model._java_obj.trees(), model.treeWeights
    kept, at = sc._gateway.new_array(package.DecisionTreeRegressionModel, n), sc._gateway.new_array(sc._jvm.double, n)
    for i in range(n):
        kept[i], at[i] = trees[i], float(weights[i])
    cut = package.GBTRegressionModel(f"{model.uid}_{n}", kept, at, model.numFeatures)
    model._java_obj.copyValues(cut, sc._jvm.org.apache.spark.ml.param.ParamMap())
    out = GBTRegressionModel(cut)
    out._resetUid(cut.uid())
    out._transfer_params_from_java()
    return out


def stopped(errors: Sequence[float], patience: int) -> bool:
    """Whether ``patience`` rounds have passed since the best one."""
    return len(errors) - patience_argmin(errors, patience) >= patience


def early_stopped(vec_train: DataFrame, vec_val: DataFrame, params: TreeParams,
                  patience: int = 20, label: str = K.TARGET, most: int = 1024):
    """Fit ``params.max_iter`` rounds, twice as many, ... until ``patience``
    rounds pass without a better validation error (``most`` rounds at most);
    the chosen first trees are cut from that fit, nothing is fitted again."""
    while True:
        full = fit_gbt(vec_train, params, label)
        curve = full.evaluateEachIteration(vec_val, "squared")
        if stopped(curve, patience) or params.max_iter >= most:
            break
        params = replace(params, max_iter=min(2 * params.max_iter, most))
    rounds = patience_argmin(curve, patience)
    return first_trees(full, rounds), rounds, [float(c) for c in curve]


# --------------------------------------------------------------- M9-M12
def draw_trials(n: int, seed: int, space: dict) -> list[TreeParams]:
    """Seeded parameter draws (driver-side, tiny)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kw = {name: rng.choice(list(choices)) for name, choices in space.items()}
        out.append(TreeParams(**{**asdict(TreeParams()), **kw}))
    return out


SEARCH_SPACE = {
    "step_size": (0.01, 0.05, 0.1),
    "max_depth": (3, 4, 5),
    "subsample": (0.7, 0.8, 1.0),
    "col_sample": ("all", "onethird", "0.7"),
}


def _pool(n: int, parallelism: int):
    return ThreadPoolExecutor(max_workers=max(1, min(n, parallelism)))


def random_search_val(vec_train: DataFrame, vec_val: DataFrame, trials: Sequence[TreeParams],
                      patience: int = 20, label: str = K.TARGET, parallelism: int = 4) -> DataFrame:
    """M9: each trial fitted once on train, early-stopped on the fixed
    validation set; a failed trial yields NULL rmse."""
    vec_train, vec_val = right_size(vec_train), right_size(vec_val)

    def run(i_p):
        i, p = i_p
        try:
            _, rounds, curve = early_stopped(vec_train, vec_val, p, patience, label)
            return (i + 1, p, float(curve[rounds - 1]) ** 0.5, rounds)
        except IllegalArgumentException:   # parameters the engine refuses; other failures end the search
            return (i + 1, p, None, None)

    with _pool(len(trials), parallelism) as pool:
        res = list(pool.map(run, enumerate(trials)))
    return _trial_frame(vec_train.sparkSession, res, "rmse_val", "best_iteration")


def cv_curve(vec_train: DataFrame, params: TreeParams, k: int = 5, seed: int = 42,
             label: str = K.TARGET, fold_col: str = "fold") -> list[float]:
    """Mean held-out RMSE per boosting round over k folds."""
    curves = []
    for f in range(k):
        tr = vec_train.filter(F.col(fold_col) != f)
        te = vec_train.filter(F.col(fold_col) == f)
        m = fit_gbt(tr, params, label)
        curves.append(m.evaluateEachIteration(te, "squared"))
    rounds = len(curves[0])
    return [(sum(c[i] for c in curves) / k) ** 0.5 for i in range(rounds)]


def random_search_cv(vec_train: DataFrame, trials: Sequence[TreeParams], k: int = 5,
                     patience: int = 50, label: str = K.TARGET, parallelism: int = 8,
                     fold_col: str = "fold") -> DataFrame:
    """K-fold CV per trial, rounds chosen by the mean test-RMSE
    curve.  All (trial, fold) fits are independent jobs in one pool; a
    failed trial yields NULL."""
    vec_train = right_size(vec_train)
    jobs = [(i, f) for i in range(len(trials)) for f in range(k)]

    def run(job):
        i, f = job
        try:
            m = fit_gbt(vec_train.filter(F.col(fold_col) != f), trials[i], label)
            return i, m.evaluateEachIteration(vec_train.filter(F.col(fold_col) == f), "squared")
        except IllegalArgumentException:
            return i, None

    with _pool(len(jobs), parallelism) as pool:
        curves = list(pool.map(run, jobs))
    res = []
    for i, p in enumerate(trials):
        cs = [c for j, c in curves if j == i]
        if any(c is None for c in cs):
            res.append((i + 1, p, None, None))
            continue
        curve = [(sum(c[r] for c in cs) / k) ** 0.5 for r in range(len(cs[0]))]
        rounds = patience_argmin(curve, patience)
        res.append((i + 1, p, float(curve[rounds - 1]), rounds))
    return _trial_frame(vec_train.sparkSession, res, "cv_rmse", "best_rounds")


def _trial_frame(spark, res, metric: str, rounds: str) -> DataFrame:
    rows = [(i, "reg:squarederror", "rmse", p.step_size, p.max_depth, p.subsample, p.col_sample,
             p.min_info_gain, p.seed, m, r) for i, p, m, r in res]
    return spark.createDataFrame(rows, f"trial int, objective string, eval_metric string, eta double, "
                                       f"max_depth int, subsample double, colsample string, gamma double, "
                                       f"seed int, {metric} double, {rounds} int")


def params_from_row(row, rounds: str = "best_rounds") -> TreeParams:
    """The parameters of a trials row (A13's best one) and the rounds it chose."""
    return TreeParams(max_iter=row[rounds], step_size=row["eta"], max_depth=row["max_depth"], subsample=row["subsample"],
                      col_sample=row["colsample"], min_info_gain=row["gamma"], seed=row["seed"])


# -------------------------------------------------------------------- M13
@dataclass
class Ensemble:
    """Fold models with what scoring needs: ordered features, training
    medians, the label's name and, once fitted, their calibrator."""

    models: list
    features: tuple
    medians: DataFrame | None
    label: str = K.TARGET
    calibrator: DataFrame | None = None
    folder: str | None = None      # the bundle version it was loaded from

    def inputs(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """V4/V5/V6: ``keep`` and the features by name, imputed; a missing
        feature raises, whatever the width of ``df``."""
        assert_contract(df, self.features)
        require_columns(df, keep)
        kept = [c for c in keep if c not in self.features]
        rows = df.select(*[_bq(c) for c in (*kept, *self.features)])
        assert_contract([c for c in rows.columns if c not in kept], self.features, exact=True)
        return impute(rows, self.medians, self.features)

    def predict_mean(self, df: DataFrame, keep: Sequence[str] = K.KEY, out: str = "y_pred") -> DataFrame:
        """Mean over fold models (one vectorised pass, no union);
        ``keep`` columns (key, truth) travel along."""
        vec = assemble(self.inputs(df, keep), self.features)
        cols = []
        for i, m in enumerate(self.models):
            vec = m.transform(vec).withColumnRenamed(m.getPredictionCol(), f"_p{i}")
            cols.append(F.col(f"_p{i}"))
        return vec.select(*[_bq(c) for c in keep], (sum(cols[1:], cols[0]) / len(cols)).alias(out))


def oof_ensemble(train: DataFrame, features: Sequence[str], params: TreeParams, k: int = 5,
                 seed: int = 42, label: str = K.TARGET, key: Sequence[str] = K.KEY,
                 parallelism: int = 5):
    """K fold models; every training key gets exactly one held-out
    prediction.  Returns ``(Ensemble, oof df[key, fold, y_true, y_oof])``."""
    features = tuple(features)
    medians = train_medians(train, features)
    vec = assemble(impute(train, medians, features), features)
    vec = right_size(assign_folds(vec.withColumn("_eid", entry_id(*key)), F.col("_eid"), k, seed))

    def run(f):
        m = fit_gbt(vec.filter(F.col("fold") != f), params, label)
        held = predict(m, vec.filter(F.col("fold") == f), "y_oof")
        return m, held.select(*key, "fold", F.col(label).alias("y_true"), "y_oof")

    with _pool(k, parallelism) as pool:
        res = list(pool.map(run, range(k)))
    oof = res[0][1]
    for _, h in res[1:]:
        oof = oof.unionByName(h)
    return Ensemble([m for m, _ in res], features, medians, label), oof


# -------------------------------------------------------------------- M15
def wide_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the numeric roles as ``num__X`` and the categorical ones as
    text (NULL is the category 'missing')."""
    return df.select(*[_bq(c) for c in keep], *[_bq(c).cast("double").alias(f"num__{c}") for c in numeric],
                     *[F.coalesce(_bq(c).cast("string"), F.lit("missing")).alias(f"_cat_{c}") for c in categorical])


def categorical_pipeline(numeric: Sequence[str], categorical: Sequence[str], params: TreeParams,
                         label: str = K.TARGET) -> Pipeline:
    """On ``wide_inputs``: one-hot categories and numerics as one sparse vector
    whose attributes are named ``num__X`` and ``cat__Col_value``, then GBT.

    The indexer keeps unseen values as a last category, which the encoder
    drops: they are zero in every column, and the width is that of training.
    The label is never an input column."""
    if label in (*numeric, *categorical):
        raise ValueError("the target must not be a feature")
    idx = [StringIndexer(inputCol=f"_cat_{c}", outputCol=f"_idx_{c}", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"_idx_{c}" for c in categorical],
                        outputCols=[f"cat__{c}" for c in categorical], dropLast=True, handleInvalid="error")
    va = VectorAssembler(inputCols=[*[f"num__{c}" for c in numeric], *[f"cat__{c}" for c in categorical]],
                         outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[*idx, ohe, va, gbt(params, label)])


def matrix_names(df: DataFrame, features: str = "features") -> list[str]:
    """The names of a vector column's places, from its attributes."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for g in groups for a in g), key=lambda a: a["idx"])]


# -------------------------------------------------------------------- M18
def comparison_learners(label: str = K.TARGET, seed: int = 42) -> dict:
    return {
        "random_forest": RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=50,
                                               maxDepth=5, seed=seed),
        "linear": LinearRegression(featuresCol="features", labelCol=label),
    }


# -------------------------------------------------------------------- M19
def param_table(spark, named_models: dict) -> DataFrame:
    rows = []
    for name, m in named_models.items():
        for p, v in m.extractParamMap().items():
            rows.append((name, type(m).__name__, p.name, str(v)))
    return spark.createDataFrame(rows, "model string, type string, param string, value string")
