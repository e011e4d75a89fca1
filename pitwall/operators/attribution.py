"""Per-row feature contributions for Spark GBT models (M16) and
permutation importance (M17).

M16 is path-dependent TreeSHAP (Lundberg, Erion & Lee, "Consistent
Individualized Feature Attribution for Tree Ensembles", 2018, Algorithm 2)
run as a Spark job: the fitted trees are read from the model's saved
parquet data (bounded by #trees x 2^depth nodes — model metadata), shipped
once as a broadcast variable, and ``mapInPandas`` streams Arrow batches of
rows through the recursion, emitting long rows ``(key, feature,
contribution)`` plus a ``bias`` row.  The recursion is vectorised over the
rows of a batch (one tree traversal per batch; the row only decides which
child is "hot"), so there is no per-row Python.  Each batch checks
additivity: sum(contributions) + bias == model output.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.operators.ranking import row_number_within
from pitwall.operators.trees import assemble, predict
from pitwall.session import cut_lineage, ensure_checkpoint_dir, ensure_python_package
from pitwall.functions.scalars import portable_bucket


# ---------------------------------------------------------- tree extraction
def flat_trees(model) -> list[dict]:
    """Flatten a fitted tree-ensemble model into numpy arrays per tree."""
    spark = SparkSession.getActiveSession()
    base = ensure_checkpoint_dir(spark)
    path = f"{base}/tree-models/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = (spark.read.parquet(f"{path}/data")
             .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount",
                     "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                     F.col("nodeData.split.leftCategoriesOrThreshold").alias("thr"),
                     "nodeData.split.numCategories")
             .toPandas())
    weights = list(model.treeWeights) if hasattr(model, "treeWeights") else [1.0] * model.getNumTrees
    trees = []
    for tid, g in nodes.groupby("treeID"):
        g = g.sort_values("id")
        n = int(g["id"].max()) + 1
        t = {k: np.zeros(n, dtype=float) for k in ("value", "cover", "threshold")}
        t.update({k: np.full(n, -1, dtype=np.int64) for k in ("left", "right", "feature")})
        for r in g.itertuples(index=False):
            i = int(r.id)
            t["value"][i] = r.prediction
            t["cover"][i] = r.rawCount
            t["left"][i] = r.leftChild
            t["right"][i] = r.rightChild
            if r.leftChild >= 0:
                if r.numCategories != -1:
                    raise NotImplementedError("categorical splits are not supported")
                t["feature"][i] = r.featureIndex
                t["threshold"][i] = r.thr[0]
        t["weight"] = float(weights[int(tid)])
        trees.append(t)
    return trees


def tree_predict(trees, x: np.ndarray) -> float:
    out = 0.0
    for t in trees:
        j = 0
        while t["left"][j] >= 0:
            j = t["left"][j] if x[t["feature"][j]] <= t["threshold"][j] else t["right"][j]
        out += t["weight"] * t["value"][j]
    return out


def expected_value(t) -> float:
    leaves = t["left"] < 0
    return float((t["value"][leaves] * t["cover"][leaves]).sum() / t["cover"][0])


# --------------------------------------------------------------- TreeSHAP
def _extend(m, pz, po, pi):
    d = [e[0] for e in m] + [pi]
    z = [e[1] for e in m] + [pz]
    o = [e[2] for e in m] + [po]
    w = [e[3] for e in m] + [1.0 if not m else 0.0]
    L = len(m)
    for i in range(L - 1, -1, -1):
        w[i + 1] += po * w[i] * (i + 1) / (L + 1)
        w[i] = pz * w[i] * (L - i) / (L + 1)
    return list(zip(d, z, o, w))


def _unwind(m, i):
    L = len(m) - 1
    n = m[L][3]
    d = [e[0] for e in m]
    z = [e[1] for e in m]
    o = [e[2] for e in m]
    w = [e[3] for e in m]
    zi, oi = z[i], o[i]
    for j in range(L - 1, -1, -1):
        if oi != 0:
            t = w[j]
            w[j] = n * (L + 1) / ((j + 1) * oi)
            n = t - w[j] * zi * (L - j) / (L + 1)
        else:
            w[j] = (w[j] * (L + 1)) / (zi * (L - j))
    for j in range(i, L):
        d[j], z[j], o[j] = d[j + 1], z[j + 1], o[j + 1]
    return list(zip(d[:L], z[:L], o[:L], w[:L]))


def _unwound_sum(m, i):
    L = len(m) - 1
    zi, oi = m[i][1], m[i][2]
    n = m[L][3]
    total = 0.0
    for j in range(L - 1, -1, -1):
        if oi != 0:
            t = n * (L + 1) / ((j + 1) * oi)
            total += t
            n = m[j][3] - t * zi * (L - j) / (L + 1)
        else:
            total += (m[j][3] / zi) / ((L - j) / (L + 1))
    return total


def _as_lists(t) -> dict:
    """Plain Python lists: scalar indexing in the recursion is much cheaper
    than on numpy arrays."""
    return {k: (v.tolist() if isinstance(v, np.ndarray) else v) for k, v in t.items()}


def tree_shap_row(t, x, phi, scale: float) -> None:
    left, right, feat, thr = t["left"], t["right"], t["feature"], t["threshold"]
    cover, value = t["cover"], t["value"]

    def recurse(j, m, pz, po, pi):
        m = _extend(m, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(m)):
                w = _unwound_sum(m, i)
                phi[m[i][0]] += scale * w * (m[i][2] - m[i][1]) * value[j]
            return
        f = feat[j]
        hot, cold = (left[j], right[j]) if x[f] <= thr[j] else (right[j], left[j])
        iz = io = 1.0
        k = next((i for i in range(1, len(m)) if m[i][0] == f), None)
        if k is not None:
            iz, io = m[k][1], m[k][2]
            m = _unwind(m, k)
        recurse(hot, m, iz * cover[hot] / cover[j], io, f)
        recurse(cold, m, iz * cover[cold] / cover[j], 0.0, f)

    recurse(0, [], 1.0, 1.0, -1)


def _extend_v(m, pz, po, pi):
    """EXTEND with the one-fractions and weights as vectors over rows."""
    L = len(m)
    out = [[d, z, o, w.copy()] for d, z, o, w in m]
    out.append([pi, pz, po, np.ones_like(po) if L == 0 else np.zeros_like(po)])
    for i in range(L - 1, -1, -1):
        out[i + 1][3] = out[i + 1][3] + po * out[i][3] * (i + 1) / (L + 1)
        out[i][3] = pz * out[i][3] * (L - i) / (L + 1)
    return out


def _unwind_v(m, i):
    L = len(m) - 1
    zi, oi = m[i][1], m[i][2]
    nz = oi != 0
    safe_o = np.where(nz, oi, 1.0)
    n = m[L][3]
    w = [e[3].copy() for e in m]
    for j in range(L - 1, -1, -1):
        w_nz = n * (L + 1) / ((j + 1) * safe_o)
        n_nz = w[j] - w_nz * zi * (L - j) / (L + 1)
        w_z = w[j] * (L + 1) / (zi * (L - j))
        w[j] = np.where(nz, w_nz, w_z)
        n = np.where(nz, n_nz, n)
    out = [[e[0], e[1], e[2], w[k]] for k, e in enumerate(m)]
    for j in range(i, L):
        out[j][0], out[j][1], out[j][2] = out[j + 1][0], out[j + 1][1], out[j + 1][2]
    return out[:L]


def _unwound_sum_v(m, i):
    L = len(m) - 1
    zi, oi = m[i][1], m[i][2]
    nz = oi != 0
    safe_o = np.where(nz, oi, 1.0)
    n = m[L][3]
    total = np.zeros_like(n)
    for j in range(L - 1, -1, -1):
        t = n * (L + 1) / ((j + 1) * safe_o)
        total = total + np.where(nz, t, (m[j][3] / zi) / ((L - j) / (L + 1)))
        n = np.where(nz, m[j][3] - t * zi * (L - j) / (L + 1), n)
    return total


def tree_shap_batch(t, X: np.ndarray, phi: np.ndarray, scale: float) -> None:
    """Path-dependent TreeSHAP for all rows of ``X`` at once: one traversal
    of the tree; the row only decides which child is hot, so the one
    fractions / weights are vectors over rows (no per-row Python)."""
    left, right, feat, thr = t["left"], t["right"], t["feature"], t["threshold"]
    cover, value = t["cover"], t["value"]

    def recurse(j, m, pz, po, pi):
        m = _extend_v(m, pz, po, pi)
        if left[j] < 0:
            for i in range(1, len(m)):
                w = _unwound_sum_v(m, i)
                phi[:, m[i][0]] += scale * w * (m[i][2] - m[i][1]) * value[j]
            return
        f = feat[j]
        go_left = (X[:, f] <= thr[j]).astype(float)
        iz, io = 1.0, np.ones(X.shape[0])
        k = next((i for i in range(1, len(m)) if m[i][0] == f), None)
        if k is not None:
            iz, io = m[k][1], m[k][2]
            m = _unwind_v(m, k)
        recurse(left[j], m, iz * cover[left[j]] / cover[j], io * go_left, f)
        recurse(right[j], m, iz * cover[right[j]] / cover[j], io * (1.0 - go_left), f)

    recurse(0, [], 1.0, np.ones(X.shape[0]), -1)


def shap_matrix(trees, X: np.ndarray) -> tuple[np.ndarray, float]:
    X = np.asarray(X, dtype=float)
    phi = np.zeros_like(X)
    if X.shape[0]:
        for t in trees:
            tree_shap_batch(t, X, phi, t["weight"])
    bias = float(sum(t["weight"] * expected_value(t) for t in trees))
    return phi, bias


def predict_batch(trees, X: np.ndarray) -> np.ndarray:
    """Ensemble output of all rows: one step down per level, all rows at once."""
    out, rows = np.zeros(len(X)), np.arange(len(X))
    for t in trees:
        at = np.zeros(len(X), dtype=np.int64)
        while True:
            inner = t["left"][at] >= 0
            if not inner.any():
                break
            f = np.where(inner, t["feature"][at], 0)
            left = X[rows, f] <= t["threshold"][at]
            at = np.where(inner, np.where(left, t["left"][at], t["right"][at]), at)
        out += t["weight"] * t["value"][at]
    return out


def shap_matrix_rowwise(trees, X: np.ndarray) -> tuple[np.ndarray, float]:
    """Row-at-a-time reference implementation (used by tests)."""
    fast = [_as_lists(t) for t in trees]
    phi = [[0.0] * X.shape[1] for _ in range(X.shape[0])]
    for r, x in enumerate(X.tolist()):
        for t in fast:
            tree_shap_row(t, x, phi[r], t["weight"])
    bias = float(sum(t["weight"] * expected_value(t) for t in trees))
    return np.array(phi, dtype=float).reshape(X.shape), bias


# ------------------------------------------------------------ Spark job M16
def contribution_arrays(model, df: DataFrame, features: Sequence[str], keep: Sequence[str] = K.KEY,
                        check_tol: float = 1e-6) -> DataFrame:
    """``keep`` columns, ``contributions`` (array in feature order) and
    ``bias`` per row; ``df`` must already be imputed (no NULLs)."""
    spark = df.sparkSession
    ensure_python_package(spark)
    bc = spark.sparkContext.broadcast(flat_trees(model))
    feats, keep = list(features), list(keep)
    out_schema = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep]
                           + ["contributions array<double>", "bias double"])

    def run(batches):
        trees = bc.value
        for pdf in batches:
            X = pdf[feats].to_numpy(dtype=float)
            phi, bias = shap_matrix(trees, X)
            pred = predict_batch(trees, X)
            if np.any(np.abs(phi.sum(axis=1) + bias - pred) > check_tol * np.maximum(1.0, np.abs(pred))):
                raise AssertionError("TreeSHAP additivity check failed")
            out = pdf[keep].copy()
            out["contributions"], out["bias"] = list(phi), bias
            yield out

    rest = [F.col(f"`{c}`").cast("double").alias(c) for c in feats if c not in keep]
    return df.select(*[F.col(f"`{c}`") for c in keep], *rest).mapInPandas(run, out_schema)


def contributions(model, df: DataFrame, features: Sequence[str], key: Sequence[str] = K.KEY,
                  check_tol: float = 1e-6) -> DataFrame:
    """Long ``(key..., feature, contribution)`` incl. a ``bias`` row per key."""
    rows = contribution_arrays(model, df, features, key, check_tol)
    pairs = F.arrays_zip(F.lit([*features, "bias"]).alias("f"), F.array_append("contributions", F.col("bias")).alias("c"))
    return rows.select(*key, F.explode(pairs).alias("_p")).select(
        *key, F.col("_p.f").alias("feature"), F.col("_p.c").alias("contribution"))


def top_contributions(rows: DataFrame, features: Sequence[str], keep: Sequence[str], k: int) -> DataFrame:
    """W7 on ``contribution_arrays``: the ``k`` largest |contribution| of each
    row (ties by feature name), ranked within the row: no shuffle."""
    pairs = F.zip_with(F.lit(list(features)), "contributions", lambda f, c: F.struct(
        (-F.abs(c)).alias("by"), f.alias("feature"), c.alias("contribution")))
    best = F.slice(F.array_sort(pairs), 1, k)
    return rows.select(*keep, F.posexplode(best).alias("_i", "_c")).select(
        *keep, (F.col("_i") + 1).cast("bigint").alias("rank"), "_c.feature", "_c.contribution")


def mean_abs_contributions(rows: DataFrame, features: Sequence[str], out: str = "mean_abs_shap") -> DataFrame:
    """A9 on ``contribution_arrays``."""
    pairs = F.zip_with(F.lit(list(features)), "contributions", lambda f, c: F.struct(f.alias("f"), F.abs(c).alias("c")))
    return rows.select(F.explode(pairs).alias("p")).groupBy(F.col("p.f").alias("feature")).agg(F.avg("p.c").alias(out))


def ensemble_importance(models, df: DataFrame, features: Sequence[str], fold: str = "fold") -> DataFrame:
    """A10 over fold contributions: (feature, pooled, per_fold_mean).

    ``pooled``: mean |c| over all (model, row) with the row on the model's
    training side (``fold`` differs); ``per_fold_mean``: mean over models of
    the mean |c| on all rows.  One pass: each Arrow batch runs all models and
    returns sums only, (models x features) rows."""
    ensure_python_package(df.sparkSession)
    bc = df.sparkSession.sparkContext.broadcast([flat_trees(m) for m in models])
    feats = list(features)

    def run(batches):
        for pdf in batches:
            X, of = pdf[feats].to_numpy(dtype=float), pdf[fold].to_numpy()
            for i, trees in enumerate(bc.value):
                phi = np.abs(shap_matrix(trees, X)[0])
                side = of != i
                yield pd.DataFrame({"model": i, "feature": feats, "all_sum": phi.sum(axis=0), "all_n": len(X),
                                    "side_sum": phi[side].sum(axis=0), "side_n": int(side.sum())})

    sums = (df.select(fold, *[F.col(f"`{c}`").cast("double").alias(c) for c in feats])
            .mapInPandas(run, "model int, feature string, all_sum double, all_n long, side_sum double, side_n long")
            .groupBy("model", "feature").agg(*[F.sum(c).alias(c) for c in ("all_sum", "all_n", "side_sum", "side_n")]))
    return sums.groupBy("feature").agg((F.sum("side_sum") / F.sum("side_n")).alias("pooled"),
                                       F.avg(F.col("all_sum") / F.col("all_n")).alias("per_fold_mean"))


# -------------------------------------------------------------------- M17
def permutation_importance(model, df: DataFrame, features: Sequence[str], label: str = K.TARGET,
                           key: Sequence[str] = K.KEY, id_col: str = "_eid", seed: int = 7) -> DataFrame:
    """Delta RMSE when one feature is permuted across rows.

    The permutation maps the i-th row in key order to the i-th row in
    seeded-hash order (two skew-safe global ranks + a keyed join; no
    collect).  All features are evaluated in one scoring pass over a
    feature-tagged union.
    """
    key = list(key)
    feats = list(features)
    base = df.select(*key, id_col, *[F.col(f"`{c}`") for c in feats], F.col(label)).withColumn("_g", F.lit(0))
    by_key = row_number_within(base, ["_g"], [F.col(id_col)], out="_rk")
    by_hash = row_number_within(base.withColumn("_h", portable_bucket(F.col(id_col), 2147483647, seed)),
                                ["_g"], [F.col("_h"), F.col(id_col)], out="_rh")
    donor = by_hash.select(F.col("_rh").alias("_rk"), *[F.col(f"`{c}`").alias(f"_d_{i}")
                                                         for i, c in enumerate(feats)])
    # checkpoint: read once per feature variant below, and the short lineage
    # keeps the (features + 1)-branch union cheap to analyse
    paired = cut_lineage(by_key.join(donor, "_rk"))
    variants = [paired.select(*key, F.col(label), F.lit("__none__").alias("feature"),
                              *[F.col(f"`{c}`") for c in feats])]
    for i, c in enumerate(feats):
        variants.append(paired.select(*key, F.col(label), F.lit(c).alias("feature"),
                                      *[(F.col(f"_d_{i}") if c2 == c else F.col(f"`{c2}`")).alias(c2)
                                        for c2 in feats]))
    allv = variants[0]
    for v in variants[1:]:
        allv = allv.unionByName(v)
    scored = predict(model, assemble(allv, feats))
    err = F.col(label) - F.col("prediction")
    rm = scored.groupBy("feature").agg(F.sqrt(F.avg(err * err)).alias("rmse"))
    base_rmse = rm.filter(F.col("feature") == "__none__").select(F.col("rmse").alias("_base"))
    return (rm.filter(F.col("feature") != "__none__").crossJoin(F.broadcast(base_rmse))
              .select("feature", "rmse", (F.col("rmse") - F.col("_base")).alias("importance")))
