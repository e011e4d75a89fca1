"""Weather/tyre clustering (M1-M5, A5-A8) on Spark ML.

* M1 standardisation uses *population* std (zero variance -> divisor 1)
  from one aggregation pass; the 1-row stats frame is broadcast.
* M2 k-means: all restarts (and all k of M4) advance in one job an iteration
  over the cached vectors; batches return sums, the driver holds centres only.
  Starts are drawn by seeded hashes of the key, so neither the number nor the
  order of partitions changes them (Spark ML's do depend on it, and it takes
  no starting centres).  The lowest cost wins; clusters are numbered by their
  sorted centres.
* M4 reports Spark's silhouette, whose default distance is *squared*
  Euclidean — named ``silhouette_sq`` to keep that visible.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall import constants as K
from pitwall.functions import scalars as S
from pitwall.operators.aggregates import group_medians
from pitwall.operators.quantiles import quantile_row
from pitwall.session import ensure_python_package, right_size

CLUSTER_FEATURES = (*K.WEATHER_COLUMNS, *K.TYRES, "WindDir_sin", "WindDir_cos")


def _bq(c):
    return F.col(f"`{c}`")


def cluster_inputs(df: DataFrame) -> DataFrame:
    """Numeric coercion with median fill for weather and tyres, wind
    direction as (sin, cos)."""
    cols = [*K.WEATHER_COLUMNS, *K.TYRES]
    meds = F.broadcast(quantile_row(df, {f"_med{i}": S.safe_number(c, None) for i, c in enumerate(cols)}))
    out = df.crossJoin(meds).withColumns({
        c: F.coalesce(S.safe_number(c, None), F.col(f"_med{i}"), F.lit(0.0)) for i, c in enumerate(cols)})
    out = out.withColumns({"WindDir_sin": S.wind_sin("WindDirection_deg"),
                           "WindDir_cos": S.wind_cos("WindDirection_deg")})
    return out.drop(*[f"_med{i}" for i in range(len(cols))])


# --------------------------------------------------------------------- M1
def standardize_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[e for i, c in enumerate(cols) for e in (
        F.avg(_bq(c)).alias(f"_mu{i}"), F.stddev_pop(_bq(c)).alias(f"_sd{i}"))])


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None,
                suffix: str = "_z") -> DataFrame:
    st = F.broadcast(stats if stats is not None else standardize_stats(df, cols))
    sd = [F.when(F.coalesce(F.col(f"_sd{i}"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col(f"_sd{i}"))
          for i in range(len(cols))]
    out = df.crossJoin(st).withColumns({
        f"{c}{suffix}": (_bq(c) - F.col(f"_mu{i}")) / sd[i] for i, c in enumerate(cols)})
    return out.drop(*[f"_mu{i}" for i in range(len(cols))], *[f"_sd{i}" for i in range(len(cols))])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# --------------------------------------------------------------------- M2
@dataclass(frozen=True)
class Centres:
    """A fitted k-means model: its centres, sorted, and the training cost."""

    points: tuple[tuple[float, ...], ...]
    cost: float


def _rows(vec_df: DataFrame, key: Sequence[str], features: str) -> DataFrame:
    """A hash of the whole key and the features as an array."""
    return vec_df.select(F.xxhash64(*key).alias("h"), vector_to_array(features).alias("x"))


def _points(batch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows x centres."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _uniform(h: np.ndarray, *of: int) -> np.ndarray:
    """Uniform numbers in (0, 1] from hashed keys and whole numbers (a 64-bit mix)."""
    z = h.astype(np.uint64)
    for i in of:
        z = z + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def seeded_centres(rows: DataFrame, k: int, restarts: int, seed: int) -> np.ndarray:
    """k-means++ starts, restarts x k x features, from (h, x).

    The next centre is a row drawn with probability in proportion to its
    squared distance d from the nearest one so far: the row of least
    -log(u) / d, u from its seeded hash (an exponential race).  One job a
    centre serves all restarts, and neither partitions nor order matter."""
    chosen: list[np.ndarray] = []

    def race(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, h = _points(b), b.column("h").to_numpy()
            rs, times, ids, points = [], [], [], []
            for r in range(restarts):
                d = _distances(x, np.array([c[r] for c in chosen])).min(axis=1) if chosen else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    t = np.where(d > 0, -np.log(_uniform(h, seed, r, len(chosen))) / d, np.inf)
                i = np.lexsort((h, t))[0]
                rs.append(r), times.append(t[i]), ids.append(h[i]), points.append(x[i])
            yield pa.RecordBatch.from_arrays([pa.array(rs, pa.int32()), pa.array(times, pa.float64()), pa.array(ids, pa.int64()),
                                              pa.array(points, pa.list_(pa.float64()))], names=["r", "t", "h", "x"])

    for _ in range(k):
        best = (rows.mapInArrow(race, "r int, t double, h long, x array<double>")
                .groupBy("r").agg(F.min_by("x", F.struct("t", "h")).alias("x")).collect())   # one row a restart
        if not best:
            raise ValueError("no rows to cluster")
        chosen.append(np.array([r.x for r in sorted(best, key=lambda r: r.r)]))
    return np.stack(chosen, axis=1)


def _assigned(rows: DataFrame, models: list[np.ndarray]) -> dict[tuple[int, int], tuple]:
    """(model, cluster) -> (rows, cost, sum of the points); one job for all models."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, out = _points(b), []
            for m, centres in enumerate(models):
                d = _distances(x, centres)
                at = d.argmin(axis=1)
                cost = d[np.arange(len(x)), at]
                for c in range(len(centres)):
                    own = at == c
                    if own.any():
                        out.append((m, c, int(own.sum()), float(cost[own].sum()), *x[own].sum(axis=0).tolist()))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                 *[pa.array(c, pa.float64()) for c in cols[3:]]],
                names=["m", "c", "n", "cost", *[f"s{i}" for i in range(x.shape[1])]])

    width = models[0].shape[1]
    sums = [f"s{i}" for i in range(width)]
    schema = "m int, c int, n long, cost double, " + ", ".join(f"{s} double" for s in sums)
    found = rows.mapInArrow(run, schema).groupBy("m", "c").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *sums)])
    return {(r.m, r.c): (r.n, r.cost, np.array([r[s] for s in sums])) for r in found.collect()}   # models x k rows


def kmeans_runs(vec_df: DataFrame, ks: Sequence[int], restarts: int = 20, seed: int = 42, max_iter: int = 100,
                tolerance: float = 1e-4, key: Sequence[str] = K.KEY, features: str = "features") -> dict[int, Centres]:
    """The best of ``restarts`` runs for every k.

    All runs advance together: each iteration is one job over the cached
    vectors, in which a batch returns per-cluster sums only, and runs whose
    centres moved less than ``tolerance`` are left out.  A smaller k starts
    from the first centres of the largest one's seeding."""
    ensure_python_package(vec_df.sparkSession)
    rows = right_size(_rows(vec_df, key, features))
    starts = seeded_centres(rows, max(ks), restarts, seed)
    runs = [(k, r) for k in ks for r in range(restarts)]
    centres = [starts[r, :k].copy() for k, r in runs]
    active = list(range(len(runs)))
    for _ in range(max_iter):
        found = _assigned(rows, [centres[i] for i in active])
        left = []
        for at, i in enumerate(active):
            new = centres[i].copy()
            for c in range(len(new)):
                if (at, c) in found:       # an empty cluster stays where it is
                    n, _, total = found[at, c]
                    new[c] = total / n
            if ((new - centres[i]) ** 2).sum(axis=1).max() > tolerance ** 2:
                left.append(i)
            centres[i] = new
        active = left
        if not active:
            break
    costs = [0.0] * len(runs)
    for (i, _), (_, cost, _) in _assigned(rows, centres).items():
        costs[i] += cost
    rows.unpersist()
    best = {}
    for (k, r), points, cost in zip(runs, centres, costs):
        if k not in best or cost < best[k].cost:
            best[k] = Centres(tuple(sorted(tuple(map(float, p)) for p in points)), cost)
    return best


def predict_clusters(model: Centres, vec_df: DataFrame, out: str = "weather_tire_cluster",
                     features: str = "features") -> DataFrame:
    """The nearest centre's place (the first on ties) as column expressions."""
    x = vector_to_array(features)
    df = vec_df.withColumn("_x", x)
    d = F.array(*[sum(((F.get("_x", F.lit(j)) - F.lit(c)) * (F.get("_x", F.lit(j)) - F.lit(c)) for j, c in enumerate(p)), F.lit(0.0))
                  for p in model.points])
    return df.withColumn("_d", d).withColumn(out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_x", "_d")


def cluster_table(df: DataFrame, k: int = 6, restarts: int = 20, seed: int = 42,
                  key: Sequence[str] = K.KEY):
    """M1+M2 on entries: returns ``(labels df[key..., weather_tire_cluster, *_z], model, cost)``."""
    inp = cluster_inputs(df)
    z = standardize(inp, CLUSTER_FEATURES)
    zcols = [f"{c}_z" for c in CLUSTER_FEATURES]
    vec = assemble(z.select(*key, *[_bq(c) for c in CLUSTER_FEATURES], *zcols), zcols)
    model = kmeans_runs(vec, [k], restarts, seed, key=key)[k]
    return predict_clusters(model, vec).drop("features"), model, model.cost


# --------------------------------------------------------------------- M3
def cluster_centres(labelled: DataFrame, cols: Sequence[str] = CLUSTER_FEATURES,
                    cluster: str = "weather_tire_cluster") -> DataFrame:
    """Centres in original units as per-cluster means (equal to centre*std+mean
    at convergence)."""
    return labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                         *[F.avg(_bq(c)).alias(c) for c in cols])


# --------------------------------------------------------------------- M4
def elbow(vec_df: DataFrame, ks: Sequence[int] = range(2, 11), restarts: int = 20,
          seed: int = 42, key: Sequence[str] = K.KEY, features: str = "features") -> DataFrame:
    """Inertia (best of ``restarts``) and silhouette per k; all (k, restart)
    runs share every job."""
    vec_df = right_size(vec_df.select(*key, features))
    models = kmeans_runs(vec_df, list(ks), restarts, seed, key=key, features=features)
    evaluator = ClusteringEvaluator(featuresCol=features, predictionCol="prediction")
    rows = []
    for k in ks:
        labelled = predict_clusters(models[k], vec_df, "prediction", features).withColumn("prediction", F.col("prediction").cast("double"))
        rows.append((int(k), float(models[k].cost), float(evaluator.evaluate(labelled))))
    vec_df.unpersist()
    return vec_df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette_sq double")


# --------------------------------------------------------------------- M5
def pca_2d(vec_df: DataFrame, features: str = "features", k: int = 2):
    """PCA of standardised vectors; each component's sign is fixed so its
    largest-|loading| entry is positive.  Returns (df with pc1.., loadings)."""
    model = PCA(k=k, inputCol=features, outputCol="_pcs").fit(vec_df)
    pc = model.pc.toArray()            # d x k, tiny (d = #features)
    signs = []
    for j in range(k):
        col = pc[:, j]
        signs.append(1.0 if col[abs(col).argmax()] >= 0 else -1.0)
    arr = vector_to_array(F.col("_pcs"))
    out = model.transform(vec_df).withColumns({f"pc{j + 1}": arr[j] * F.lit(signs[j]) for j in range(k)})
    loadings = [[float(pc[i, j] * signs[j]) for j in range(k)] for i in range(pc.shape[0])]
    return out.drop("_pcs"), loadings


def pca_centroids(pca_df: DataFrame, cluster: str = "weather_tire_cluster") -> DataFrame:
    """Per-cluster centroid in PCA space + n."""
    return pca_df.groupBy(cluster).agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"),
                                       F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------- Q5 (A5+P12-P14)
def cluster_report(labelled: DataFrame, cluster: str = "weather_tire_cluster") -> DataFrame:
    cols = [c for c in (*K.WEATHER_COLUMNS, *K.TYRES) if c in labelled.columns]
    med = group_medians(labelled, cluster, cols)
    tyres = [t for t in K.TYRES if t in cols]
    return med.withColumns({
        "temp_label": S.air_temp_label("AirTemp_C"),
        "humidity_label": S.humidity_label("Humidity_%"),
        "dominant_tyre": S.argmax_name(tyres),
    }).withColumn("description", S.cluster_description(cluster, "n", "temp_label", "humidity_label",
                                                       "dominant_tyre"))
