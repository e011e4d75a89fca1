"""k-means: partition independence, cost against Spark ML, centres, labels."""
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from helpers import SF_SMALL
from pitwall import constants as K
from pitwall.operators import clustering as CL
from pitwall.plans.common import feat


def points(spark, n=600):
    rnd = random.Random(6)
    mid = [(0, 0), (5, 5), (0, 6), (9, 0)]
    rows = [(2000 + i % 7, i % 12, i, *(rnd.gauss(c, 1.0) for c in mid[i % 4])) for i in range(n)]
    df = spark.createDataFrame(rows, "Season int, Round int, DriverNumber int, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_same_clusters_for_any_partitions(spark):
    df = points(spark)
    out = []
    for n in (1, 8):
        part = df.repartition(n)
        model = CL.kmeans_runs(part, [4], restarts=5)[4]
        out.append((model, {r.DriverNumber: r.c for r in CL.predict_clusters(model, part, "c").collect()}))
    (a, la), (b, lb) = out
    assert la == lb and np.allclose(a.points, b.points, atol=1e-9)
    assert set(la.values()) == {0, 1, 2, 3}


def test_cost_is_not_above_spark_mls(spark):
    df = points(spark).cache()
    ours = CL.kmeans_runs(df, [2, 5], restarts=6)
    for k in (2, 5):
        theirs = min(KMeans(k=k, seed=s, maxIter=100).fit(df).summary.trainingCost for s in range(3))
        assert ours[k].cost <= theirs * 1.01
    assert ours[2].cost > ours[5].cost


def test_seeding_is_in_proportion_to_the_squared_distance(spark):
    # one row at 0, ten at 1 and one at 10: the far one is drawn in about 100/110 of the races
    rows = [(1, 1, 0, 0.0)] + [(1, 1, i, 1.0) for i in range(1, 11)] + [(1, 1, 11, 10.0)]
    df = spark.createDataFrame(rows, "Season int, Round int, DriverNumber int, a double")
    vec = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    starts = CL.seeded_centres(CL._rows(vec, K.KEY, "features"), 2, 400, 3)
    from_low = starts[starts[:, 0, 0] == 1.0][:, 1, 0]
    assert set(np.unique(starts)) <= {0.0, 1.0, 10.0}
    assert 0.93 < (from_low == 10.0).mean() <= 1.0      # 81 / 82
    assert abs((starts[:, 0, 0] == 1.0).mean() - 10 / 12) < 0.08


def test_empty_and_constant_tables(spark):
    df = points(spark)
    with pytest.raises(ValueError, match="no rows"):
        CL.kmeans_runs(df.limit(0), [2])
    same = VectorAssembler(inputCols=["a"], outputCol="features").transform(df.drop("features").withColumn("a", F.lit(3.0)))
    assert CL.kmeans_runs(same, [2], restarts=2)[2].cost == 0.0


def test_centres_in_original_units_are_the_cluster_means(spark):
    inp = CL.cluster_inputs(feat(spark, SF_SMALL))
    stats = CL.standardize_stats(inp, CL.CLUSTER_FEATURES).first()
    labels, model, _ = CL.cluster_table(feat(spark, SF_SMALL), k=3, restarts=3)
    means = {r.weather_tire_cluster: r for r in CL.cluster_centres(
        inp.join(labels.select(*K.KEY, "weather_tire_cluster"), list(K.KEY))).collect()}
    for c, p in enumerate(model.points):
        for i, name in enumerate(CL.CLUSTER_FEATURES):
            sd = stats[f"_sd{i}"] or 1.0
            assert p[i] * sd + stats[f"_mu{i}"] == pytest.approx(means[c][name], abs=2e-3 * sd)


def test_pca_is_centred_and_ordered(spark):
    inp = CL.cluster_inputs(feat(spark, SF_SMALL))
    zc = [f"{c}_z" for c in CL.CLUSTER_FEATURES]
    df, loadings = CL.pca_2d(CL.assemble(CL.standardize(inp, CL.CLUSTER_FEATURES), zc))
    r = df.agg(F.avg("pc1").alias("m1"), F.avg("pc2").alias("m2"), F.var_pop("pc1").alias("v1"),
               F.var_pop("pc2").alias("v2"), F.covar_pop("pc1", "pc2").alias("cv")).first()
    assert abs(r.m1) < 1e-9 and abs(r.m2) < 1e-9 and abs(r.cv) < 1e-6 and r.v1 >= r.v2 > 0
    w = np.array(loadings)
    assert np.allclose(w.T @ w, np.eye(2), atol=1e-9) and all(w[abs(w[:, j]).argmax(), j] > 0 for j in (0, 1))
