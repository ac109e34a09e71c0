"""K-Means fits side by side against MLlib's, one by one."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from staylens.operators import lloyd
from staylens.operators import models as MO


@pytest.fixture(scope="module")
def vec(spark):
    df = spark.range(3000, numPartitions=3).select(
        *[(F.randn(5 + i) + F.col("id") % (i + 3)).alias(f"x{i}") for i in range(4)])
    twice = df.unionByName(df.where("x0 > 1"))
    return MO.assemble(twice, twice.columns).cache()


def test_fits_are_those_of_mllib(vec, monkeypatch):
    """Steps, centres, cost and silhouette; with few points a step and narrow margins, so that every path is taken."""
    ways = []
    monkeypatch.setattr(lloyd, "BLOCK", 500)
    monkeypatch.setattr(lloyd, "LOOSE_SHARE", 0.4)
    monkeypatch.setattr(lloyd.Fit, "inside", lambda f, was=lloyd.Fit.inside: ways.append(was(f)) or ways[-1])
    fits = MO.Fits(vec)
    wanted = [(k, 42 + i) for k in (2, 3, 6) for i in range(2)]
    got = fits.get(wanted)
    assert True in ways and False in ways
    for (k, seed), fit, found in zip(wanted, got, fits.silhouettes(got)):
        model = KMeans(k=k, seed=seed, maxIter=lloyd.MAX_STEPS).fit(vec.select("features"))
        assert fit.steps == model.summary.numIter and fit.cost == pytest.approx(model.summary.trainingCost)
        assert np.allclose(model.clusterCenters(), fit.centres)
        own = MO.FittedKMeans(fit, vec.sparkSession)
        assert own.summary.k == k and own.transform(vec).exceptAll(model.transform(vec)).count() == 0
        assert found == pytest.approx(ClusteringEvaluator().evaluate(model.transform(vec)))
    fits.close()


def test_a_sweep_and_its_best_model_fit_once(spark, vec, monkeypatch):
    made = []

    class Counted(MO.KMeans):
        def fit(self, points):
            made.append((self.getK(), self.getSeed(), self.getMaxIter()))
            return super().fit(points)
    monkeypatch.setattr(MO, "KMeans", Counted)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    fits = MO.Fits(vec)
    rows = MO.kmeans_sweep(vec, [2, 3], inits=2, fits=fits).collect()
    best = MO.best_kmeans(vec, 3, inits=2, fits=fits)
    fits.close()
    assert sorted(made) == [(k, s, 0) for k in (2, 3) for s in (42, 43)]
    assert best.summary.trainingCost == rows[1]["inertia"] and rows[0]["pct_drop"] is None and rows[1]["pct_drop"] > 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_equal_and_few_points(spark):
    """Of equal centres the first takes all points, then leaves the equal ones to the other; a centre without points stays."""
    same = spark.createDataFrame([(1.0, 2.0)] * 5 + [(3.0, 2.0)], "a double, b double")
    vec = MO.assemble(same, ["a", "b"])
    fits = MO.Fits(vec)
    fit = lloyd.Fit(3, 0, np.array([[1.0, 2.0], [1.0, 2.0], [9.0, 9.0]]))
    lloyd.run(fits.blocks, [fit], fits.count)
    fits.close()
    assert fit.stay[:, 2].tolist() == [1.0, 5.0, 0.0]
    assert fit.centres[2].tolist() == [9.0, 9.0]
    assert MO.best_kmeans(vec, 2).summary.trainingCost == 0
