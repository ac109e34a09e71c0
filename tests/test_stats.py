"""Statistics against closed-form small cases (no scipy available)."""

import math

import numpy as np
from pyspark.sql import functions as F

from staylens.functions import statmath as SM
from staylens.operators import stats as ST


def test_special_functions():
    assert abs(SM.t_ppf(0.975, 10) - 2.2281388519649385) < 1e-9
    assert abs(SM.two_sided_normal_p(1.959963984540054) - 0.05) < 1e-12
    assert abs(SM.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9


def test_welch_matches_formula(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 10.0], [2.0, 2.5, 3.0]
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "x double, g boolean")
    r = ST.welch_test(df, "x", F.col("g")).first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va / 5 + vb / 3)
    assert abs(r["statistic"] - t) < 1e-12
    assert 0 < r["p_value"] < 1


def test_mann_whitney_u_with_ties(spark):
    a, b = [1, 2, 2, 5], [2, 3, 4]
    df = spark.createDataFrame([(float(x), True) for x in a] + [(float(x), False) for x in b], "x double, g boolean")
    r = ST.mann_whitney(df, "x", F.col("g")).first()
    u = sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)
    assert abs(r["statistic"] - u) < 1e-12
    assert abs(r["effect_size"] - (2 * u / 12 - 1)) < 1e-12


def test_kruskal_no_ties(spark):
    groups = {"a": [1.0, 2.0, 3.0], "b": [4.0, 5.0, 6.0], "c": [7.0, 8.0, 9.0]}
    df = spark.createDataFrame([(v, g) for g, vs in groups.items() for v in vs], "x double, g string")
    r = ST.kruskal_wallis(df, "x", "g").first()
    n = 9
    h = 12 / (n * (n + 1)) * sum(sum(range(1 + 3 * i, 4 + 3 * i)) ** 2 / 3 for i in range(3)) - 3 * (n + 1)
    assert abs(r["statistic"] - h) < 1e-9


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=200)
    cat = rng.choice(["a", "b", "c"], 200)
    y = 1 + 2 * x1 + (cat == "b") * 0.5 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), str(c), float(v)) for a, c, v in zip(x1, cat, y)], "x1 double, c string, y double")
    res = {r["term"]: r for r in ST.ols_hc3(df, "y", ["x1"], ["c"]).collect()}
    X = np.column_stack([np.ones(200), x1, cat == "b", cat == "c"]).astype(float)
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    assert abs(res["x1"]["coefficient"] - beta[1]) < 1e-9
    e = y - X @ beta
    inv = np.linalg.inv(X.T @ X)
    h = np.einsum("ij,jk,ik->i", X, inv, X)
    cov = inv @ (X.T * (e / (1 - h)) ** 2) @ X @ inv
    assert abs(res["x1"]["std_err"] - math.sqrt(cov[1, 1])) < 1e-9


def test_wilcoxon_of_millions_of_pairs(spark):
    """The third power of the number of pairs leaves 64 bits."""
    n = 2_000_000
    pairs = spark.range(n).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0).alias("diff"))
    r = ST.wilcoxon_signed_rank(pairs).first()
    assert (r["n"], r["n_pairs"], r["statistic"]) == (n, n, n / 2 * (n + 1) / 2)
    assert abs(r["z"]) < 1e-9
