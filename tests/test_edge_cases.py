"""Constant, empty and extreme inputs; exact quantiles and the elbow rule."""

import numpy as np
from pyspark.sql import functions as F

from staylens.functions import scalars as S
from staylens.operators import eda, geo, models, stats
from staylens.operators.ordered import exact_quantiles, ordered_index


def test_nullable_long_keys_keep_their_values(spark):
    big = 1234567890123456789
    df = spark.createDataFrame([(big, 1), (None, 2), (big + 1, 3)], "k long, i long")
    got = {r["k"]: r["rn"] for r in ordered_index(df, ["i"]).collect()}
    assert got == {big: 1, None: 2, big + 1: 3}


def test_exact_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(v) if rng.random() > .1 else None, float(w)) for g, v, w in zip(
        rng.choice(["a", "b", None], 500, p=[.9, .08, .02]), rng.integers(0, 40, 500), rng.normal(size=500))]
    df = spark.createDataFrame(rows, "g string, v double, w double").unionByName(
        spark.createDataFrame([("empty", None, None)], "g string, v double, w double"))
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], {"m": ("v", .5), "p": ("w", .95), "lo": ("v", .25)}).collect()}
    for g in ("a", "b", None):
        v = [x[1] for x in rows if x[0] == g and x[1] is not None]
        assert np.isclose(got[g]["m"], np.quantile(v, .5)) and np.isclose(got[g]["lo"], np.quantile(v, .25))
        assert np.isclose(got[g]["p"], np.quantile([x[2] for x in rows if x[0] == g], .95))
    assert "empty" not in got


def test_histogram_of_a_constant(spark):
    got = eda.histogram(spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in got] == [2, 0, 0, 0]


def test_tests_without_variance_are_null(spark):
    df = spark.createDataFrame([(1.0, True), (1.0, True), (1.0, False), (1.0, False)], "x double, g boolean")
    assert stats.welch_stats(df, "x", F.col("g")).first()["statistic"] is None
    assert stats.mann_whitney(df, "x", F.col("g")).first()["z"] is None
    assert stats.welch_stats(df.where("false"), "x", F.col("g")).first()["statistic"] is None


def test_hash_bucket_of_large_ids(spark):
    got = [r[0] for r in spark.createDataFrame([(2**62,), (-5,), (4 * 10**9,)], "k long").select(models.hash_bucket("k", 100)).collect()]
    assert all(0 <= x < 100 for x in got)


def test_mojibake_key(spark):
    bad = "Köln".encode().decode("latin-1")
    df = spark.createDataFrame([(bad,), (" Łódź ",), ("Köln",), (None,)], "t string")
    assert [r[0] for r in df.select(S.mojibake_key(F.col("t"))).collect()] == ["Köln", "Łódź", "Köln", None]


def test_fallback_join_skips_ambiguous_keys(spark):
    left = spark.createDataFrame([("Köln".encode().decode("latin-1"),), ("Koln",), ("Berlin",)], "n string")
    right = spark.createDataFrame([("Köln", 1), ("Berlin", 2), ("Berlin", 3)], "m string, v int")
    got = {r["n"]: (r["v"], r["match_kind"]) for r in geo.fallback_key_join(left, right, "n", "m", ["v"]).collect()}
    assert list(got.values()) == [(1, "mojibake"), (1, "ascii"), (None, None)]


def test_choose_k():
    sweep = [dict(k=k, pct_drop=d, silhouette_sq=s) for k, d, s in
             [(2, None, .2), (3, 9.571, .1), (4, 5.983, .3), (5, 4.638, .1), (6, 1.0, .1)]]
    assert models.choose_k(sweep) == 5
    assert models.choose_k([{**r, "pct_drop": None if r["k"] == 2 else 9.0} for r in sweep]) == 4
