"""Queries deal and keep only the rows and columns that they need, with the results of the wide tables."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylens.operators import features as FE
from staylens.operators import models as MO
from staylens.operators import ordered as O
from staylens.operators import repeats as R
from staylens.plans import catalog as C
from staylens.plans import pipeline as P

SF = "/root/testdata/sf0.001"


def plan(df):
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [0, 100])
def test_listed_repeats_equal_plain_counts(spark, monkeypatch, most):
    """Whether the repeated keys are few or many; null keys are equal to each other."""
    monkeypatch.setattr(R, "BROADCAST_KEYS", most)
    ids = [None, None, 0, 0, 0, 7, *range(10, 60), 2**62, 2**62]
    df = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(ids)], "id long, t string").repartition(3)
    got = R.flag_listed_repeats(df, ["id"], "again")
    assert got.columns == ["id", "t", "again"]
    assert Counter(map(tuple, got.collect())) == Counter((k, f"t{i}", ids.count(k) > 1) for i, k in enumerate(ids))
    assert R.flag_listed_repeats(df.where("id = 7"), ["id"], "again").first()["again"] is False


def test_rows_of_few_repeats_are_not_dealt(spark, tmp_path):
    spark.createDataFrame([(1, "a", "b"), (1, "c", "d"), (2, "e", "f")], "id long, t string, u string").write.parquet(f"{tmp_path}/t")
    found = plan(R.flag_listed_repeats(spark.read.parquet(f"{tmp_path}/t"), ["id"], "again").select("id", "t", "again"))
    assert "Exchange hashpartitioning" not in found and "ReadSchema: struct<id:bigint,t:string>" in found


def test_no_digest_goes_through_the_exchange(spark):
    found = plan(R.flag_repeats(spark.createDataFrame([(1, "a")], "id long, t string"), ["id"], "again"))
    assert "__digest" not in re.search(r"MapInArrow run\(.*?\)#\d+, \[(.*?)\]", found)[1] and found.count("Exchange") == 1


def test_features_are_those_of_the_wide_tables(spark):
    want = FE.listing_features(P.Pipeline(spark, SF).master)
    p = P.Pipeline(spark, SF, persist=True, columns=C.FEATURE_NEEDS, kept=P.LISTINGS_ONLY)
    got = FE.listing_features(p.master)
    assert "lineitem" not in plan(got) and plan(got).count("from_json(") == 1
    kept = next(x for x in plan(p.listings).splitlines() if "InMemoryRelation" in x)
    assert "amenities" in kept and not any(f"{c}#" in kept for c in ("name", "price_raw", "bathrooms_text", "last_scraped"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    p.listings_q.flagged.unpersist()


def test_narrow_warehouse_is_the_wide_one(spark):
    wide, narrow = P.Pipeline(spark, SF), P.Pipeline(spark, SF, columns=P.WAREHOUSE_NEEDS)
    for name, df in narrow.warehouse().items():
        assert df.columns == getattr(wide, name).columns
    for name in ("dim_listing", "fact_listing_snapshot", "fact_reviews"):
        assert sorted(map(str, getattr(narrow, name).collect())) == sorted(map(str, getattr(wide, name).collect()))


def test_features_are_written_and_training_rows_not_kept(spark, monkeypatch):
    def kept():
        return spark.sparkContext._jsc.getPersistentRDDs().size()
    f = C._features(spark, SF)
    assert "FileScan parquet" in plan(f) and "features-" in plan(f)
    before, during = kept(), []

    class Stages:
        def __init__(self, stages):
            pass

        def fit(self, rows):
            rows.count()
            during.append(kept())
    monkeypatch.setattr(MO, "MLPipeline", Stages)
    MO.fit_price_model(f, "ridge", ["beds"], ["room_type"])
    assert during == [before]


def test_importance_moves_values_not_rows(spark, monkeypatch):
    """Each feature's values at the places of the seeded order; the copies' rows are never dealt."""
    seen = []

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.log1p(F.col("a") * 3.0 + F.coalesce("b", F.lit(0.0))))
    monkeypatch.setattr(MO, "score", lambda model, df, fill, was=MO.score: seen.append(plan(df)) or was(model, df, fill))
    test = spark.range(30, numPartitions=2).select(
        "id", F.when(F.col("id") % 9 > 0, F.col("id") * 2).alias("a"), (F.col("id") / 4).alias("b"), F.lit("x").alias("room_type"),
        (F.col("id") * 7 + 2.0).alias("price_numeric"))
    got = {r["feature"]: r["mae_increase"] for r in MO.permutation_importance(Model(), test, ["a", "b"], {"a": 1, "b": 1.0}, repeats=1).collect()}
    rows = seen[1].split("InMemoryRelation")[0]  # the kept rows are not dealt again
    assert "__src" not in seen[1] and "Exchange hashpartitioning(__pid" not in rows
    order = {r["n"]: r for r in O.ordered_index(test.select("id", "a", "b", F.rand(42).alias("r")), ["r", "id"], rn_col="n").collect()}
    rows = test.orderBy("id").collect()

    def error(row, **new):
        v = {"a": row["a"], "b": row["b"], **new}
        return abs((1 if v["a"] is None else v["a"]) * 3.0 + v["b"] - row["price_numeric"])
    base = sum(map(error, rows)) / 30
    for i, f in enumerate(["a", "b"]):
        moved = [error(r, **{f: order[(at + 1 + i * 7919 + 1) % 30 + 1][f]}) for at, r in enumerate(rows)]
        assert got[f] == pytest.approx(sum(moved) / 30 - base)
