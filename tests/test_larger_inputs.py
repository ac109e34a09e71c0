"""Plans and results that must hold when tables grow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staylens.operators import bootstrap as B
from staylens.operators import models as MO
from staylens.operators import ordered as O
from staylens.operators import profile as PR
from staylens.operators import summaries as SU


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_completeness_follows_the_nulls(spark):
    rows = [(1.0, None if i < 2 else 1.0, None if i < 19 else 1.0) for i in range(20)]
    got = {r["column"]: r for r in PR.extended_profile(
        spark.createDataFrame(rows, "accommodates double, bedrooms double, id double"),
        ["accommodates", "bedrooms", "id"]).collect()}
    assert {c: r["completeness"] for c, r in got.items()} == {
        "accommodates": "complete", "bedrooms": "partial", "id": "sparse"}
    assert {c: r["completeness_class"] for c, r in got.items()} == {
        "accommodates": "important", "bedrooms": "important", "id": "critical"}


def test_draws_are_made_for_many_replicates_at_once(spark):
    """The draws of a replicate are no rows or columns of Spark's."""
    df = spark.createDataFrame([(1.0, True), (2.0, False)], "x double, g boolean")
    assert "Generate" not in plan(B.replicate_means(df, "x", F.col("g"), 100))


def test_draws_by_hand(spark):
    import hashlib
    df = spark.createDataFrame([(1.5, True), (1.5, True), (4.0, True), (2.0, False)], "x double, g boolean")
    got = {r["rep"]: r["mean_1"] for r in B.replicate_means(df, "x", F.col("g"), 11, seed=7).collect()}
    steps = B.poisson_steps()

    def weight(name, copy, rep):
        digest = hashlib.sha256(f"7|1|{name}|{copy}|{rep // 8}".encode()).digest()
        u = int.from_bytes(digest[4 * (rep % 8):4 * (rep % 8) + 4], "big")
        return sum(step <= u for step in steps)
    for rep in range(11):
        a, b = weight("1.500000000", 0, rep) + weight("1.500000000", 1, rep), weight("4.000000000", 0, rep)
        assert got[rep] == (pytest.approx((1.5 * a + 4.0 * b) / (a + b)) if a + b else None)


def test_kmeans_points_are_kept_by_the_fit(spark, monkeypatch):
    """A cached table would be read and its vectors rebuilt in every iteration."""
    seen = []

    class Seen(MO.KMeans):
        def fit(self, points):
            seen.append(points.storageLevel.useMemory)
            return super().fit(points)
    monkeypatch.setattr(MO, "KMeans", Seen)
    vec = MO.assemble(spark.range(60).select(F.col("id").cast("double").alias("x")), ["x"]).cache()
    assert MO.best_kmeans(vec, 2).summary.k == 2
    assert seen == [False] * MO.INITS


def test_master_deals_listings_by_id_only(spark):
    from staylens.plans.pipeline import Pipeline
    p = Pipeline(spark, "/root/testdata/sf0.001")
    ns = spark.createDataFrame([("X", 1, 2.0, 3.0)], "neighbourhood string, listing_count long, "
                               "median_price_gbp double, listings_per_km2 double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = plan(SU.listing_master(p.listings, p.review_summary, p.calendar_summary, ns, dt.date(2024, 2, 15)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(neighbourhood_cleansed" not in got


def test_quantiles_deal_counts_once(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        q = O.exact_quantiles(df, ["g"], {"m": ("v", 0.5)})
        assert "SortMergeJoin" not in plan(q)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r["g"]: r["m"] for r in q.collect()} == {0: 24.0, 1: 25.0}


def test_importance_plan_does_not_grow_with_repeats(spark):
    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.log1p(F.col("a") + F.coalesce("b", F.lit(0.0))))
    test = spark.range(40).select("id", F.col("id").cast("int").alias("a"), F.lit(2.0).alias("b"),
                                  (F.col("id") + 2.0).alias("price_numeric"))
    size = lambda n: len(plan(MO.permutation_importance(Model(), test, ["a", "b"], {"b": 1.0}, repeats=n)).splitlines())
    assert size(3) == size(1)
    got = {r["feature"]: r for r in MO.permutation_importance(Model(), test, ["a", "b"], {"b": 1.0}, repeats=3).collect()}
    assert got["a"]["mae_increase"] > 5 and abs(got["b"]["mae_increase"]) < 1e-9


def test_fit_finds_medians_once_and_keeps_no_rows(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(MO, "column_medians", lambda df, cols, was=MO.column_medians: asked.append(cols) or was(df, cols))
    rows = [(i, None if i % 5 == 0 else i, "x" if i % 3 else None, "p", float(i + 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a int, room_type string, neighbourhood_cleansed string, price_numeric double")
    df = df.withColumn("log_price", F.log1p("price_numeric"))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    model, fill = MO.fit_price_model(df, "ridge", ["a"], ["room_type", "neighbourhood_cleansed"])
    assert fill == {"a": 30.0, "room_type": "x", "neighbourhood_cleansed": "p"}
    assert MO.score(model, df, fill).where("predicted_price IS NULL").count() == 0
    assert len(asked) == 1 and spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_boosting_has_a_task_a_core(spark, monkeypatch):
    """However the rows were split before: the same rows in the same places, none lost."""
    monkeypatch.setattr(MO, "BOOSTING_TASK_ROWS", 50)
    df = spark.range(120).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("a"), F.lit("x").alias("room_type"),
                                 F.log1p("id").alias("log_price"))
    twice = df.unionByName(df.where("id % 10 = 0"))
    cores = spark.sparkContext.defaultParallelism
    places = lambda n, rows: [list(map(tuple, p)) for p in MO.dealt_for_boosting(twice.repartition(n), rows).rdd.glom().collect()]
    assert places(50, 132) == places(3, 132) and len(places(50, 132)) == cores
    assert sum(map(len, places(50, 132))) == 132 and len(places(2, 50 * cores + 1)) == cores + 1
    seen = []

    class Stages:
        def __init__(self, stages):
            pass

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))
    monkeypatch.setattr(MO, "MLPipeline", Stages)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    MO.fit_price_model(twice.repartition(50), "gradient_boosting", ["a"], ["room_type"])
    assert seen == [(cores, 132)] and spark.sparkContext._jsc.getPersistentRDDs().size() == kept


def test_snapshots_clean_the_columns_they_need(spark):
    from staylens.plans.pipeline import Pipeline
    sf = "/root/testdata/sf0.001"
    p = Pipeline(spark, sf)
    read = plan(p.listing_states)
    assert "o_totalprice" in read and not any(c in read for c in ("c_name", "c_mktsegment", "first_order_ts", "amenities"))
    spans = p.calendar_summary.select(F.col("listing_id").alias("id"), "first_calendar_date", "last_calendar_date", "availability_rate")
    want = p.listings.select("id", "price_numeric", "room_type", "is_de_facto_inactive").join(spans, "id")
    assert sorted(map(str, p.listing_states.collect())) == sorted(map(str, want.collect()))
