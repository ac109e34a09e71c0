"""Rules over several tables against plain Python, and the plan's single shuffle by key."""

import random

from pyspark.sql import functions as F

from staylens.operators import rulebook as R
from staylens.operators.validation import expect, run_suites, suite_summary


def tables(spark, seed=1, n=400):
    rng = random.Random(seed)
    parent = [(rng.choice([None, *range(60)]), rng.randrange(5)) for _ in range(n // 4)]
    child = [(rng.choice([None, 7, 7, 7, *range(80)]), rng.choice([None, 1, 2, 3]), rng.uniform(-1, 2)) for _ in range(n)]
    return (spark.createDataFrame(parent, "id long, kind int"),
            spark.createDataFrame(child, "id long, day int, x double").repartition(5), parent, child)


def run(spark, seed=1, n=400):
    p, c, parent, child = tables(spark, seed, n)
    found = R.figures([
        R.Table("parent", p, {"id": ["id"]}, {"odd": (F.col("kind") % 2).cast("int")}),
        R.Table("child", c, {"id": ["id"], "pair": ["id", "day"]}, {"low": R.failing(F.col("x") >= 0)},
                least={"first": F.col("day")}, greatest={"last": F.col("day")}),
        R.Table("other", p.where("kind = 4"))])
    return found, parent, child


def test_figures_equal_plain_counts(spark):
    for seed in range(3):
        found, parent, child = run(spark, seed)
        r = found.df.first().asDict()
        ids = {i for i, _ in parent if i is not None}
        pairs = [(i, d) for i, d, _ in child if i is not None and d is not None]
        assert r["rows parent"] == len(parent) and r["rows child"] == len(child)
        assert r["rows other"] == sum(k == 4 for _, k in parent)
        assert r["parent.odd"] == sum(k % 2 for _, k in parent)
        assert r["child.low"] == sum(x < 0 for _, _, x in child)
        assert (r["child.first"], r["child.last"]) == (1, 3)
        assert r["repeated parent id"] == len(parent) - len(ids)
        assert r["repeated child pair"] == len(child) - len(set(pairs))
        assert r["copies child pair"] == sum(pairs.count(x) > 1 for x in pairs)
        assert r["orphans child parent id"] == sum(i not in ids for i, _, _ in child)
        assert r["orphans parent child id"] == sum(i is None or i not in {c[0] for c in child} for i, _ in parent)


def test_empty_tables(spark):
    p, c, _, _ = tables(spark)
    found = R.figures([R.Table("a", p.where("false"), {"id": ["id"]}, {"m": F.col("kind")}, least={"l": F.col("kind")}),
                       R.Table("b", c.where("false"), {"id": ["id"]})])
    assert found.df.first().asDict() == {"a.m": 0, "a.l": None, "rows a": 0, "repeated a id": 0, "copies a id": 0, "orphans a b id": 0,
                                         "rows b": 0, "repeated b id": 0, "copies b id": 0, "orphans b a id": 0}


def test_text_keys(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, n int")
    b = spark.createDataFrame([(1,), (None,)], "n int")
    r = R.figures([R.Table("a", a, {"k": ["k"], "n": ["n"]}), R.Table("b", b, {"n": ["n"]})]).df.first()
    assert r["copies a k"] == 2 and r["repeated a k"] == 2 and r["orphans a b n"] == 2 and r["orphans b a n"] == 1


def test_one_shuffle_by_key(spark):
    found, _, _ = run(spark)
    plan = found.df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Exchange") == 2 + plan.count("RoundRobinPartitioning")  # the other gathers one row a task


def test_suites_share_the_pass(spark):
    a = spark.createDataFrame([(1, "x", 0.5), (1, "y", 2.0), (None, "z", None), (4, None, -1.0)], "id long, k string, v double")
    b = spark.createDataFrame([(5,), (6,)], "id long")
    got = run_suites({
        "a": (a, [expect("row_count_between", min=1, max=3), expect("unique", "id"), expect("not_null", "id"),
                  expect("in_set", "k", values=["x", "y"]), expect("between", "v", min=0.0, mostly=0.6), expect("between", "gone", min=1),
                  expect("column_set", columns=["id", "k"], exact=True), expect("column_exists", "v")]),
        "b": (b, [expect("unique", "id"), expect("not_null", "id")])})
    rows = {(r["suite"], r["idx"]): r for r in got.collect()}
    assert [rows["a", i]["success"] for i in range(8)] == [False, False, False, False, True, False, False, True]
    assert (rows["a", 1]["unexpected_count"], rows["a", 1]["element_count"]) == (2, 3)
    assert (rows["a", 3]["unexpected_count"], rows["a", 3]["element_count"]) == (1, 3)
    assert rows["a", 6]["observed"] == "v" and rows["a", 5]["observed"] == "column missing"
    assert {(r["suite"], r["evaluated"], r["passed"], r["failed"]) for r in suite_summary(got).collect()} == {("a", 8, 2, 6), ("b", 2, 2, 0)}


def test_measures_are_not_dealt_by_key(spark):
    found, _, _ = run(spark)
    lines = found.df._jdf.queryExecution().executedPlan().toString().splitlines()
    below = lines[next(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x) + 1]
    assert "Aggregate" in below and "partial_sum" not in below and "partial_min" not in below and "partial_max" not in below
