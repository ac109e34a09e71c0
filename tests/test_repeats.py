"""Keep-none duplicate flags against plain counting, hot keys, and the plan."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staylens.operators.repeats import Seen, flag_repeats


def rows_of(seed, n=3000):
    rng = random.Random(seed)
    return [(rng.choice([None, 5, 5, 5, *range(2000)]), rng.choice([None, "a", "a", f"t{rng.randrange(900)}"]), i) for i in range(n)]


@pytest.mark.parametrize("keys", [["id"], ["text"], ["id", "text"]])
@pytest.mark.parametrize("remembered", [0, 1, 4096])
def test_flags_equal_plain_counts(spark, keys, remembered):
    rows = rows_of(len(keys))
    df = spark.createDataFrame(rows, "id long, text string, row long").repartition(5)
    got = flag_repeats(df, keys, "again", remembered).collect()
    at = {"id": 0, "text": 1}
    count = Counter(tuple(r[at[k]] for k in keys) for r in rows)
    assert len(got) == len(rows)
    assert {r["row"]: r["again"] for r in got} == {r[2]: count[tuple(r[at[k]] for k in keys)] > 1 for r in rows}


def test_equal_digests_of_unequal_keys_are_told_apart():
    seen = Seen([0])
    batch = pa.record_batch([pa.array(["x", "y", "x", "x", None, "y"])], names=["k"])
    assert seen.known_copies(batch, np.full(6, 9)).tolist() == [False, False, False, True, False, False]
    assert seen.known_copies(batch, np.full(6, 9)).tolist() == [True, False, True, True, False, False]


def test_a_hot_key_is_spread(spark):
    """A third of all rows have one key: its home gets two rows a task, the rest are dealt evenly."""
    df = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"), "id")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = flag_repeats(df, ["text"], "again").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("task").count().collect()]
        assert got.where("again").count() == 20_000 and got.where("again and text <> 'hot'").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(sizes) == 16 and max(sizes) < 1.3 * 60_000 / 16


def test_one_scan_and_one_exchange(spark, tmp_path):
    spark.createDataFrame(rows_of(1), "id long, text string, row long").write.parquet(f"{tmp_path}/t")
    df = flag_repeats(spark.read.parquet(f"{tmp_path}/t"), ["text"], "again")
    for out in (df, df.where("again")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1


def test_empty(spark):
    assert flag_repeats(spark.createDataFrame([], "id long"), ["id"], "again").count() == 0
