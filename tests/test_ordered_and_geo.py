"""Distributed ordered index vs brute force; polygon areas vs closed form."""

import math
import random

from pyspark.sql import functions as F

from staylens.operators import geo
from staylens.operators.eda import exact_quantile
from staylens.operators.ordered import ordered_index, with_ntile


def test_ordered_index_matches_python(spark):
    random.seed(1)
    rows = [(i, float(random.randint(0, 50))) for i in range(500)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r["k"]: (r["rn"], r["cum_value"]) for r in
           ordered_index(df, [F.col("v"), F.col("k")], value_col="v", num_partitions=7).collect()}
    exp, cum = {}, 0.0
    for n, (k, v) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])), 1):
        cum += v
        exp[k] = (n, cum)
    assert got == exp


def test_ntile_matches_definition(spark):
    df = spark.range(23).withColumnRenamed("id", "k")
    got = [r["nt"] for r in with_ntile(df, [F.col("k")], 10, "nt").orderBy("k").collect()]
    assert got == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5, 6, 6, 7, 7, 8, 8, 9, 9, 10, 10]


def test_exact_quantile_linear(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s = sorted(vals)
    for p in (0.25, 0.5, 0.99):
        h = (len(s) - 1) * p
        lo = s[math.floor(h)]
        exp = lo + (s[math.ceil(h)] - lo) * (h - math.floor(h))
        assert abs(exact_quantile(df, "x", p).first()["q"] - exp) < 1e-12


def box(lat0, lon0, lat1, lon1):
    lat0, lon0, lat1, lon1 = map(float, (lat0, lon0, lat1, lon1))
    return [[lon0, lat0], [lon1, lat0], [lon1, lat1], [lon0, lat1], [lon0, lat0]]


def test_polygon_area_box_hole_multipart(spark):
    R = 6371.0
    full = R * R * math.radians(1) * (math.sin(math.radians(1)) - 0)
    rows = [("box", [[box(0, 0, 1, 1)]]),
            ("hole", [[box(0, 0, 1, 1), box(0.25, 0.25, 0.75, 0.75)]]),
            ("two", [[box(0, 0, 1, 1)], [box(10, 10, 11, 11)]])]
    df = spark.createDataFrame(rows, "neighbourhood string, coordinates array<array<array<array<double>>>>")
    got = {r["neighbourhood"]: r for r in geo.polygon_metrics(df).collect()}
    assert abs(got["box"]["area_km2"] - full) < 1e-6
    assert abs(got["box"]["area_km2"] - 12364) < 1
    inner = R * R * math.radians(0.5) * (math.sin(math.radians(0.75)) - math.sin(math.radians(0.25)))
    assert abs(got["hole"]["area_km2"] - (full - inner)) < 1e-6
    assert abs(got["box"]["centroid_longitude"] - 0.5) < 1e-9
    second = R * R * math.radians(1) * (math.sin(math.radians(11)) - math.sin(math.radians(10)))
    assert abs(got["two"]["area_km2"] - (full + second)) < 1e-6


def test_fallback_key_join(spark):
    left = spark.createDataFrame([("Neukölln",), ("Mitte",), ("Zürich",)], "name string")
    moj = "Mitte"
    right = spark.createDataFrame([("Neukölln".encode("utf-8").decode("latin-1"), 1.0), (moj, 2.0),
                                   ("Zurich", 3.0)], "name string, v double")
    got = {r["name"]: (r["v"], r["match_kind"]) for r in
           geo.fallback_key_join(left, right, "name", "name", ["v"]).collect()}
    assert got["Mitte"] == (2.0, "exact") and got["Zürich"] == (3.0, "ascii")
