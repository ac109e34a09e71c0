"""Scalar cleaners: the reference's example cases plus edge cases of our own."""

import datetime as dt

from pyspark.sql import functions as F

from staylens.functions import scalars as S


def col1(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_price(spark):
    got = col1(spark, ["$1,250.00", "£99.50", "200.00", None, "not_a_price", "FREE", "", "-$5.00"], S.clean_price)
    assert got == [1250.0, 99.5, 200.0, None, None, None, None, -5.0]


def test_clean_price_nan_is_null(spark):
    assert col1(spark, ["nan", "NaN"], S.clean_price) == [None, None]


def test_parse_bool(spark):
    vals = ["t", "f", "true", "false", "yes", "no", "1", "0", "TRUE", " Y ", "maybe", "x", "na", "null", None]
    assert col1(spark, vals, S.parse_bool) == [True, False, True, False, True, False, True, False, True, True,
                                               None, None, None, None, None]


def test_parse_date(spark):
    got = col1(spark, ["2023-01-15", "not-a-date", "99-99-9999", "", None], S.parse_date)
    assert got == [dt.date(2023, 1, 15), None, None, None, None]


def test_validate_range(spark):
    assert col1(spark, ["-91", "0", "91", "200"], lambda c: S.validate_range(c, -90, 90)) == [None, 0.0, None, None]


def test_cap_sentinel(spark):
    assert col1(spark, ["7", "30", str(2 ** 30), str(2 ** 30 + 1)], S.cap_sentinel) == [7, 30, None, None]


def test_room_type(spark):
    got = col1(spark, ["Entire home/apt", "Private room", "Shared room", "Hotel room", "Submarine"],
               S.normalize_room_type)
    assert got == ["entire_home", "private_room", "shared_room", "hotel_room", None]


def test_percentage(spark):
    assert col1(spark, ["88%", "100%", "0%"], S.clean_percentage) == [0.88, 1.0, 0.0]


def test_property_bucket_order(spark):
    got = col1(spark, ["Treehouse", "Houseboat", "Lighthouse", "Entire condo", "Boutique hotel", "Camper/RV",
                       "Castle", "", None], S.bucket_property_type)
    assert got == ["house", "house", "house", "apartment", "hotel", "unique", "other", "other", "other"]


def test_bathrooms(spark):
    df = spark.createDataFrame([("1 bath",), ("1.5 shared baths",), ("Half-bath",), ("2 private baths",),
                                ("Shared half-bath",), (None,)], "x string")
    c, s = S.parse_bathrooms(F.col("x"))
    got = [tuple(r) for r in df.select(c, s).collect()]
    assert got == [(1.0, None), (1.5, True), (0.5, None), (2.0, False), (0.5, True), (None, None)]


def test_amenities_json(spark):
    df = spark.createDataFrame([('["Wifi", "Kitchen"]',), ("not json",), ("[]",), (None,)], "x string")
    arr = S.json_string_list(F.col("x"))
    got = [tuple(r) for r in df.select(arr, S.any_contains(arr, "wifi")).collect()]
    assert got == [(["wifi", "kitchen"], 1), ([], 0), ([], 0), ([], 0)]


def test_weekend_and_date_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "d date")
    got = [tuple(r) for r in df.select(S.is_weekend(F.col("d")), S.date_key(F.col("d"))).collect()]
    assert got == [(True, 20240106), (False, 20240108)]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    km = df.select(S.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]
    assert abs(km - 111.195) < 0.01


def test_mojibake_and_ascii_keys(spark):
    df = spark.createDataFrame([("Neukölln",)], "x string")
    moj = "Neukölln".encode("utf-8").decode("latin-1")
    r = df.select(S.ascii_key(F.col("x")), S.mojibake_key(F.lit(moj))).first()
    assert r[0] == "neukolln" and r[1] == "Neukölln"


def test_snake_case():
    assert S.snake_case("  Host Response-Rate (%) ") == "host_response_rate"
