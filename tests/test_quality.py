"""Quarantine rules (reference listing/calendar/review cleaners) and conservation."""

from pyspark.sql import functions as F

from staylens.operators import quality as Q

BASE = dict(id="1", host_id="10", name=" A ", price="$100.00", latitude="51.5", longitude="-0.1",
            room_type="Entire home/apt", minimum_nights="2", maximum_nights="30", bedrooms="1",
            property_type="Entire rental unit", bathrooms_text="1 bath", host_is_superhost="t",
            neighbourhood_cleansed=" Camden ", license="x")
COLS = list(BASE)


def listing_df(spark, rows):
    return spark.createDataFrame([tuple({**BASE, **r}[c] for c in COLS) for r in rows],
                                 ", ".join(f"{c} string" for c in COLS))


def reasons(q):
    return {r["id"]: r["rejection_reason"] for r in q.rejected.collect()}


def test_valid_row_is_clean(spark):
    q = Q.clean_listings(listing_df(spark, [{}]))
    row = q.clean.first()
    assert q.rejected.count() == 0
    assert row["price_numeric"] == 100.0 and row["room_type"] == "entire_home"
    assert row["neighbourhood_cleansed"] == "Camden" and row["bedrooms_is_missing"] is False
    assert "license" not in q.clean.columns and "price" not in q.clean.columns


def test_bad_coordinates_and_price(spark):
    q = Q.clean_listings(listing_df(spark, [{"id": "1", "latitude": "200"}, {"id": "2", "longitude": "300"},
                                            {"id": "3", "latitude": None}, {"id": "4", "price": "-$5"}]))
    r = reasons(q)
    assert r[1] == "invalid_latitude" and r[2] == "invalid_longitude"
    assert r[3] == "invalid_latitude" and r[4] == "negative_price"


def test_duplicate_ids_all_copies_rejected(spark):
    q = Q.clean_listings(listing_df(spark, [{"id": "99"}, {"id": "99"}, {"id": "5"}]))
    assert sorted(r["id"] for r in q.rejected.collect()) == [99, 99]
    assert q.clean.count() == 1


def test_null_ids_are_duplicates_of_each_other(spark):
    q = Q.clean_listings(listing_df(spark, [{"id": None}, {"id": None}]))
    got = [r["rejection_reason"] for r in q.rejected.collect()]
    assert got == ["missing_listing_id,duplicate_listing_key"] * 2


def test_null_price_is_kept(spark):
    q = Q.clean_listings(listing_df(spark, [{"price": None}]))
    assert q.clean.count() == 1 and q.clean.first()["price_numeric"] is None


def test_conservation(spark):
    rows = [{"id": str(i % 40), "latitude": "95" if i % 7 == 0 else "51.5"} for i in range(50)]
    q = Q.clean_listings(listing_df(spark, rows))
    assert q.clean.count() + q.rejected.count() == 50


def test_inactive_flag(spark):
    q = Q.clean_listings(listing_df(spark, [{"id": "1", "minimum_nights": "365"},
                                            {"id": "2", "minimum_nights": str(2 ** 31 - 1)}]))
    got = {r["id"]: (r["minimum_nights"], r["is_de_facto_inactive"]) for r in q.clean.collect()}
    assert got == {1: (365, True), 2: (None, False)}


def test_calendar_quarantine(spark):
    raw = spark.createDataFrame([("1", "2024-01-01", "t", "1", "30"), ("1", "2024-01-01", "f", "1", "30"),
                                 ("2", "bad", "t", "1", "30"), ("3", "2024-01-02", "maybe", "1", "30"),
                                 ("4", "2024-01-02", "f", "1", "30")],
                                "listing_id string, date string, available string, minimum_nights string, "
                                "maximum_nights string")
    q = Q.clean_calendar(raw)
    assert [r["listing_id"] for r in q.clean.collect()] == [4]
    assert q.rejected.count() == 4


def test_reviews_duplicate_comment_flag_before_quarantine(spark):
    raw = spark.createDataFrame([("1", "1", "2024-01-01", "5", "x", " great "), ("1", None, "2024-01-01", "5", "x", "great"),
                                 ("1", "3", "2024-01-01", "5", "x", None)],
                                "listing_id string, id string, date string, reviewer_id string, "
                                "reviewer_name string, comments string")
    q = Q.clean_reviews(raw)
    clean = {r["id"]: (r["comment_is_duplicate"], r["comment_length"]) for r in q.clean.collect()}
    assert clean == {1: (True, 5), 3: (False, 0)}
