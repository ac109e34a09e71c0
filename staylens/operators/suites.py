"""The expectation suites (V1-V8) and warehouse rules (V9, V13) of the rental model.

Both are lists of plain declarations, evaluated over all their tables by ``rulebook.figures`` in one
pass with one shuffle by key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators import rulebook as R
from staylens.operators.validation import _between, expect, rule_category

# Names, values and bounds of the three suites and of the warehouse rules.
ROOM_TYPES = ["entire_home", "private_room", "shared_room", "hotel_room"]
MASTER_COLUMNS = ["id", "host_id", "neighbourhood_cleansed", "latitude", "longitude", "room_type", "accommodates",
                  "availability_365", "price_numeric", "currency_code", "is_de_facto_inactive", "is_active_supply"]
CALENDAR_COLUMNS = ["listing_id", "date", "available", "minimum_nights", "maximum_nights"]
REVIEW_COLUMNS = ["id", "listing_id", "date", "reviewer_id", "reviewer_name", "comments", "comment_length",
                  "comment_is_duplicate"]
MASTER_ROWS = (1_000, 200_000)
CALENDAR_ROWS = (365_000, 40_000_000)
REVIEW_ROWS = (1_000, 5_000_000)
CALENDAR_DAYS = (dt.date(2025, 1, 1), dt.date(2027, 12, 31))
REVIEW_DAYS = (dt.date(2008, 1, 1), dt.date(2026, 12, 31))
YEARS = (2010, 2026)
WAREHOUSE_TABLES = ["dim_city", "dim_neighbourhood", "dim_host", "dim_listing", "dim_date", "fact_calendar",
                    "fact_reviews", "fact_listing_snapshot"]


def listing_master_suite(rows: tuple = MASTER_ROWS) -> list[dict]:
    return [
        expect("row_count_between", min=rows[0], max=rows[1]),
        expect("column_set", columns=MASTER_COLUMNS),
        expect("column_exists", "id"),
        expect("not_null", "id"),
        expect("unique", "id"),
        expect("not_null", "host_id"),
        expect("not_null", "neighbourhood_cleansed"),
        expect("not_null", "latitude"),
        expect("between", "latitude", min=-90.0, max=90.0),
        expect("not_null", "longitude"),
        expect("between", "longitude", min=-180.0, max=180.0),
        expect("not_null", "room_type"),
        expect("in_set", "room_type", values=ROOM_TYPES),
        expect("not_null", "accommodates"),
        expect("between", "accommodates", min=1, max=100),
        expect("between", "minimum_nights", min=1, mostly=0.99),
        expect("not_null", "availability_365"),
        expect("between", "availability_365", min=0, max=365),
        expect("between", "price_numeric", min=0.01, max=50_000, mostly=0.99),
        expect("between", "price_numeric", min=0.01, mostly=0.55),
        expect("between", "review_scores_rating", min=1.0, max=5.0, mostly=0.99),
        expect("not_null", "is_de_facto_inactive"),
        expect("in_set", "is_de_facto_inactive", values=[True, False]),
        expect("not_null", "currency_code"),
        expect("between", "host_tenure_years", min=0.0, max=25.0, mostly=0.99),
        expect("between", "occupancy_proxy", min=0.0, max=1.0),
    ]


def calendar_clean_suite(rows: tuple = CALENDAR_ROWS, days: tuple = CALENDAR_DAYS) -> list[dict]:
    return [
        expect("row_count_between", min=rows[0], max=rows[1]),
        expect("column_set", columns=CALENDAR_COLUMNS, exact=True),
        expect("not_null", "listing_id"),
        expect("not_null", "date"),
        expect("not_null", "available"),
        expect("between", "date", min=days[0], max=days[1]),
        expect("in_set", "available", values=[True, False]),
        expect("between", "minimum_nights", min=1, max=365, mostly=0.99),
        expect("between", "maximum_nights", min=1, mostly=0.99),
    ]


def reviews_clean_suite(rows: tuple = REVIEW_ROWS, days: tuple = REVIEW_DAYS) -> list[dict]:
    return [
        expect("row_count_between", min=rows[0], max=rows[1]),
        expect("column_set", columns=REVIEW_COLUMNS, exact=True),
        expect("not_null", "id"),
        expect("unique", "id"),
        expect("not_null", "listing_id"),
        expect("not_null", "reviewer_id"),
        expect("not_null", "date"),
        expect("between", "date", min=days[0], max=days[1]),
        expect("not_null", "comment_length"),
        expect("between", "comment_length", min=0, max=50_000),
        expect("not_null", "comment_is_duplicate"),
        expect("in_set", "comment_is_duplicate", values=[True, False]),
    ]


def warehouse_rules(warehouse: dict[str, DataFrame], source_neighbourhoods: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """(table, rule, violations, category, passed): all rules over the star schema."""
    def table(name, keys, sums=None, **more):
        return R.Table(name, warehouse[name], keys, sums or {}, **more)

    def null(c):
        return F.col(c).isNull().cast("int")

    def inside(c, low, high):
        return R.failing(_between(F.col(c), low, high))
    listing, date = {"listing": ["listing_key"]}, {"date": ["date_key"]}
    found = R.figures([
        table("dim_listing", listing, {
            "listing_key_not_null": null("listing_key"), "host_key_not_null": null("host_key"),
            "neighbourhood_key_not_null": null("neighbourhood_key"),
            # a missing room type is none of the four either
            "room_type_valid": (~F.coalesce(F.col("room_type").isin(ROOM_TYPES), F.lit(False))).cast("int"),
            "latitude_in_range": inside("latitude", -90, 90), "longitude_in_range": inside("longitude", -180, 180)}),
        table("fact_listing_snapshot", {}, {
            "price_null_or_non_negative": inside("price_numeric", 0, None),
            "availability_365_in_range": inside("availability_365", 0, 365),
            "number_of_reviews_non_negative": inside("number_of_reviews", 0, None)}),
        table("fact_calendar", {**listing, **date, "night": ["listing_key", "date_key"]}, {
            "listing_key_not_null": null("listing_key"), "date_key_not_null": null("date_key"),
            "available_int_is_zero_or_one": R.failing(F.col("available_int").isin(0, 1))}),
        table("fact_reviews", {**listing, **date, "review": ["review_id"]}, {
            "listing_key_not_null": null("listing_key"), "date_key_not_null": null("date_key"),
            "comment_length_non_negative": inside("comment_length", 0, None)}),
        table("dim_neighbourhood", {"neighbourhood": ["neighbourhood_key"]}, {
            "area_positive": F.coalesce(F.col("area_km2") <= 0, F.lit(True)).cast("int")}),
        table("dim_host", {"host": ["source_host_id"]}),
        table("dim_date", date, least={"day": F.unix_date("date"), "year": F.col("year")},
              greatest={"last day": F.unix_date("date"), "last year": F.col("year")}),
        R.Table("source", source_neighbourhoods.select(F.lit(1).alias("one")))])

    def own(t, name):
        return found.measure(t, name)
    span = F.coalesce(own("dim_date", "last day") - own("dim_date", "day") + 1, F.lit(0))
    covered = (own("dim_date", "year") <= years[0]) & (own("dim_date", "last year") >= years[1])
    lost = len(set(WAREHOUSE_TABLES) - set(warehouse))
    rules = {
        **{f"dim_listing.{n}": own("dim_listing", n) for n in (
            "listing_key_not_null", "host_key_not_null", "neighbourhood_key_not_null", "room_type_valid",
            "latitude_in_range", "longitude_in_range")},
        "dim_listing.listing_key_unique": found.repeated("dim_listing", "listing"),
        **{f"fact_listing_snapshot.{n}": own("fact_listing_snapshot", n) for n in (
            "price_null_or_non_negative", "availability_365_in_range", "number_of_reviews_non_negative")},
        "fact_listing_snapshot.fact_snapshot_matches_dim_count": F.abs(
            found.rows("fact_listing_snapshot") - found.rows("dim_listing")),
        **{f"fact_calendar.{n}": own("fact_calendar", n) for n in (
            "listing_key_not_null", "date_key_not_null", "available_int_is_zero_or_one")},
        "fact_calendar.composite_key_unique": found.repeated("fact_calendar", "night"),
        "fact_calendar.referential_integrity_to_dim_listing": found.orphans("fact_calendar", "dim_listing", "listing"),
        "fact_calendar.referential_integrity_to_dim_date": found.orphans("fact_calendar", "dim_date", "date"),
        **{f"fact_reviews.{n}": own("fact_reviews", n) for n in (
            "listing_key_not_null", "date_key_not_null", "comment_length_non_negative")},
        "fact_reviews.review_id_unique": found.repeated("fact_reviews", "review"),
        "fact_reviews.referential_integrity_to_dim_listing": found.orphans("fact_reviews", "dim_listing", "listing"),
        "fact_reviews.referential_integrity_to_dim_date": found.orphans("fact_reviews", "dim_date", "date"),
        "warehouse.dim_neighbourhood_key_unique": found.repeated("dim_neighbourhood", "neighbourhood"),
        "warehouse.dim_neighbourhood_area_positive": own("dim_neighbourhood", "area_positive"),
        "warehouse.dim_neighbourhood_count_matches_source": F.abs(found.rows("dim_neighbourhood") - found.rows("source")),
        "warehouse.dim_host_unique_source_id": found.repeated("dim_host", "host"),
        "warehouse.dim_date_monotonic": F.abs(span - found.rows("dim_date")),
        "warehouse.dim_date_year_bounds": (~F.coalesce(covered, F.lit(False))).cast("int"),
        "warehouse.dim_date_key_unique": found.repeated("dim_date", "date"),
        "warehouse.warehouse_tables_present": F.lit(lost),
    }
    out = R.rule_rows(found, rules)
    return out.select(F.split_part("rule", F.lit("."), F.lit(1)).alias("table"),
                      F.split_part("rule", F.lit("."), F.lit(2)).alias("rule"), "violations").withColumns(
        {"category": rule_category(F.col("rule")), "passed": F.col("violations") == 0})


def category_summary(rules: DataFrame) -> DataFrame:
    """Rules, failed rules and violations of each category."""
    return rules.groupBy("category").agg(F.count(F.lit(1)).alias("rules"), F.count_if(~F.col("passed")).alias("failed"),
                                         F.sum("violations").alias("violations"))
