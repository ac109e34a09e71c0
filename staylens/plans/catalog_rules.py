"""Registered queries: the three expectation suites and all warehouse rules, on the tables as they are and
on tables with null, repeated, orphan and out-of-range values bound in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators import suites as SU
from staylens.operators.validation import run_suites, suite_summary
from staylens.plans import bindings as B
from staylens.plans.catalog import query
from staylens.plans.pipeline import WAREHOUSE_NEEDS, Pipeline, shared
from staylens.session import release


def _suites(p: Pipeline) -> DataFrame:
    # upper row bounds belong to a deployment, not to the data's size
    return run_suites({
        "listing_master": (p.master, SU.listing_master_suite((SU.MASTER_ROWS[0], None))),
        "calendar_clean": (p.calendar, SU.calendar_clean_suite((SU.CALENDAR_ROWS[0], None))),
        "reviews_clean": (p.reviews, SU.reviews_clean_suite((SU.REVIEW_ROWS[0], None)))})


@query("validation_suites")
def _(spark, sf):
    """V7: all expectations of the three suites, one shuffle."""
    return _suites(shared(spark, sf)).withColumn("unexpected_pct", F.round("unexpected_pct", 4))


@query("validation_suites_summary")
def _(spark, sf):
    return suite_summary(_suites(shared(spark, sf)))


def faulty(p: Pipeline) -> dict[str, DataFrame]:
    """The warehouse with faults that follow from the keys: nulls, copies, orphans, values out of range."""
    def where(every: int, column: str, value, key: str = "listing_key") -> Column:
        return F.when(F.col(key) % every == 0, value).otherwise(F.col(column))

    w, null = dict(p.warehouse()), F.lit(None)
    calendar, reviews, listings, days = w["fact_calendar"], w["fact_reviews"], w["dim_listing"], w["dim_date"]
    areas = w["dim_neighbourhood"]
    w["fact_calendar"] = calendar.withColumns({
        "listing_key": F.when(F.col("listing_key") % 97 == 0, null).otherwise(where(89, "listing_key", F.col("listing_key") + 10**9)),
        "date_key": where(53, "date_key", null, "date_key"), "available_int": where(41, "available_int", 2)}).unionByName(
        calendar.where("listing_key % 83 = 0"))
    w["fact_reviews"] = reviews.withColumns({
        "listing_key": where(47, "listing_key", null, "review_id"),
        "date_key": where(43, "date_key", F.col("date_key") + 50_000_000, "review_id"),
        "comment_length": where(59, "comment_length", -1, "review_id")}).unionByName(reviews.where("review_id % 31 = 0"))
    w["dim_listing"] = listings.withColumns({
        "listing_key": where(101, "listing_key", null), "host_key": where(71, "host_key", null),
        "neighbourhood_key": where(73, "neighbourhood_key", null), "room_type": where(61, "room_type", "loft"),
        "latitude": where(67, "latitude", 95.0), "longitude": where(69, "longitude", -200.0)}).unionByName(
        listings.where("listing_key % 79 = 0"))
    w["fact_listing_snapshot"] = w["fact_listing_snapshot"].withColumns({
        "price_numeric": where(37, "price_numeric", -1.0), "availability_365": where(73, "availability_365", 400),
        "number_of_reviews": where(29, "number_of_reviews", -3)})
    w["dim_neighbourhood"] = areas.withColumn("area_km2", where(7, "area_km2", null, "neighbourhood_key")).unionByName(
        areas.where("neighbourhood_key % 11 = 0"))
    w["dim_date"] = days.where("date_key % 100 <> 13").unionByName(days.where("date_key % 10000 = 101"))
    return {k: v for k, v in w.items() if k != "dim_city"}


@query("validation_rules")
def _(spark, sf):
    """V9: all warehouse rules, one shuffle by key."""
    p = shared(spark, sf)
    return SU.warehouse_rules(p.warehouse(), B.raw_neighbourhoods(spark, sf))


def _faulty_rules(spark, sf) -> DataFrame:
    """The rules read each fact table several times, and few columns of a listing."""
    p = shared(spark, sf, WAREHOUSE_NEEDS, ("listings", "calendar", "reviews"))
    rules = SU.warehouse_rules(faulty(p), B.raw_neighbourhoods(spark, sf))
    release(spark)  # the dimensions are written by now
    return rules


@query("validation_rules_on_faults")
def _(spark, sf):
    return _faulty_rules(spark, sf)


@query("validation_rule_categories")
def _(spark, sf):
    """V13 over the faulty tables."""
    return SU.category_summary(_faulty_rules(spark, sf))
