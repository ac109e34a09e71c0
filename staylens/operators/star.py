"""Star schema: 5 dimensions, 3 facts (G1, W1, AG5, J4, SC19, SC22).

Surrogate keys come from ``ordered_index`` (range partitioned, no
single-partition window). Dimension attributes that the source may hold with
several values per key are made deterministic: the value from the row with the
smallest listing id among rows where the value is present.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions import scalars as S
from staylens.operators.ordered import ordered_index

HOST_ATTRS = ["host_since", "host_is_superhost", "host_response_time", "host_response_rate",
              "host_acceptance_rate", "host_identity_verified"]
LISTING_ATTRS = ["room_type", "property_type", "property_type_bucket", "accommodates",
                 "bedrooms", "beds", "bathroom_count", "bathroom_is_shared", "latitude",
                 "longitude", "instant_bookable", "is_de_facto_inactive"]
SNAPSHOT_MEASURES = ["price_numeric", "currency_code", "availability_365", "number_of_reviews",
                     "review_scores_rating", "has_availability", "is_active_supply",
                     "is_professional_host", "host_tenure_years", "price_per_bedroom_gbp",
                     "reviews_per_month_calc", "revenue_proxy_gbp", "occupancy_proxy",
                     "availability_rate"]


def first_present(value: str, order: str = "id") -> Column:
    """Deterministic ANY_VALUE: the value at the smallest ``order`` among non-null values."""
    v = F.col(value)
    return F.min_by(v, F.when(v.isNotNull(), F.col(order)))


def dim_city(spark: SparkSession, cities: DataFrame, code: str = "city_code",
             name: str = "city_name") -> DataFrame:
    """One row per city with a dense surrogate key (cities: a small config table)."""
    idx = ordered_index(cities, [F.col(name)], rn_col="city_key")
    return idx.select(F.col("city_key").cast("int").alias("city_key"), *cities.columns)


def dim_neighbourhood(neigh: DataFrame, city_key: int = 1) -> DataFrame:
    idx = ordered_index(neigh, [F.col("neighbourhood")], rn_col="neighbourhood_key")
    return idx.select(
        F.col("neighbourhood_key").cast("long").alias("neighbourhood_key"),
        F.lit(city_key).alias("city_key"),
        F.col("neighbourhood").alias("neighbourhood_name"),
        "area_km2", "centroid_latitude", "centroid_longitude")


def dim_host(listings: DataFrame) -> DataFrame:
    """AG5: one row per host; partial aggregation per host id, then range-keyed."""
    attrs = [a for a in HOST_ATTRS if a in listings.columns]
    hosts = listings.groupBy(F.col("host_id").alias("source_host_id")).agg(
        *[first_present(a).alias(a) for a in attrs],
        F.max("calculated_host_listings_count").alias("host_portfolio_size"))
    idx = ordered_index(hosts, [F.col("source_host_id")], rn_col="host_key")
    return idx.select(
        F.col("host_key").cast("long").alias("host_key"), "source_host_id", *attrs,
        "host_portfolio_size",
        F.col("host_since").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"))


def dim_listing(listings: DataFrame, dhost: DataFrame, dneigh: DataFrame) -> DataFrame:
    """Listing attributes + host/neighbourhood surrogate keys."""
    h = dhost.select(F.col("source_host_id").alias("__hid"), "host_key")
    n = dneigh.select(F.col("neighbourhood_name").alias("__nn"), "neighbourhood_key")
    j = (listings.join(h, listings.host_id == F.col("__hid"), "left")
         .join(F.broadcast(n), listings.neighbourhood_cleansed == F.col("__nn"), "left"))
    return j.select(F.col("id").alias("listing_key"), F.col("id").alias("source_listing_id"),
                    "host_key", "neighbourhood_key",
                    *[a for a in LISTING_ATTRS if a in listings.columns])


def dim_date(spark: SparkSession, start: _dt.date = _dt.date(2008, 1, 1),
             end: _dt.date = _dt.date(2027, 1, 1), facts: DataFrame | None = None) -> DataFrame:
    """G1 + SC22: one row per day from the earlier of ``start`` and the first day of ``facts``
    (a ``date`` column) to the later of ``end`` and its last day."""
    bounds = spark.range(1).select(F.lit(start).alias("a"), F.lit(end).alias("b"))
    if facts is not None:
        bounds = facts.agg(F.least(F.lit(start), F.min("date")).alias("a"), F.greatest(F.lit(end), F.max("date")).alias("b"))
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("date"))
    dt = F.col("date")
    return days.select(
        S.date_key(dt).alias("date_key"), dt,
        F.year(dt).alias("year"), F.quarter(dt).alias("quarter"), F.month(dt).alias("month"),
        F.dayofmonth(dt).alias("day"), (F.dayofweek(dt) - 1).alias("day_of_week"),
        S.is_weekend(dt).alias("is_weekend"), F.weekofyear(dt).alias("iso_week"),
        F.date_format(dt, "MMMM").alias("month_name"))


def fact_calendar(cal: DataFrame) -> DataFrame:
    return cal.select(
        F.col("listing_id").alias("listing_key"), S.date_key(F.col("date")).alias("date_key"),
        "available", F.when(F.col("available"), 1).otherwise(0).alias("available_int"),
        "minimum_nights", "maximum_nights")


def fact_reviews(rev: DataFrame) -> DataFrame:
    return rev.select(
        F.col("id").alias("review_id"), F.col("listing_id").alias("listing_key"),
        S.date_key(F.col("date")).alias("date_key"), "reviewer_id", "comment_length",
        "comment_is_duplicate")


def fact_listing_snapshot(master: DataFrame, dhost: DataFrame, dneigh: DataFrame,
                          snapshot: _dt.date) -> DataFrame:
    h = dhost.select(F.col("source_host_id").alias("__hid"), "host_key")
    n = dneigh.select(F.col("neighbourhood_name").alias("__nn"), "neighbourhood_key")
    j = (master.join(h, master.host_id == F.col("__hid"), "left")
         .join(F.broadcast(n), master.neighbourhood_cleansed == F.col("__nn"), "left"))
    return j.select(F.col("id").alias("listing_key"),
                    F.lit(int(snapshot.strftime("%Y%m%d"))).alias("snapshot_date_key"),
                    "neighbourhood_key", "host_key",
                    *[m for m in SNAPSHOT_MEASURES if m in master.columns])
