"""Bind the rental data model to the driver's TPC-H-like tables.

The driver ships no rental data, so raw rental tables (all strings, exactly as a
CSV scan would give them) are *derived* from its tables. The derivations are
deterministic column expressions, so every downstream operator runs on data
that grows with the given tables:

    listing  <- orders (+ customer, nation, region; per-customer order stats)
    host     <- customer (first order date = host_since)
    calendar <- lineitem (listing = order, day = ship date, available = 'O')
    review   <- events   (listing = user_id, day = event date)
    neighbourhood <- nation (box geometry), city <- region

Dimension tables nation (25 rows) and region (5 rows) are fixed-size by the
TPC-H specification, so they are broadcast explicitly; every other join is
left to AQE, which broadcasts only after measuring the side at runtime.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.sources.tables import table

# Fixed snapshot date of the bound data ("scrape date").
SNAPSHOT = _dt.date(2024, 2, 15)
# Date dimension range for the bound data (ship dates start in the 1990s).
DIM_DATE_START = _dt.date(1992, 1, 1)
DIM_DATE_END = _dt.date(2027, 1, 1)
PREVIOUS_SNAPSHOT = _dt.date(2023, 11, 15)


def _s(c):
    return c.cast("string")


def _money(c):
    return F.format_string("$%,.2f", c)


def host_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-customer first order date and order count (partial+final hash agg)."""
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
    return o.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order_ts"),
        F.count(F.lit(1)).alias("host_orders"))


def geo_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region (bounded dims) with the neighbourhood box corners."""
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nk = F.col("n_nationkey")
    return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
            .select("n_nationkey", "n_name", "r_name",
                    (F.lit(51.28) + (nk % 5) * F.lit(0.08)).alias("lat0"),
                    (F.lit(-0.5) + F.floor(nk / 5) * F.lit(0.12)).alias("lon0")))


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings snapshot: one string row per order."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_totalprice", "o_orderpriority")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
              "c_mktsegment")
    g = geo_frame(spark, sf_dir)
    h = host_stats(spark, sf_dir)
    df = (o.join(h, "o_custkey", "left")
          .join(c, o.o_custkey == c.c_custkey, "left")
          .join(F.broadcast(g), F.col("c_nationkey") == g.n_nationkey, "left"))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    price = _money(F.col("o_totalprice"))
    return df.select(
        _s(k).alias("id"),
        F.concat(F.lit("https://rooms.invalid/"), _s(k)).alias("listing_url"),
        F.lit("20240215").alias("scrape_id"),
        F.concat(F.lit("Stay "), _s(k), F.lit(" "), F.lower("c_mktsegment")).alias("name"),
        _s(ck).alias("host_id"),
        F.col("c_name").alias("host_name"),
        F.date_format("first_order_ts", "yyyy-MM-dd").alias("host_since"),
        F.when(ck % 4 == 0, "within an hour").when(ck % 4 == 1, "within a few hours")
         .when(ck % 4 == 2, "within a day").alias("host_response_time"),
        F.concat(_s(ck % 101), F.lit("%")).alias("host_response_rate"),
        F.when(ck % 10 != 0, F.concat(_s(ck % 91 + 10), F.lit("%"))).alias("host_acceptance_rate"),
        F.when(F.col("o_orderstatus") == "F", "t").when(F.col("o_orderstatus") == "O", "f")
         .alias("host_is_superhost"),
        F.when(ck % 3 == 0, "f").otherwise("t").alias("host_identity_verified"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("neighbourhood_cleansed"),
        F.col("r_name").alias("city"),
        F.when(k % 211 == 0, "95.0").when(k % 223 == 0, F.lit(None).cast("string"))
         .otherwise(F.format_string("%.6f", F.col("lat0") + (k % 800) * F.lit(0.0001)))
         .alias("latitude"),
        F.when(k % 227 == 0, "-190.5")
         .otherwise(F.format_string("%.6f", F.col("lon0") + (k % 1200) * F.lit(0.0001)))
         .alias("longitude"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Camper/RV")
         .when(F.col("c_mktsegment") == "BUILDING", "Entire rental unit")
         .when(F.col("c_mktsegment") == "FURNITURE", "Private room in townhouse")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "Entire home")
         .when(F.col("c_mktsegment").isNotNull(), "Room in boutique hotel")
         .alias("property_type"),
        F.when(k % 101 == 0, "Submarine")
         .when(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"), "Entire home/apt")
         .when(F.col("o_orderpriority") == "2-HIGH", "Private room")
         .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Shared room")
         .otherwise("Hotel room").alias("room_type"),
        _s(k % 6 + 2).alias("accommodates"),
        F.lit(None).cast("string").alias("bathrooms"),
        F.when(k % 6 == 0, "1 bath").when(k % 6 == 1, "1.5 shared baths")
         .when(k % 6 == 2, "Half-bath").when(k % 6 == 3, "2 private baths")
         .when(k % 6 == 5, "Shared half-bath").alias("bathrooms_text"),
        F.when(k % 9 != 0, _s(k % 5)).alias("bedrooms"),
        _s(k % 4 + 1).alias("beds"),
        F.when(k % 4 == 0, '["Wifi", "Kitchen", "Washer"]')
         .when(k % 4 == 1, '["Wifi", "Free parking on premises", "Air conditioning", "Pool"]')
         .when(k % 4 == 2, "not json").otherwise("[]").alias("amenities"),
        F.when(k % 50 == 0, F.lit(None).cast("string"))
         .when(k % 97 == 0, F.concat(F.lit("-"), price)).otherwise(price).alias("price"),
        _s(k % 400 + 1).alias("minimum_nights"),
        F.when(k % 13 == 0, "2147483647").otherwise(_s(k % 700 + 365)).alias("maximum_nights"),
        F.when((F.col("o_orderstatus") == "P") & (k % 4 == 0), "f").otherwise("t")
         .alias("has_availability"),
        _s((k * 7) % 366).alias("availability_365"),
        _s(k % 120).alias("number_of_reviews"),
        F.lit(SNAPSHOT.isoformat()).alias("last_scraped"),
        F.when(k % 8 != 0, F.format_string("%.2f", F.lit(3.0) + (k % 201) / F.lit(100.0)))
         .alias("review_scores_rating"),
        F.when(k % 10 != 0, F.format_string("%.1f", F.lit(2.0) + (k % 31) / F.lit(10.0)))
         .alias("review_scores_cleanliness"),
        F.format_string("%.1f", F.lit(3.0) + (ck % 21) / F.lit(10.0)).alias("review_scores_location"),
        F.concat(F.lit("LIC-"), _s(k)).alias("license"),
        F.when(k % 2 == 0, "t").otherwise("f").alias("instant_bookable"),
        _s(F.col("host_orders")).alias("calculated_host_listings_count"),
    )


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw calendar: one string row per line item (listing-day)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("long")
    return li.select(
        _s(k).alias("listing_id"),
        F.when((ln == 7) & (k % 5 == 0), "not-a-date")
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date"),
        F.when((F.col("l_returnflag") == "N") & (ln == 6) & (k % 3 == 0), "maybe")
         .when(F.col("l_linestatus") == "O", "t").when(F.col("l_linestatus") == "F", "f")
         .alias("available"),
        _money(F.col("l_extendedprice")).alias("price"),
        _money(F.col("l_extendedprice")).alias("adjusted_price"),
        _s(qty).alias("minimum_nights"),
        F.when(ln == 1, "2147483647").otherwise(_s(qty * 30)).alias("maximum_nights"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reviews: one string row per event."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    i = F.col("event_id")
    return e.select(
        _s(F.col("user_id")).alias("listing_id"),
        F.when(i % 500 == 0, F.lit(None).cast("string"))
         .when(i % 777 == 1, _s(i - 1)).otherwise(_s(i)).alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.get_json_object("props", "$.k").alias("reviewer_id"),
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("reviewer_name"),
        F.when(i % 333 == 0, F.lit(None).cast("string"))
         .when(F.col("value") >= 50, F.concat(F.col("event_type"), F.lit(" stay "), _s(i)))
         .otherwise(F.concat(F.lit("  "), F.col("event_type"), F.lit(" stay"))).alias("comments"),
    )


def neighbourhood_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON-shaped features: properties + MultiPolygon coordinates.

    Each neighbourhood is a lat/lon box 0.08 deg x 0.12 deg (closed ring,
    [lon, lat] order as in GeoJSON).
    """
    g = geo_frame(spark, sf_dir)
    lat0, lon0 = F.col("lat0"), F.col("lon0")
    lat1, lon1 = lat0 + F.lit(0.08), lon0 + F.lit(0.12)
    ring = F.array(F.array(lon0, lat0), F.array(lon1, lat0), F.array(lon1, lat1),
                   F.array(lon0, lat1), F.array(lon0, lat0))
    return g.select(
        F.col("n_name").alias("neighbourhood"),
        F.col("r_name").alias("neighbourhood_group"),
        F.lit("MultiPolygon").alias("geometry_type"),
        F.array(F.array(ring)).alias("coordinates"))


def raw_neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbourhoods CSV: group + name (with stray spaces)."""
    g = geo_frame(spark, sf_dir)
    return g.select(F.col("r_name").alias("neighbourhood_group"),
                    F.concat(F.col("n_name"), F.lit(" ")).alias("neighbourhood"))
