"""Registered queries: sink and source round trips, host comparison, quantile classes, ranked
errors per city, feature statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from staylens.functions import bands as Bd
from staylens.operators import changes as CH
from staylens.operators import eda as EDA
from staylens.operators import features as FE
from staylens.operators import geo as GEO
from staylens.operators import models as MO
from staylens.operators.ordered import exact_quantiles, null_safe_join, with_quantiles
from staylens.plans import bindings as B
from staylens.plans.catalog import _lm, _q, _split, query, snapshots
from staylens.plans.pipeline import shared
from staylens.session import scratch_path
from staylens.sources import files as FI

# ------------------------------------------------------------ round trips (IO1, IO2, IO6-IO8, CD5, CD7)
_CSV = ["id", "name", "price", "host_is_superhost", "room_type"]


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("io_csv_roundtrip")
def _(spark, sf):
    """IO7 then IO1 + IO2: gzip CSV with line breaks and quotes inside fields, read as text."""
    raw = B.raw_listings(spark, sf)
    out = raw.select("id", F.concat(F.lit('a "name",\n'), F.col("id")).alias("name"), *_CSV[2:], "amenities")
    path = _folder(spark, "csv")
    out.write.option("header", True).option("quote", '"').option("escape", '"').option("compression", "gzip").csv(path)
    return FI.read_raw_csv(spark, path, columns=out.columns, use_columns=_CSV)


@query("io_json_roundtrip")
def _(spark, sf):
    """IO8: JSON lines, read with the table's own schema."""
    cs = shared(spark, sf).calendar_summary.select("listing_id", "calendar_days", "available_days")
    path = _folder(spark, "json")
    cs.write.json(path)
    return spark.read.schema(cs.schema).json(path)


@query("io_partitioned_replace")
def _(spark, sf):
    """IO6 + CD5: the listings by room type, one type replaced by an emptier version; the other
    folders stay as they are."""
    listings = shared(spark, sf).listings.select("id", "room_type", "price_numeric").where(F.col("room_type").isNotNull())
    path = _folder(spark, "partitioned")
    CH.persist_replace(listings, path, ["room_type"])
    CH.persist_replace(listings.where("room_type = 'entire_home' AND price_numeric IS NOT NULL"), path, ["room_type"])
    back = spark.read.schema("id long, price_numeric double, room_type string").parquet(path)
    return back.groupBy("room_type").agg(F.count(F.lit(1)).alias("listings"), F.count("price_numeric").alias("priced"))


@query("snapshot_archive")
def _(spark, sf):
    """CD7: the snapshots there are, per city."""
    old, new = snapshots(spark, sf)
    both = old.select("snapshot_date").unionByName(new.select("snapshot_date")).withColumn("city", F.lit("bound"))
    return CH.archive_listing(both)


@query("listings_valid_coordinates")
def _(spark, sf):
    """PF22 over the raw coordinates, out-of-range ones included."""
    raw = B.raw_listings(spark, sf)
    number = lambda c: F.col(c).try_cast("double").alias(c)
    return GEO.valid_coordinates(raw.select(F.col("id").cast("long").alias("id"), number("latitude"), number("longitude"))).select("id")


# ------------------------------------------------------------ summaries (AG16, SC32, W8, W9, J15, AG39)
@_q("eda_host_segment_comparison")
def _(spark, sf):
    """AG16 + SC32: four host bands with reviews per month."""
    lm = _lm(spark, sf).withColumn("segment", Bd.band(F.col("host_portfolio_size"), Bd.HOST_SEGMENT_BANDS_4))
    agg = lm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("listing_count"), F.count_distinct("host_id").alias("unique_hosts"),
        F.avg(F.col("host_is_superhost").cast("double")).alias("superhost_rate"))
    return with_quantiles(agg, lm, ["segment"], {f"median_{n}": (c, 0.5) for n, c in (
        ("price", "price_numeric"), ("rating", "review_scores_rating"), ("reviews_per_month", "reviews_per_month_calc"),
        ("availability", "availability_365"), ("occupancy", "occupancy_proxy"))})


@_q("eda_rating_classes")
def _(spark, sf):
    """Neighbourhoods by median rating (20 ratings at least), in classes cut at the 33 % and
    67 % quantiles of the medians."""
    med = EDA.masked_group_median(_lm(spark, sf), "neighbourhood_cleansed", "review_scores_rating", 20).where(
        F.col("median_masked").isNotNull()).withColumn("__k", F.lit(1))
    cuts = exact_quantiles(med, ["__k"], {"low": ("median_masked", 0.33), "high": ("median_masked", 0.67)})
    m = F.col("median_masked")
    return null_safe_join(med, cuts, ["__k"]).select(
        "neighbourhood_cleansed", "n", m.alias("median_rating"),
        F.when(m >= F.col("high"), "upper").when(m >= F.col("low"), "middle").otherwise("lower").alias("rating_class"))


@_q("model_city_error_rank")
def _(spark, sf):
    """J15 + W8: error of the room-type medians per city, joined to the city's listings and
    ranked; equal errors share a rank."""
    train, test = _split(spark, sf)
    cities = shared(spark, sf).listings.select("id", "city")
    medians = exact_quantiles(train, ["room_type"], {"predicted_price": ("price_numeric", 0.5)})
    scored = test.join(medians, "room_type").join(cities, "id")
    errors = scored.groupBy("city").agg(F.avg(F.abs(F.col("predicted_price") - F.col("price_numeric"))).alias("mae"),
                                        F.count(F.lit(1)).alias("n_test"))
    counts = cities.groupBy("city").agg(F.count(F.lit(1)).alias("listings"))
    # a window over one row per city
    return errors.join(counts, "city").withColumn("mae_rank", F.rank().over(Window.orderBy(F.round("mae", 6))))


@_q("features_numeric_statistics")
def _(spark, sf):
    """AG39: statistics of the model features."""
    features = FE.listing_features(shared(spark, sf).master)
    cols = [c for c in (*FE.NUMERIC_FEATURES, "beds_per_guest", "amenity_count", "log_price") if c in features.columns]
    return EDA.numeric_summary(features, cols).select("column", "count", "missing_count", "p25", "p50", "p75", "max")
