"""Feature tables (M1, M2, AG37-AG39, SC24-SC30)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions import scalars as S
from staylens.operators.ordered import null_safe_join, with_quantiles

# Amenity keyword -> flag column (substring match on lower-cased items).
AMENITY_FLAGS = [
    ("wifi", "has_wifi"), ("kitchen", "has_kitchen"), ("air conditioning", "has_air_conditioning"),
    ("washer", "has_washer"), ("parking", "has_parking"), ("pool", "has_pool"),
    ("dedicated workspace", "has_workspace"), ("gym", "has_gym"), ("elevator", "has_elevator"),
    ("tv", "has_tv"), ("bathtub", "has_bathtub"), ("dishwasher", "has_dishwasher"),
]
NUMERIC_FEATURES = ["accommodates", "bedrooms", "beds", "bathroom_count", "minimum_nights",
                    "host_tenure_years", "host_response_rate", "latitude", "longitude",
                    "availability_365", "review_scores_rating", "review_scores_cleanliness",
                    "review_scores_location", "reviews_per_month_calc",
                    "calculated_host_listings_count", "number_of_reviews"]
CATEGORICAL_FEATURES = ["room_type", "neighbourhood_cleansed", "property_type_bucket"]
BINARY_FEATURES = ["host_is_superhost", "instant_bookable", "bathroom_is_shared"]
HOST_FEATURES = ["listing_count", "host_tenure_years", "host_response_rate", "host_acceptance_rate",
                 "host_is_superhost", "avg_price", "avg_availability_365", "avg_review_scores_rating",
                 "avg_reviews_per_month", "avg_accommodates", "avg_minimum_nights", "pct_entire_home",
                 "neighbourhood_count"]
# Inputs of the segmentations, and those taken as log1p.
CLUSTER_FEATURES = ["log_price", "accommodates", "bedrooms", "minimum_nights", "availability_365",
                    "review_scores_rating", "reviews_per_month_calc", "distance_to_centre_km",
                    "amenity_count"]
CLUSTER_LOG = ["minimum_nights", "bedrooms", "reviews_per_month_calc"]
HOST_LOG = ["listing_count", "avg_price", "avg_minimum_nights"]


def listing_features(master: DataFrame) -> DataFrame:
    """M1: model-ready listing features (positive price only, log target)."""
    # a column of its own, so that a listing's text is parsed once and not for each flag
    df = master.where(F.col("price_numeric").isNotNull() & (F.col("price_numeric") > 0)).withColumn(
        "__amenities", S.json_string_list(F.col("amenities")))
    am = F.col("__amenities")
    flags = [S.any_contains(am, kw).alias(name) for kw, name in AMENITY_FLAGS]
    binaries = [S.coerce_binary(F.col(c)).alias(c) for c in BINARY_FEATURES if c in df.columns]
    return df.select(
        "id", "host_id", *[c for c in NUMERIC_FEATURES if c in df.columns],
        S.safe_ratio(F.col("beds"), F.col("accommodates")).alias("beds_per_guest"),
        *binaries, *[c for c in CATEGORICAL_FEATURES if c in df.columns], *flags,
        F.size(am).alias("amenity_count"),
        F.log1p("price_numeric").alias("log_price"), "price_numeric")


def column_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the exact median of each column as ``__m_<column>``."""
    one = df.sparkSession.range(1).select(F.lit(1).alias("__k"))
    return with_quantiles(one, df.select(F.lit(1).alias("__k"), *cols), ["__k"],
                          {f"__m_{c}": (c, 0.5) for c in cols}).drop("__k")


def median_impute(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG38: fill nulls with each column's exact median (all columns in one ordered pass)."""
    j = null_safe_join(df, column_medians(df, cols), [])
    return j.select(*[F.coalesce(F.col(c), F.col(f"__m_{c}")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def _exact_mean(c: str, scale: int = 2):
    """Mean of a fixed-decimals column from an exact decimal sum (order-independent)."""
    return F.sum(F.col(c).cast(f"decimal(28,{scale})")).cast("double") / F.count(c)


def host_features(master: DataFrame, impute: bool = True) -> DataFrame:
    """AG37: 13 features per host (host-level values from the lowest listing id)."""
    sh = F.when(F.col("host_is_superhost"), 1.0).when(~F.col("host_is_superhost"), 0.0)

    def first(c):
        return F.min_by(c, F.when(c.isNotNull(), F.col("id")))

    agg = master.groupBy("host_id").agg(
        F.count(F.lit(1)).alias("listing_count"),
        first(F.col("host_tenure_years")).alias("host_tenure_years"),
        first(F.col("host_response_rate")).alias("host_response_rate"),
        first(F.col("host_acceptance_rate")).alias("host_acceptance_rate"),
        first(sh).alias("host_is_superhost"),
        _exact_mean("price_numeric").alias("avg_price"),
        F.avg("availability_365").alias("avg_availability_365"),
        _exact_mean("review_scores_rating").alias("avg_review_scores_rating"),
        F.avg("reviews_per_month_calc").alias("avg_reviews_per_month"),
        F.avg("accommodates").alias("avg_accommodates"),
        F.avg("minimum_nights").alias("avg_minimum_nights"),
        F.round(F.avg(F.when(F.col("room_type") == "entire_home", 1.0).otherwise(0.0)) * 100, 2)
        .alias("pct_entire_home"),
        F.count_distinct("neighbourhood_cleansed").alias("neighbourhood_count"))
    agg = agg.select("host_id", *[F.col(c).cast("double").alias(c) for c in HOST_FEATURES])
    return median_impute(agg, HOST_FEATURES) if impute else agg


def clustering_features(master: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """M2: the nine clustering features of priced listings, median-imputed; the price stays."""
    priced = master.where(F.col("price_numeric").isNotNull() & (F.col("price_numeric") > 0))
    return median_impute(clustering_inputs(priced, centre), CLUSTER_FEATURES)


def clustering_inputs(listings: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """The nine features before imputing; an input that is not there is null."""
    distance = F.round(S.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(centre[0]), F.lit(centre[1])), 3)
    price = F.col("price_numeric")
    derived = {"log_price": F.when(price > 0, F.log1p(price)), "distance_to_centre_km": distance,
               "amenity_count": F.size(S.json_string_list(F.col("amenities")))}
    return listings.select("id", "room_type", "neighbourhood_cleansed", price.cast("double").alias("price_numeric"),
                           *[derived.get(c, F.col(c)).cast("double").alias(c) for c in CLUSTER_FEATURES])
