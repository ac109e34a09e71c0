"""Row cleaning and quarantine (PF1-PF9, W4).

Each cleaner builds ONE flagged plan; ``clean`` and ``rejected`` are two
filters over it, so clean + rejected = input by construction. Pipelines that
materialise both should persist/write the flagged plan once (see
``staylens.plans.pipeline``).

Duplicate detection (keep=False semantics: every copy of a repeated key is
flagged, null keys are equal to each other) is ``repeats.flag_repeats``: one scan and one
exchange for each key, whatever share of the rows a key holds. Listings are wide and keyed by
their id, so ``repeats.flag_listed_repeats`` deals the ids alone.
"""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import scalars as S
from staylens.operators.repeats import flag_listed_repeats, flag_repeats

# Columns dropped / typed by the listings cleaner.
LISTING_DROP_COLUMNS = ["listing_url", "scrape_id", "picture_url", "host_url",
                        "host_thumbnail_url", "host_picture_url", "calendar_updated",
                        "neighbourhood", "neighbourhood_group_cleansed", "license",
                        "bathrooms"]
LISTING_DATE_COLUMNS = ["last_scraped", "host_since", "calendar_last_scraped",
                        "first_review", "last_review"]
LISTING_BOOL_COLUMNS = ["host_is_superhost", "host_has_profile_pic", "host_identity_verified",
                        "has_availability", "instant_bookable"]
LISTING_PERCENT_COLUMNS = ["host_response_rate", "host_acceptance_rate"]
LISTING_SENTINEL_COLUMNS = ["minimum_nights", "maximum_nights", "minimum_minimum_nights",
                            "maximum_minimum_nights", "minimum_maximum_nights",
                            "maximum_maximum_nights"]
LISTING_TRIM_COLUMNS = ["name", "description", "neighborhood_overview", "host_name",
                        "host_location", "host_about", "host_neighbourhood",
                        "neighbourhood_cleansed"]
# Typed on read (the reference infers these from the CSV).
LISTING_LONG_COLUMNS = ["id", "host_id", "accommodates", "availability_30", "availability_60",
                        "availability_90", "availability_365", "number_of_reviews",
                        "number_of_reviews_ltm", "calculated_host_listings_count"]
LISTING_DOUBLE_COLUMNS = ["latitude", "longitude", "bedrooms", "beds", "review_scores_rating",
                          "review_scores_accuracy", "review_scores_cleanliness",
                          "review_scores_checkin", "review_scores_communication",
                          "review_scores_location", "review_scores_value", "reviews_per_month"]
LISTING_REJECTION_RULES = ["negative_price", "invalid_latitude", "invalid_longitude",
                           "missing_listing_id", "duplicate_listing_key"]
CALENDAR_REJECTION = "invalid_or_duplicate_calendar_key"
REVIEW_REJECTION = "missing_or_duplicate_review_key"


class Quarantined(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    flagged: DataFrame


def _split(flagged: DataFrame, reason_col: str = "rejection_reason") -> Quarantined:
    clean = flagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = flagged.where(F.col(reason_col).isNotNull())
    return Quarantined(clean, rejected, flagged)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF1: drop, tolerant of absent columns."""
    return df.drop(*[c for c in cols if c in df.columns])


def snake_case_columns(df: DataFrame) -> DataFrame:
    """PF2: rename every column to snake_case (names only, no data moved)."""
    return df.toDF(*[S.snake_case(c) for c in df.columns])


def clean_listings_flagged(raw: DataFrame, currency_code: str = "GBP") -> DataFrame:
    """Typed listings + ``rejection_reason`` (null when the row is clean)."""
    df = drop_columns(raw, LISTING_DROP_COLUMNS)
    cols = df.columns
    out: dict[str, Column] = {}
    for c in cols:
        col = F.col(c)
        if c == "price":
            continue
        if c in LISTING_LONG_COLUMNS:
            col = col.cast("string").try_cast("long")
        elif c in LISTING_DOUBLE_COLUMNS:
            col = S.nan_to_null(col.cast("string").try_cast("double"))
        elif c in LISTING_DATE_COLUMNS:
            col = S.parse_date(col)
        elif c in LISTING_BOOL_COLUMNS:
            col = S.parse_bool(col)
        elif c in LISTING_PERCENT_COLUMNS:
            col = S.clean_percentage(col)
        elif c in LISTING_SENTINEL_COLUMNS:
            col = S.cap_sentinel(col)
        elif c == "room_type":
            col = S.normalize_room_type(col)
        elif c in LISTING_TRIM_COLUMNS:
            col = S.trim_keep_null(col)
        out[c] = col.alias(c)
    extra: list[Column] = []
    if "price" in cols:
        extra += [F.col("price").cast("string").alias("price_raw"),
                  S.clean_price("price").alias("price_numeric"),
                  F.lit(currency_code).alias("currency_code")]
    if "property_type" in cols:
        extra.append(S.bucket_property_type("property_type").alias("property_type_bucket"))
    if "bathrooms_text" in cols:
        cnt, shared = S.parse_bathrooms("bathrooms_text")
        extra += [cnt.alias("bathroom_count"), shared.alias("bathroom_is_shared")]
    typed = df.select(*out.values(), *extra)
    derived = []
    if "bedrooms" in cols:
        derived.append(F.col("bedrooms").isNull().alias("bedrooms_is_missing"))
    if "minimum_nights" in cols:
        derived.append(F.coalesce(F.col("minimum_nights") >= S.INACTIVE_MIN_NIGHTS,
                                  F.lit(False)).alias("is_de_facto_inactive"))
    typed = typed.select("*", *derived)
    if "id" in cols:
        typed = flag_listed_repeats(typed, ["id"], "__dup_id")
    rules = []
    if "price" in cols:
        rules.append(("negative_price", F.coalesce(F.col("price_numeric") < 0, F.lit(False))))
    if "latitude" in cols:
        rules.append(("invalid_latitude",
                      F.coalesce(~F.col("latitude").between(-90, 90), F.lit(True))))
    if "longitude" in cols:
        rules.append(("invalid_longitude",
                      F.coalesce(~F.col("longitude").between(-180, 180), F.lit(True))))
    if "id" in cols:
        rules.append(("missing_listing_id", F.col("id").isNull()))
        rules.append(("duplicate_listing_key", F.col("__dup_id")))
    reason = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules])
    flagged = typed.withColumn("rejection_reason", F.when(reason != "", reason))
    return flagged.drop("__dup_id")


def clean_listings(raw: DataFrame, currency_code: str = "GBP") -> Quarantined:
    """PF7: listings -> (clean, rejected with comma-joined reasons)."""
    return _split(clean_listings_flagged(raw, currency_code))


def clean_calendar(raw: DataFrame) -> Quarantined:
    """PF8: calendar -> (clean, rejected); key (listing_id, date)."""
    typed = raw.select(
        F.col("listing_id").cast("string").try_cast("long").alias("listing_id"),
        S.parse_date("date").alias("date"),
        S.parse_bool("available").alias("available"),
        S.cap_sentinel("minimum_nights").alias("minimum_nights"),
        S.cap_sentinel("maximum_nights").alias("maximum_nights"))
    typed = flag_repeats(typed, ["listing_id", "date"], "__dup")
    bad = (F.col("listing_id").isNull() | F.col("date").isNull()
           | F.col("available").isNull() | F.col("__dup"))
    flagged = typed.withColumn("rejection_reason", F.when(bad, F.lit(CALENDAR_REJECTION))).drop("__dup")
    return _split(flagged)


def clean_reviews(raw: DataFrame) -> Quarantined:
    """PF9 + SC10 + duplicate-comment flag (computed before quarantine)."""
    comments = F.trim(F.coalesce(F.col("comments").cast("string"), F.lit("")))
    typed = raw.select(
        F.col("listing_id").cast("string").try_cast("long").alias("listing_id"),
        F.col("id").cast("string").try_cast("long").alias("id"),
        S.parse_date("date").alias("date"),
        F.col("reviewer_id").cast("string").try_cast("long").alias("reviewer_id"),
        S.trim_keep_null("reviewer_name").alias("reviewer_name"),
        comments.alias("comments"))
    typed = typed.withColumn("comment_length", F.length("comments").cast("long"))
    typed = flag_repeats(typed, ["comments"], "comment_is_duplicate")
    typed = flag_repeats(typed, ["id"], "__dup_id")
    bad = (F.col("id").isNull() | F.col("listing_id").isNull() | F.col("date").isNull()
           | F.col("__dup_id"))
    flagged = typed.withColumn("rejection_reason", F.when(bad, F.lit(REVIEW_REJECTION))).drop("__dup_id")
    return _split(flagged)


def clean_neighbourhoods(raw_csv: DataFrame, geo: DataFrame) -> DataFrame:
    """Neighbourhood CSV (trimmed names) left-joined to geometry metrics.

    ``geo`` must carry neighbourhood, centroid_latitude, centroid_longitude,
    area_km2 (see ``staylens.operators.geo.polygon_metrics``).
    """
    csv = drop_columns(raw_csv, ["neighbourhood_group"]).select(
        F.trim(F.col("neighbourhood")).alias("neighbourhood"))
    g = geo.select(F.trim(F.col("neighbourhood")).alias("neighbourhood"),
                   "centroid_latitude", "centroid_longitude", "area_km2")
    return csv.join(g, "neighbourhood", "left")
