"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query runs the library's operators over the bound driver tables (whole
tables, no subsets). ``staylens.plans.oracle_queries`` holds the matching DuckDB
SQL for the ones that are SQL-expressible.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators.bootstrap import bootstrap_mean_diff
from staylens.operators.ordered import with_quantiles
from staylens.plans.pipeline import LISTINGS_ONLY, MASTER_NEEDS, WAREHOUSE_NEEDS, Pipeline, shared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c: str, n: int = 6):
    return F.round(F.col(c), n).alias(c)


def rounded(df: DataFrame, cols: list[str], n: int = 6) -> DataFrame:
    return df.select(*[r6(c, n) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------ clean + quarantine
@query("clean_listings")
def q_clean_listings(spark, sf):
    return shared(spark, sf).listings


@query("rejected_listings")
def q_rejected_listings(spark, sf):
    return shared(spark, sf).listings_q.rejected.select(
        "id", "latitude", "longitude", "price_numeric", "rejection_reason")


@query("clean_calendar")
def q_clean_calendar(spark, sf):
    return shared(spark, sf).calendar


@query("rejected_calendar")
def q_rejected_calendar(spark, sf):
    return shared(spark, sf).calendar_q.rejected


@query("clean_reviews")
def q_clean_reviews(spark, sf):
    return shared(spark, sf).reviews


@query("rejected_reviews")
def q_rejected_reviews(spark, sf):
    return shared(spark, sf).reviews_q.rejected


@query("neighbourhoods_clean")
def q_neighbourhoods(spark, sf):
    return rounded(shared(spark, sf).neighbourhoods,
                   ["centroid_latitude", "centroid_longitude", "area_km2"], 6)


# ------------------------------------------------------------ summaries
@query("calendar_summary")
def q_calendar_summary(spark, sf):
    return rounded(shared(spark, sf).calendar_summary,
                   ["availability_rate", "occupancy_proxy", "avg_minimum_nights",
                    "avg_maximum_nights"])


@query("review_summary")
def q_review_summary(spark, sf):
    return rounded(shared(spark, sf).review_summary, ["avg_comment_length"])


@query("neighbourhood_summary")
def q_neighbourhood_summary(spark, sf):
    df = rounded(shared(spark, sf).neighbourhood_summary,
                 ["price_null_share", "entire_home_share", "superhost_share",
                  "avg_review_score", "avg_availability_365", "area_km2", "listings_per_km2"], 4)
    return rounded(df, ["median_price_gbp", "mean_price_gbp"], 2)


MASTER_COLS = ["id", "review_count_calc", "first_review_calc", "last_review_calc",
               "unique_reviewer_count", "review_count_l12m", "review_count_l30d",
               "avg_comment_length", "duplicate_comment_count", "calendar_days",
               "available_days", "unavailable_days", "availability_rate", "occupancy_proxy",
               "weekend_available_days", "weekday_available_days",
               "neighbourhood_listing_count", "neighbourhood_median_price_gbp",
               "neighbourhood_density_per_km2", "host_tenure_years", "price_per_bedroom_gbp",
               "reviews_per_month_calc", "host_portfolio_size", "is_professional_host",
               "revenue_proxy_gbp", "is_active_supply"]
MASTER_DOUBLES = ["avg_comment_length", "availability_rate", "occupancy_proxy",
                  "neighbourhood_median_price_gbp", "neighbourhood_density_per_km2",
                  "host_tenure_years", "price_per_bedroom_gbp", "reviews_per_month_calc",
                  "revenue_proxy_gbp"]


@query("listing_master")
def q_listing_master(spark, sf):
    return rounded(shared(spark, sf).master.select(*MASTER_COLS), MASTER_DOUBLES, 4)


@query("listing_master_totals")
def q_master_totals(spark, sf):
    from staylens.operators.summaries import master_totals
    return rounded(master_totals(shared(spark, sf).master),
                   ["median_price_gbp", "total_revenue_proxy_gbp", "median_occupancy_proxy"], 2)


# ------------------------------------------------------------ warehouse
@query("dim_city")
def q_dim_city(spark, sf):
    return shared(spark, sf).dim_city


@query("dim_neighbourhood")
def q_dim_neighbourhood(spark, sf):
    return rounded(shared(spark, sf).dim_neighbourhood,
                   ["area_km2", "centroid_latitude", "centroid_longitude"], 6)


@query("dim_host")
def q_dim_host(spark, sf):
    return shared(spark, sf).dim_host


@query("dim_listing")
def q_dim_listing(spark, sf):
    return shared(spark, sf).dim_listing


@query("dim_date")
def q_dim_date(spark, sf):
    return shared(spark, sf).dim_date


@query("fact_calendar")
def q_fact_calendar(spark, sf):
    return shared(spark, sf).fact_calendar


@query("fact_reviews")
def q_fact_reviews(spark, sf):
    return shared(spark, sf).fact_reviews


@query("fact_listing_snapshot")
def q_fact_listing_snapshot(spark, sf):
    return rounded(shared(spark, sf).fact_listing_snapshot,
                   ["host_tenure_years", "price_per_bedroom_gbp", "reviews_per_month_calc",
                    "revenue_proxy_gbp", "occupancy_proxy", "availability_rate"], 4)


#: Reports that keep narrow listings alone: no other table is read twice for them.
NARROW_REPORTS = {"median_price_by_room_type": (WAREHOUSE_NEEDS, LISTINGS_ONLY)}
for _rep in ["median_price_by_room_type", "top_neighbourhoods_by_listing_count",
             "weekend_vs_weekday_availability", "occupancy_proxy_distribution",
             "superhost_price_rating_gap"]:
    QUERIES[f"report_{_rep}"] = (lambda name: lambda spark, sf:
                                 shared(spark, sf, *NARROW_REPORTS.get(name, ())).report(name))(_rep)


# ------------------------------------------------------------ EDA
from staylens.functions import bands as Bd  # noqa: E402
from staylens.operators import eda as EDA  # noqa: E402

LONDON_CENTRE = (51.5080, -0.1281)
NUMERIC_COLS = ["price_numeric", "availability_365", "number_of_reviews", "review_scores_rating",
                "review_scores_cleanliness", "review_scores_location", "host_tenure_years",
                "occupancy_proxy", "reviews_per_month_calc", "host_portfolio_size",
                "host_response_rate"]
SCORE_COLS = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location",
              "number_of_reviews", "reviews_per_month_calc"]


def _lm(spark, sf):
    return EDA.with_bands(shared(spark, sf).master)


def _eda(spark, sf):
    return EDA.price_eligible(_lm(spark, sf))


def round_doubles(df: DataFrame, n: int = 4) -> DataFrame:
    """Round every double column (stable comparison across engines)."""
    return df.select(*[F.round(F.col(f.name), n).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


def _q(name):
    def deco(fn):
        QUERIES[name] = lambda spark, sf: round_doubles(fn(spark, sf))
        return fn
    return deco


@_q("eda_population_exclusion")
def _(spark, sf):
    return EDA.population_exclusion(_lm(spark, sf))


@_q("eda_numeric_summary")
def _(spark, sf):
    return EDA.numeric_summary(_lm(spark, sf), NUMERIC_COLS)


@_q("eda_price_by_room_type")
def _(spark, sf):
    return EDA.price_by_group(_eda(spark, sf), ["room_type"])


@_q("eda_price_ci_by_room_type")
def _(spark, sf):
    return EDA.mean_ci(_eda(spark, sf), ["room_type"])


@_q("eda_price_by_neighbourhood")
def _(spark, sf):
    lm = _lm(spark, sf)
    g = EDA.price_by_group(EDA.price_eligible(lm), ["neighbourhood_cleansed"], probs=())
    return EDA.having_floor(g, lm, "listing_count", 10, 0.001)


@_q("eda_price_by_neighbourhood_room_type")
def _(spark, sf):
    lm = _lm(spark, sf)
    g = EDA.price_by_group(EDA.price_eligible(lm), ["neighbourhood_cleansed", "room_type"], probs=())
    return EDA.having_floor(g, lm, "listing_count", 5, 0.0005)


@_q("eda_price_ci_by_neighbourhood_room_type")
def _(spark, sf):
    return EDA.mean_ci(_eda(spark, sf), ["neighbourhood_cleansed", "room_type"])


@_q("eda_host_segment_summary")
def _(spark, sf):
    return EDA.segment_summary(_lm(spark, sf), "host_segment", Bd.labels(Bd.HOST_SEGMENT_BANDS))


@_q("eda_host_tenure_summary")
def _(spark, sf):
    return EDA.segment_summary(_lm(spark, sf), "tenure_band", Bd.labels(Bd.TENURE_BANDS))


@_q("eda_availability_band_summary")
def _(spark, sf):
    return EDA.availability_band_summary(_lm(spark, sf))


@_q("eda_neighbourhood_density")
def _(spark, sf):
    return EDA.neighbourhood_density(_lm(spark, sf))


@_q("eda_price_by_distance_band")
def _(spark, sf):
    return EDA.price_by_distance(_eda(spark, sf), LONDON_CENTRE)


@_q("eda_room_type_mix")
def _(spark, sf):
    return EDA.room_type_mix(_lm(spark, sf))


@_q("eda_monthly_availability")
def _(spark, sf):
    return EDA.monthly_availability(shared(spark, sf).calendar)


@_q("eda_weekpart_availability")
def _(spark, sf):
    return EDA.weekpart_availability(shared(spark, sf).calendar)


@_q("eda_minimum_nights_monthly")
def _(spark, sf):
    return EDA.minimum_nights_monthly(shared(spark, sf).calendar)


@_q("eda_monthly_review_volume")
def _(spark, sf):
    return EDA.monthly_review_volume(shared(spark, sf).reviews)


@_q("eda_temporal_summary")
def _(spark, sf):
    return EDA.temporal_summary(shared(spark, sf).calendar)


@_q("eda_response_rate_summary")
def _(spark, sf):
    return EDA.response_rate_summary(_lm(spark, sf))


@_q("eda_correlation_matrix")
def _(spark, sf):
    return EDA.correlation_matrix(_lm(spark, sf), ["review_scores_rating", "review_scores_cleanliness",
                                                   "review_scores_location", "price_numeric",
                                                   "availability_365", "number_of_reviews"],
                                  prefix="review_scores_")


@_q("eda_review_score_summary")
def _(spark, sf):
    return EDA.score_summary(_lm(spark, sf), SCORE_COLS)


@_q("eda_market_concentration")
def _(spark, sf):
    return EDA.market_concentration(_lm(spark, sf))


@_q("eda_concentration_thresholds")
def _(spark, sf):
    return EDA.concentration_thresholds(_lm(spark, sf))


@_q("eda_high_review_low_score")
def _(spark, sf):
    return EDA.quantile_filter(_lm(spark, sf)).select(
        "id", "neighbourhood_cleansed", "room_type", "property_type_bucket", "price_numeric",
        "number_of_reviews", "review_scores_rating", "review_scores_cleanliness",
        "host_segment", "host_response_rate")


@_q("eda_price_cap_p99")
def _(spark, sf):
    return EDA.percentile_cap(_eda(spark, sf), "price_numeric", 0.99).select("id", "price_numeric")


@_q("eda_rating_by_neighbourhood_masked")
def _(spark, sf):
    return EDA.masked_group_median(_lm(spark, sf), "neighbourhood_cleansed", "review_scores_rating", 20)


@_q("eda_price_by_property_bucket")
def _(spark, sf):
    return EDA.price_by_group(_eda(spark, sf), ["property_type_bucket"], probs=())


@_q("eda_review_count_buckets")
def _(spark, sf):
    lm = _eda(spark, sf).withColumn(
        "review_bucket", Bd.band(F.col("number_of_reviews"), Bd.REVIEW_COUNT_BUCKETS))
    agg = lm.groupBy("review_bucket").agg(
        F.count(F.lit(1)).alias("listing_count"), F.avg("review_scores_rating").alias("mean_rating"))
    return with_quantiles(agg, lm, ["review_bucket"], {"median_price": ("price_numeric", 0.5)})


@_q("eda_city_comparison")
def _(spark, sf):
    return EDA.city_comparison(_lm(spark, sf))


@_q("eda_room_type_share_by_city")
def _(spark, sf):
    return EDA.room_type_mix(_lm(spark, sf), group="city")


@_q("eda_price_histogram")
def _(spark, sf):
    return EDA.histogram(_eda(spark, sf), "price_numeric", 60)


@_q("eda_price_relative_to_city_median")
def _(spark, sf):
    return EDA.relative_to_group_median(_eda(spark, sf), "city", "price_numeric",
                                        "price_vs_city_median").select("id", "city", "price_vs_city_median")


@_q("eda_top_neighbourhoods_value_counts")
def _(spark, sf):
    return EDA.top_values(_lm(spark, sf), "neighbourhood_cleansed", 5)


# ------------------------------------------------------------ changes (CD*)
import datetime as _dt  # noqa: E402

from staylens.operators import changes as CH  # noqa: E402
from staylens.operators import rulebook as R
from staylens.operators import validation as V  # noqa: E402

OLD_SNAPSHOT = _dt.date(2000, 1, 1)
NEW_SNAPSHOT = _dt.date(2002, 1, 1)


def snapshots(spark, sf):
    """Two snapshots of the bound listings, defined by calendar activity.

    old: listings with a calendar day before 2000-01-01; new: listings with a
    calendar day on/after 1998-01-01, repriced +20 % where availability > 0.6,
    re-typed to hotel_room / inactive where nothing is available.
    """
    p = shared(spark, sf)
    base = p.listing_states
    old = base.where(F.col("first_calendar_date") < F.lit(_dt.date(2000, 1, 1))).select(
        "id", "price_numeric", "room_type", "is_de_facto_inactive",
        F.lit(OLD_SNAPSHOT).alias("snapshot_date"))
    hot = F.col("availability_rate") > 0.6
    idle = F.col("availability_rate") == 0
    new = base.where(F.col("last_calendar_date") >= F.lit(_dt.date(1998, 1, 1))).select(
        "id",
        F.when(hot, F.col("price_numeric") * F.lit(1.2)).otherwise(F.col("price_numeric")).alias("price_numeric"),
        F.when(idle, F.lit("hotel_room")).otherwise(F.col("room_type")).alias("room_type"),
        (F.col("is_de_facto_inactive") | F.coalesce(idle, F.lit(False))).alias("is_de_facto_inactive"),
        F.lit(NEW_SNAPSHOT).alias("snapshot_date"))
    return old, new


@query("snapshot_diff")
def _(spark, sf):
    old, new = snapshots(spark, sf)
    return CH.snapshot_diff(old, new)


@query("snapshot_diff_summary")
def _(spark, sf):
    old, new = snapshots(spark, sf)
    d = CH.snapshot_diff(old, new).select(
        "*", F.lit(OLD_SNAPSHOT).alias("old_snapshot"), F.lit(NEW_SNAPSHOT).alias("new_snapshot"))
    return CH.diff_summary(d, ["old_snapshot", "new_snapshot"])


@query("snapshot_key_sets")
def _(spark, sf):
    old, new = snapshots(spark, sf)
    added, removed, common = CH.key_differences(old, new, "id")
    return (added.select(F.lit("added").alias("key_set"), "id")
            .unionByName(removed.select(F.lit("removed").alias("key_set"), "id"))
            .unionByName(common.select(F.lit("common").alias("key_set"), "id")))


@query("scd2_listing_history")
def _(spark, sf):
    old, new = snapshots(spark, sf)
    return CH.scd2_history(old.unionByName(new), "id", "snapshot_date",
                           ["price_numeric", "room_type", "is_de_facto_inactive"])


@query("dataset_version_upsert")
def _(spark, sf):
    old, new = snapshots(spark, sf)
    p = shared(spark, sf)
    existing = old.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("row_count")) \
        .withColumn("city", F.lit("bound"))
    # re-registering the old snapshot with the clean-listing count replaces its row
    updates = (new.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("row_count"))
               .unionByName(p.listings.agg(F.count(F.lit(1)).alias("row_count"))
                            .withColumn("snapshot_date", F.lit(OLD_SNAPSHOT)))
               .withColumn("city", F.lit("bound")))
    return CH.upsert_by_key(existing, updates, ["city", "snapshot_date"])


# ------------------------------------------------------------ validation (V*)
# Bounds and names of a short suite over the master; all of them are in operators/suites.py
MASTER_SUITE = [
    V.expect("row_count_between", min=1000, max=200000),
    V.expect("column_set", columns=["id", "host_id", "neighbourhood_cleansed", "latitude",
                                    "longitude", "room_type", "accommodates", "availability_365",
                                    "price_numeric", "currency_code", "is_de_facto_inactive",
                                    "is_active_supply"]),
    V.expect("column_exists", "id"),
    V.expect("not_null", "id"),
    V.expect("unique", "id"),
    V.expect("not_null", "host_id"),
    V.expect("not_null", "neighbourhood_cleansed"),
    V.expect("not_null", "latitude"),
    V.expect("between", "latitude", min=-90.0, max=90.0),
    V.expect("not_null", "room_type"),
    V.expect("in_set", "room_type", values=["entire_home", "private_room", "shared_room", "hotel_room"]),
    V.expect("between", "accommodates", min=1, max=100),
    V.expect("between", "minimum_nights", min=1, mostly=0.99),
    V.expect("between", "availability_365", min=0, max=365),
    V.expect("between", "price_numeric", min=0.01, max=50000, mostly=0.99),
    V.expect("between", "review_scores_rating", min=1.0, max=5.0, mostly=0.99),
    V.expect("not_null", "is_de_facto_inactive"),
    V.expect("between", "host_tenure_years", min=0.0, max=25.0, mostly=0.99),
    V.expect("between", "occupancy_proxy", min=0.0, max=1.0),
]


@query("validation_listing_master")
def _(spark, sf):
    res = V.run_expectations(shared(spark, sf).master, "listing_master", MASTER_SUITE)
    return res.withColumn("unexpected_pct", F.round("unexpected_pct", 4))


@query("validation_suite_summary")
def _(spark, sf):
    p = shared(spark, sf)
    cal_suite = [V.expect("not_null", "listing_id"), V.expect("not_null", "date"),
                 V.expect("between", "minimum_nights", min=1, mostly=0.99),
                 V.expect("in_set", "available", values=[True, False])]
    r = V.run_expectations(p.master, "listing_master", MASTER_SUITE).unionByName(
        V.run_expectations(p.calendar, "calendar_clean", cal_suite))
    return V.suite_summary(r)


@query("validation_warehouse_rules")
def _(spark, sf):
    p = shared(spark, sf)
    found = R.figures([
        R.Table("dim_listing", p.dim_listing, {"listing": ["listing_key"]},
                {"no_key": F.col("listing_key").isNull().cast("int")}),
        R.Table("fact_calendar", p.fact_calendar, {"listing": ["listing_key"], "night": ["listing_key", "date_key"]},
                {"available": R.failing(F.col("available_int").isin(0, 1))}),
        R.Table("fact_reviews", p.fact_reviews, {"listing": ["listing_key"]}),
        R.Table("snapshot", p.fact_listing_snapshot, {}, {
            "price": R.failing(F.col("price_numeric") >= 0), "occupancy": R.failing(F.col("occupancy_proxy").between(0, 1))})])
    return R.rule_rows(found, {
        "listing_key_not_null": found.measure("dim_listing", "no_key"),
        "listing_key_unique": found.copies("dim_listing", "listing"),
        "calendar_referential_listing": found.orphans("fact_calendar", "dim_listing", "listing"),
        "reviews_referential_listing": found.orphans("fact_reviews", "dim_listing", "listing"),
        "calendar_available_int_zero_or_one": found.measure("fact_calendar", "available"),
        "calendar_key_unique": found.copies("fact_calendar", "night"),
        "price_non_negative": found.measure("snapshot", "price"),
        "occupancy_in_range": found.measure("snapshot", "occupancy"),
        "snapshot_listing_parity": F.abs(found.rows("snapshot") - found.rows("dim_listing")),
    }).withColumn("category", V.rule_category(F.col("rule"))).withColumn("passed", F.col("violations") == 0)


@query("validation_date_dimension")
def _(spark, sf):
    return V.date_dimension_checks(shared(spark, sf).dim_date)


# ------------------------------------------------------------ profiling
from staylens.functions import scalars as SC  # noqa: E402
from staylens.operators import profile as PR  # noqa: E402
from staylens.sources.tables import table as _table  # noqa: E402

RAW_LISTING_COLS = ["id", "listing_url", "scrape_id", "name", "host_id", "host_name", "host_since",
                    "host_response_time", "host_response_rate", "host_acceptance_rate",
                    "host_is_superhost", "host_identity_verified", "neighbourhood_cleansed", "city",
                    "latitude", "longitude", "property_type", "room_type", "accommodates", "bathrooms",
                    "bathrooms_text", "bedrooms", "beds", "amenities", "price", "minimum_nights",
                    "maximum_nights", "has_availability", "availability_365", "number_of_reviews",
                    "last_scraped", "review_scores_rating", "review_scores_cleanliness",
                    "review_scores_location", "license", "instant_bookable",
                    "calculated_host_listings_count"]
TOPV_COLS = ["room_type", "property_type", "host_response_time", "bathrooms_text", "amenities",
             "city", "neighbourhood_cleansed", "has_availability", "instant_bookable",
             "host_is_superhost"]
IQR_COLS = ["latitude", "longitude", "minimum_nights", "maximum_nights", "availability_365",
            "number_of_reviews", "accommodates", "bedrooms", "beds", "review_scores_rating"]
EXT_COLS = ["price_numeric", "availability_365", "review_scores_rating", "accommodates", "bedrooms"]


@_q("profile_raw_listings")
def _(spark, sf):
    return PR.column_profile(shared(spark, sf).raw_listings, RAW_LISTING_COLS)


@_q("profile_extended_listings")
def _(spark, sf):
    return PR.extended_profile(shared(spark, sf).listings, EXT_COLS)


@_q("profile_field_completeness")
def _(spark, sf):
    p = shared(spark, sf)
    return PR.field_completeness({
        "listings": PR.column_profile(p.raw_listings, RAW_LISTING_COLS), "calendar": PR.column_profile(p.raw_calendar),
        "reviews": PR.column_profile(p.raw_reviews)})


@_q("profile_top_values")
def _(spark, sf):
    return PR.top_values_per_column(shared(spark, sf).raw_listings, TOPV_COLS, 5, 200)


@_q("profile_iqr_outliers")
def _(spark, sf):
    return PR.iqr_outliers(shared(spark, sf).raw_listings, IQR_COLS)


@_q("profile_domain_rules")
def _(spark, sf):
    p = shared(spark, sf)
    return PR.listing_domain_rules(p.raw_listings).unionByName(PR.calendar_domain_rules(p.raw_calendar))


@_q("profile_key_integrity")
def _(spark, sf):
    from staylens.operators import quality as Q
    p = shared(spark, sf)
    lst = Q.clean_listings_flagged(p.raw_listings).select("id")
    cal = p.calendar_q.flagged.select("listing_id", "date")
    rev = p.reviews_q.flagged.select("listing_id", "id")
    ids = lst.where(F.col("id").isNotNull()).select(F.col("id").alias("lid")).distinct()

    def one(name, df):
        return df.select(F.lit(name).alias("check"), F.col("v").cast("double").alias("value"))

    cal_orph = cal.join(ids, cal.listing_id == ids.lid, "left_anti")
    rev_orph = rev.join(ids, rev.listing_id == ids.lid, "left_anti")
    cal_ids = cal.select(F.col("listing_id").alias("cid")).distinct()
    checks = [
        one("listings_rows", lst.agg(F.count(F.lit(1)).alias("v"))),
        one("listings_id_nulls", lst.agg(F.count_if(F.col("id").isNull()).alias("v"))),
        one("listings_id_distinct", lst.agg(F.count_distinct("id").alias("v"))),
        one("listings_id_duplicate_rows", lst.groupBy("id").count().where("count > 1")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("v"))),
        one("calendar_key_duplicate_rows", cal.groupBy("listing_id", "date").count().where("count > 1")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("v"))),
        one("calendar_orphan_rows", cal_orph.agg(F.count(F.lit(1)).alias("v"))),
        one("reviews_orphan_rows", rev_orph.agg(F.count(F.lit(1)).alias("v"))),
        one("reviews_id_duplicate_rows", rev.groupBy("id").count().where("count > 1")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("v"))),
        one("listings_without_calendar", ids.join(cal_ids, ids.lid == cal_ids.cid, "left_anti")
            .agg(F.count(F.lit(1)).alias("v"))),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


@_q("profile_exact_duplicates")
def _(spark, sf):
    p = shared(spark, sf)
    return (PR.exact_duplicate_rows(p.raw_calendar).withColumn("source", F.lit("calendar"))
            .unionByName(PR.exact_duplicate_rows(p.raw_reviews).withColumn("source", F.lit("reviews"))))


@_q("document_text_templates_summary")
def _(spark, sf):
    return PR.text_templates(_table(spark, sf, "documents", "doc_id", "text"), "text")[0]


@_q("document_text_templates_top")
def _(spark, sf):
    return PR.text_templates(_table(spark, sf, "documents", "doc_id", "text"), "text", 20)[1]


@_q("review_comment_templates_summary")
def _(spark, sf):
    return PR.text_templates(shared(spark, sf).raw_reviews, "comments")[0]


@_q("listing_duplicate_blocks")
def _(spark, sf):
    lst = shared(spark, sf).listings
    block = [F.col("neighbourhood_cleansed"), F.col("host_id"), F.round("latitude", 3),
             F.round("longitude", 3), SC.normalise_name(F.col("name"))]
    return PR.duplicate_blocks(lst.where(SC.normalise_name(F.col("name")) != ""), block, "id",
                               ["id", "host_id", "neighbourhood_cleansed", "name"])


@_q("document_duplicate_blocks")
def _(spark, sf):
    d = _table(spark, sf, "documents", "doc_id", "lang", "source", "text")
    block = [F.col("lang"), SC.normalise_name(F.col("text"))]
    return PR.duplicate_blocks(d.where(SC.normalise_name(F.col("text")) != ""), block, "doc_id",
                               ["doc_id", "lang", "source"])


@_q("schema_compare_cities")
def _(spark, sf):
    lst = shared(spark, sf).listings
    cols = ["price_numeric", "host_response_rate", "bedrooms", "review_scores_rating",
            "bathroom_count", "host_is_superhost", "room_type"]
    a = PR.column_profile(lst.where(F.col("city") == "AFRICA"), cols)
    b = PR.column_profile(lst.where(F.col("city") == "AMERICA"), cols)
    return PR.schema_compare(a, b)


@_q("neighbourhood_name_parity")
def _(spark, sf):
    from staylens.plans import bindings as B
    return PR.name_parity(B.raw_neighbourhoods(spark, sf), B.neighbourhood_geometry(spark, sf),
                          "neighbourhood")


@_q("sample_listings_first_2000")
def _(spark, sf):
    return PR.bounded_sample(shared(spark, sf).listings, "id", 2000).select("id", "host_id", "price_numeric")


@_q("profile_completeness_rollup")
def _(spark, sf):
    p = shared(spark, sf)
    prof = (PR.column_profile(p.raw_listings, RAW_LISTING_COLS).withColumn("source", F.lit("listings"))
            .unionByName(PR.column_profile(p.raw_calendar).withColumn("source", F.lit("calendar")))
            .unionByName(PR.column_profile(p.raw_reviews).withColumn("source", F.lit("reviews"))))
    return PR.completeness_rollup(prof)


# ------------------------------------------------------------ statistics (H*)
from staylens.operators import stats as ST  # noqa: E402


def _h1_frame(spark, sf):
    e = _eda(spark, sf).where(F.col("room_type").isin("entire_home", "private_room"))
    return e.withColumn("log_price", F.log1p("price_numeric")), F.col("room_type") == "entire_home"


def listing_weekpart(cal: DataFrame) -> DataFrame:
    """Per-listing weekday / weekend availability (long -> wide)."""
    wk = SC.is_weekend(F.col("date"))
    a = F.col("available").cast("double")
    return cal.groupBy("listing_id").agg(F.avg(F.when(~wk, a)).alias("weekday_rate"),
                                         F.avg(F.when(wk, a)).alias("weekend_rate")) \
        .withColumn("diff", F.col("weekend_rate") - F.col("weekday_rate"))


@_q("stats_welch_room_type_log_price")
def _(spark, sf):
    e, g = _h1_frame(spark, sf)
    return ST.welch_stats(e, "log_price", g, "entire_home", "private_room")


@_q("stats_welch_review_count_log_price")
def _(spark, sf):
    e = _eda(spark, sf).where(F.col("number_of_reviews").isNotNull()).withColumn(
        "log_price", F.log1p("price_numeric"))
    return ST.welch_stats(e, "log_price", F.col("number_of_reviews") > 10, "high_review", "low_review")


@_q("stats_mann_whitney_superhost_rating")
def _(spark, sf):
    lm = _lm(spark, sf)
    return ST.mann_whitney(lm, "review_scores_rating", F.col("host_is_superhost")).drop("p_value")


def _kw_frame(spark, sf):
    e = _eda(spark, sf)
    counts = e.groupBy("neighbourhood_cleansed").agg(F.count("price_numeric").alias("__n"))
    floor = e.agg(F.greatest(F.lit(30), F.floor(F.count(F.lit(1)) * 0.001)).alias("__min"))
    keep = counts.withColumn("__one", F.lit(1)).join(F.broadcast(floor.withColumn("__one", F.lit(1))), "__one") \
        .where(F.col("__n") >= F.col("__min")).select("neighbourhood_cleansed")
    # ranks of price equal ranks of log1p(price) (monotone transform)
    return e.join(keep, "neighbourhood_cleansed", "left_semi")


@_q("stats_kruskal_neighbourhood_price")
def _(spark, sf):
    return ST.kruskal_wallis(_kw_frame(spark, sf), "price_numeric", "neighbourhood_cleansed").drop("p_value")


@_q("stats_weekend_availability_diff")
def _(spark, sf):
    wp = EDA.weekpart_availability(shared(spark, sf).calendar)
    agg = wp.agg(F.max(F.when(F.col("is_weekend"), F.col("availability_rate"))).alias("weekend_rate"),
                 F.max(F.when(~F.col("is_weekend"), F.col("availability_rate"))).alias("weekday_rate"),
                 F.sum("total_days").alias("n_total"))
    d = F.col("weekend_rate") - F.col("weekday_rate")
    return agg.select("n_total", "weekend_rate", "weekday_rate", d.alias("statistic"),
                      (F.abs(d) > 0.01).alias("significant"))


@_q("calendar_listing_weekpart_pivot")
def _(spark, sf):
    return listing_weekpart(shared(spark, sf).calendar)


@_q("stats_wilcoxon_weekend_weekday")
def _(spark, sf):
    w = ST.wilcoxon_signed_rank(listing_weekpart(shared(spark, sf).calendar))
    return w.select("n", "n_pairs", "statistic", "z", "effect_size", "mean_diff")


@_q("stats_welch_ci_room_type")
def _(spark, sf):
    e, g = _h1_frame(spark, sf)
    return ST.welch_test(e, "log_price", g, "entire_home", "private_room")


@_q("stats_bootstrap_superhost_price")
def _(spark, sf):
    return bootstrap_mean_diff(_eda(spark, sf), "price_numeric", F.col("host_is_superhost"), 2000)


@query("stats_ols_hc3_log_price")
def _(spark, sf):
    e = _eda(spark, sf).withColumn("log_price", F.log1p("price_numeric")) \
        .withColumn("superhost_flag", F.col("host_is_superhost").cast("double"))
    return ST.ols_hc3(e, "log_price", ["accommodates", "bedrooms", "review_scores_rating", "superhost_flag"],
                      ["room_type", "neighbourhood_cleansed"])


@query("stats_hypothesis_tests")
def _(spark, sf):
    """H9: the effect table (statistic, p-value, effect size, direction, significance)."""
    e, g = _h1_frame(spark, sf)
    h1 = ST.welch_test(e, "log_price", g).select(
        F.lit("H1").alias("test"), F.lit("Welch t-test (log)").alias("method"),
        (F.col("n1") + F.col("n2")).alias("n_total"), "statistic", "p_value", "effect_size",
        F.lit("Cohen d").alias("effect_label"))
    lm = _lm(spark, sf)
    h2 = ST.mann_whitney(lm, "review_scores_rating", F.col("host_is_superhost")).select(
        F.lit("H2"), F.lit("Mann-Whitney U"), (F.col("n1") + F.col("n2")), "statistic", "p_value",
        "effect_size", F.lit("rank-biserial r"))
    e3 = _eda(spark, sf).where(F.col("number_of_reviews").isNotNull()).withColumn(
        "log_price", F.log1p("price_numeric"))
    h3 = ST.welch_test(e3, "log_price", F.col("number_of_reviews") > 10).select(
        F.lit("H3"), F.lit("Welch t-test (log)"), (F.col("n1") + F.col("n2")), "statistic", "p_value",
        "effect_size", F.lit("Cohen d"))
    h4 = ST.kruskal_wallis(_kw_frame(spark, sf), "price_numeric", "neighbourhood_cleansed").select(
        F.lit("H4"), F.lit("Kruskal-Wallis"), "n_total", "statistic", "p_value", "effect_size",
        F.lit("epsilon-squared"))
    out = h1.unionAll(h2).unionAll(h3).unionAll(h4)
    return out.withColumn("significant", F.col("p_value") < 0.05).withColumn(
        "direction", F.when(F.col("effect_size") > 0, "positive").when(F.col("effect_size") < 0, "negative")
        .otherwise("none"))


# ------------------------------------------------------------ streaming (ST*)
from staylens.streaming import cdc as CDC  # noqa: E402


@query("cdc_scd2_history")
def _(spark, sf):
    job = CDC.run_from_orders(spark, sf, replays=1)
    return job.history().select("listing_id", "lsn", F.round("price_numeric", 4).alias("price_numeric"),
                                "room_type", "valid_from", "valid_to", "is_current", "is_deleted")


@query("cdc_dead_letters")
def _(spark, sf):
    job = CDC.run_from_orders(spark, sf)
    return job.dead_letters().select("listing_id", "lsn", "op", "action", "failure_reason")


@query("cdc_dead_letter_alarm")
def _(spark, sf):
    return CDC.dead_letter_alarm(CDC.run_from_orders(spark, sf).dead_letters())


@query("cdc_progress")
def _(spark, sf):
    return CDC.run_from_orders(spark, sf).progress()


@query("cdc_conservation")
def _(spark, sf):
    """Every event in is in the history, a duplicate or a dead letter, over three late and
    out-of-order batches and one delivered again."""
    job = CDC.run_from_orders(spark, sf, replays=1)
    total = job.accounting().agg(*[F.sum(c).alias(c) for c in ("events_in", "applied", "duplicate", "dead")])
    return total.select("events_in", "applied", "duplicate", "dead",
                        F.lit(job.history().count()).cast("bigint").alias("versions"),
                        F.lit(job.dead_letters().count()).cast("bigint").alias("dead_letters"))


def _expected_current(spark, sf):
    """Batch snapshot of listings implied by the orders (price after open-order repricing,
    pending low-priority orders removed)."""
    o = _table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    room = (F.when(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"), "entire_home")
            .when(F.col("o_orderpriority") == "2-HIGH", "private_room")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "shared_room").otherwise("hotel_room"))
    return o.where(~((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"))).select(
        F.col("o_orderkey").alias("listing_id"),
        F.round(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") * F.lit(1.2))
                .otherwise(F.col("o_totalprice")), 4).alias("price_numeric"),
        room.alias("room_type"))


@query("cdc_two_tables_compacted")
def _(spark, sf):
    """Versions and dead letters of each source table, with compactions between the deliveries."""
    job = CDC.run_two_tables(spark, sf)
    history = job.history().groupBy("source_table").agg(
        F.count(F.lit(1)).alias("versions"), F.count_if("is_current").alias("current_versions"),
        F.sum("lsn").alias("lsn_sum"), F.sum(F.round(F.col("price_numeric") * 100).cast("bigint")).alias("price_cents"))
    dead = job.dead_letters().groupBy("source_table").agg(
        F.count_if(F.col("failure_reason") == "conflicting_event").alias("conflicts"),
        F.count_if(F.col("failure_reason") == "invalid_price_numeric").alias("malformed"))
    return history.join(dead, "source_table", "left").fillna(0, ["conflicts", "malformed"])


@query("cdc_reconciliation")
def _(spark, sf):
    cur = CDC.run_from_orders(spark, sf).history().where("is_current AND NOT is_deleted").select(
        "listing_id", F.round("price_numeric", 4).alias("price_numeric"), "room_type")
    return CDC.reconcile(_expected_current(spark, sf), cur, "listing_id", ["price_numeric", "room_type"])


@query("calendar_upsert_last_lsn")
def _(spark, sf):
    """ST6: calendar facts upserted from line-level updates; per (listing, day) the
    update with the highest line number (the lsn) wins."""
    li = _table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_linestatus",
                "l_quantity")
    upd = li.select(F.col("l_orderkey").alias("listing_id"), F.to_date("l_shipdate").alias("date"),
                    (F.col("l_linestatus") == "O").alias("available"),
                    F.col("l_quantity").cast("long").alias("minimum_nights"),
                    F.col("l_linenumber").cast("long").alias("lsn"))
    existing = shared(spark, sf).calendar.select("listing_id", "date", "available", "minimum_nights")
    return CDC.upsert_last_wins(existing, upd, ["listing_id", "date"], "lsn")


# ------------------------------------------------------------ features, models, segments (M*)
from pyspark.ml.functions import array_to_vector  # noqa: E402

from staylens.operators import features as FE  # noqa: E402
from staylens.operators import models as MO  # noqa: E402

MODEL_NUMERIC = ["accommodates", "bedrooms", "beds", "bathroom_count", "minimum_nights",
                 "host_tenure_years", "host_response_rate", "availability_365", "review_scores_rating",
                 "review_scores_cleanliness", "review_scores_location", "reviews_per_month_calc",
                 "calculated_host_listings_count", "number_of_reviews", "beds_per_guest",
                 "host_is_superhost", "instant_bookable", "bathroom_is_shared", "amenity_count",
                 "latitude", "longitude", *(flag for _, flag in FE.AMENITY_FLAGS)]
MODEL_CATEGORICAL = ["room_type", "neighbourhood_cleansed", "property_type_bucket"]


FEATURE_NEEDS = (*MASTER_NEEDS, *FE.NUMERIC_FEATURES, *FE.BINARY_FEATURES, *FE.CATEGORICAL_FEATURES, "amenities")


def _features(spark, sf):
    """Model inputs, written once (to the shared spark.checkpoint.dir): model fitting runs many
    actions over them, and the lineage back to the raw scans is cut. Listings without the columns
    that no feature needs are kept; the master is made once, so it isn't."""
    import uuid
    from staylens.session import release, scratch_path
    path = scratch_path(spark, f"features-{uuid.uuid4().hex}")
    FE.listing_features(shared(spark, sf, FEATURE_NEEDS, LISTINGS_ONLY).master).write.parquet(path)
    release(spark)
    return spark.read.parquet(path)


def _split(spark, sf):
    f = MO.group_split(_features(spark, sf))
    return f.where(~F.col("is_test")), f.where(F.col("is_test"))


@_q("features_listing_matrix")
def _(spark, sf):
    return _features(spark, sf)


@_q("features_host")
def _(spark, sf):
    hf = FE.host_features(shared(spark, sf).master)
    # exact decimal means: report half-up at 4 places on both engines
    return hf.withColumns({c: F.round(F.col(c) + F.lit(1e-9), 4) for c in ["avg_price", "avg_review_scores_rating"]})


@_q("features_clustering")
def _(spark, sf):
    return FE.clustering_features(shared(spark, sf).master, LONDON_CENTRE)


@_q("model_group_split")
def _(spark, sf):
    f = MO.group_split(_features(spark, sf))
    return f.groupBy("is_test").agg(F.count(F.lit(1)).alias("listings"),
                                    F.count_distinct("host_id").alias("hosts"))


@_q("model_baseline_medians")
def _(spark, sf):
    tr, te = _split(spark, sf)
    return MO.baseline_medians(tr, te)


def _fit(spark, sf, kind):
    tr, te = _split(spark, sf)
    model, fill = MO.fit_price_model(tr, kind, MODEL_NUMERIC, MODEL_CATEGORICAL)
    return model, fill, te


@_q("model_price_comparison")
def _(spark, sf):
    """Ridge, random forest and boosting vs the median baselines, test MAE order."""
    out = None
    tr, te = _split(spark, sf)
    for kind in ["ridge", "random_forest", "gradient_boosting"]:
        model, fill = MO.fit_price_model(tr, kind, MODEL_NUMERIC, MODEL_CATEGORICAL)
        m = MO.regression_metrics(MO.score(model, te, fill)).withColumn("model", F.lit(kind))
        out = m if out is None else out.unionByName(m)
    return out.unionByName(MO.baseline_medians(tr, te)).orderBy("mae")


@_q("model_gradient_boosting")
def _(spark, sf):
    """Gradient boosting, 500 rounds x 0.05 learning rate (the reference setting)."""
    model, fill, te = _fit(spark, sf, "gradient_boosting")
    return MO.regression_metrics(MO.score(model, te, fill)).withColumn(
        "model", F.lit("gradient_boosting"))


@_q("model_cv_ridge")
def _(spark, sf):
    """5-fold group CV (fold = host hash), MAE in price units, train/validation gap."""
    f = _features(spark, sf).withColumn("fold", MO.hash_bucket("host_id", 5, 7))
    rows = None
    for k in range(5):
        tr, va = f.where(F.col("fold") != k), f.where(F.col("fold") == k)
        model, fill = MO.fit_price_model(tr, "ridge", MODEL_NUMERIC, MODEL_CATEGORICAL)
        mv = MO.regression_metrics(MO.score(model, va, fill)).select(F.col("mae").alias("val_mae"))
        mt = MO.regression_metrics(MO.score(model, tr, fill)).select(F.col("mae").alias("train_mae"))
        r = mv.withColumn("__one", F.lit(1)).join(mt.withColumn("__one", F.lit(1)), "__one") \
            .select(F.lit(k).alias("fold"), "train_mae", "val_mae",
                    (F.col("train_mae") - F.col("val_mae")).alias("overfit_gap"))
        rows = r if rows is None else rows.unionByName(r)
    return rows


@_q("model_residuals_by_segment")
def _(spark, sf):
    model, fill, te = _fit(spark, sf, "ridge")
    res = MO.residual_table(MO.score(model, te, fill))
    res = res.withColumn("host_segment", Bd.band(F.col("calculated_host_listings_count"),
                                                 [("solo (1)", 1), ("multi (2-4)", 4), ("professional (5+)", None)]))
    out = None
    for seg in ["price_band", "room_type", "host_segment"]:
        s = MO.segment_errors(res, seg).select(F.lit(seg).alias("segment_type"),
                                               F.col(seg).alias("segment"), "*").drop(seg)
        out = s if out is None else out.unionByName(s)
    return out


@_q("model_batch_scoring")
def _(spark, sf):
    model, fill, te = _fit(spark, sf, "ridge")
    return MO.reliability_flags(MO.score(model, te, fill)).select(
        "id", "room_type", "price_numeric", "predicted_price", "warnings")


@_q("model_permutation_importance")
def _(spark, sf):
    model, fill, te = _fit(spark, sf, "ridge")
    feats = ["accommodates", "bedrooms", "availability_365", "review_scores_rating", "minimum_nights",
             "host_tenure_years", "number_of_reviews", "amenity_count"]
    return MO.permutation_importance(model, te, feats, fill, repeats=10)


@_q("model_cross_city_transfer")
def _(spark, sf):
    f = _features(spark, sf).join(shared(spark, sf).listings.select("id", "city"), "id").checkpoint(eager=True)
    a, b = f.where(F.col("city") == "AFRICA"), f.where(F.col("city") == "AMERICA")
    ta, tb = MO.group_split(a), MO.group_split(b)
    model_a, fill_a = MO.fit_price_model(ta.where(~F.col("is_test")), "ridge", MODEL_NUMERIC, MODEL_CATEGORICAL)
    model_b, fill_b = MO.fit_price_model(tb.where(~F.col("is_test")), "ridge", MODEL_NUMERIC, MODEL_CATEGORICAL)
    test_b = tb.where(F.col("is_test"))
    transfer = MO.score(model_a, test_b, fill_a)
    native = MO.score(model_b, test_b, fill_b)
    out = MO.regression_metrics(transfer).withColumn("setting", F.lit("AFRICA->AMERICA")).unionByName(
        MO.regression_metrics(native).withColumn("setting", F.lit("AMERICA in-domain")))
    by_rt = MO.segment_errors(MO.residual_table(transfer), "room_type").select(
        F.col("room_type").alias("segment"), "n", "mae")
    return out.withColumn("segment", F.lit("all")).select("setting", "segment", "n", "mae").unionByName(
        by_rt.select(F.lit("AFRICA->AMERICA").alias("setting"), "segment", "n", "mae"))


def _segments(features, cols, log_cols):
    """Fitted scaler and vectors of checkpointed features."""
    stats = MO.scaler(features, cols, log_cols)
    return stats, MO.assemble(MO.scaled(features, stats, cols, log_cols), [f"z_{c}" for c in cols])


#: What the segmentations read of a listing; the master is made once or twice, so it isn't kept.
SEGMENT_NEEDS = ((*MASTER_NEEDS, "accommodates", "minimum_nights", "latitude", "longitude", "amenities",
                  "host_response_rate", "host_acceptance_rate"), LISTINGS_ONLY)


def _listing_segments(spark, sf):
    from staylens.session import ensure_checkpoint_dir, release
    ensure_checkpoint_dir(spark)
    cf = FE.clustering_features(shared(spark, sf, *SEGMENT_NEEDS).master, LONDON_CENTRE).checkpoint(eager=True)
    release(spark)
    return (cf, *_segments(cf, FE.CLUSTER_FEATURES, FE.CLUSTER_LOG))


def _host_segments(spark, sf):
    from staylens.session import ensure_checkpoint_dir, release
    ensure_checkpoint_dir(spark)
    # written before the medians are found, else the hosts are made twice
    hosts = FE.host_features(shared(spark, sf, *SEGMENT_NEEDS).master, impute=False).checkpoint(eager=True)
    hf = FE.median_impute(hosts, FE.HOST_FEATURES).checkpoint(eager=True)
    release(spark)
    return (hf, *_segments(hf, FE.HOST_FEATURES, FE.HOST_LOG))


def _fitted(vec, ks):
    fits = MO.Fits(vec)  # the chosen k's are the sweep's
    sweep = MO.kmeans_sweep(vec, ks, fits=fits).collect()
    try:
        return MO.best_kmeans(vec, MO.choose_k([r.asDict() for r in sweep]), fits=fits)
    finally:
        fits.close()


def _labelled_by(model, vec):
    return model.transform(vec).withColumnRenamed("prediction", "cluster")


@_q("segments_listing_kmeans_sweep")
def _(spark, sf):
    return MO.kmeans_sweep(_listing_segments(spark, sf)[2].cache(), range(2, 11))


@_q("segments_host_kmeans_sweep")
def _(spark, sf):
    return MO.kmeans_sweep(_host_segments(spark, sf)[2].cache(), range(2, 9))


@_q("segments_listing_profiles")
def _(spark, sf):
    vec = _listing_segments(spark, sf)[2].cache()
    model = _fitted(vec, range(2, 11))
    return MO.cluster_profile(_labelled_by(model, vec)).withColumn("k", F.lit(model.summary.k))


@_q("segments_host_profiles")
def _(spark, sf):
    vec = _host_segments(spark, sf)[2].cache()
    model = _fitted(vec, range(2, 9))
    return MO.host_profile(_labelled_by(model, vec)).withColumn("k", F.lit(model.summary.k))


@_q("segments_listing_profile_of_labels")
def _(spark, sf):
    """AG40, AG42, W6, SC44 over given labels (id modulo 6), so that SQL can check them."""
    cf = FE.clustering_features(shared(spark, sf).master, LONDON_CENTRE)
    return MO.cluster_profile(cf.withColumn("cluster", (F.col("id") % 6).cast("int"))).select(
        "cluster", "size", "pct_of_city", "median_price", "median_minimum_nights", "mean_amenity_count",
        "mean_distance_km", "pct_entire_home", "pct_private_room", "pct_shared_room", "pct_hotel_room", "price_rank")


@_q("segments_embedding_clusters")
def _(spark, sf):
    e = _table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    vec = e.select("vec_id", "label", array_to_vector("embedding").alias("features")).cache()
    lab = MO.fit_kmeans(vec, 4)
    n = lab.agg(F.count(F.lit(1)).alias("__n")).withColumn("__one", F.lit(1))
    return lab.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"),
                                      F.mode("label", deterministic=True).alias("modal_label")) \
        .withColumn("__one", F.lit(1)).join(F.broadcast(n), "__one") \
        .select("cluster", "size", "modal_label", (F.col("size") * 100.0 / F.col("__n")).alias("pct"))


@_q("segments_assign_batch")
def _(spark, sf):
    """M8: every listing of the master, priced or not, by the fitted scaler, model and medians."""
    cf, stats, vec = _listing_segments(spark, sf)
    model = _fitted(vec.cache(), range(2, 11))
    names = MO.cluster_profile(_labelled_by(model, vec)).select("cluster", "segment_name")
    given = FE.clustering_inputs(shared(spark, sf, *SEGMENT_NEEDS).master, LONDON_CENTRE)
    out = MO.assign_clusters(model, stats, FE.column_medians(cf, FE.CLUSTER_FEATURES), given, FE.CLUSTER_FEATURES, FE.CLUSTER_LOG)
    return out.join(F.broadcast(names), "cluster").select("id", "cluster", "segment_name", "imputed_fields")


@_q("segments_assign_hosts_batch")
def _(spark, sf):
    hf, stats, vec = _host_segments(spark, sf)
    model = _fitted(vec.cache(), range(2, 9))
    names = MO.host_profile(_labelled_by(model, vec)).select("cluster", "cluster_name")
    given = FE.host_features(shared(spark, sf, *SEGMENT_NEEDS).master, impute=False)
    out = MO.assign_clusters(model, stats, FE.column_medians(hf, FE.HOST_FEATURES), given, FE.HOST_FEATURES, FE.HOST_LOG)
    return out.join(F.broadcast(names), "cluster").select("host_id", "cluster", "cluster_name", "imputed_fields")


# ------------------------------------------------------------ sources, search, completion (IO*, PF12-21, T*, V11-12)
from staylens.operators import geo as GEO  # noqa: E402
from staylens.operators import search as SE  # noqa: E402
from staylens.sources import files as FI  # noqa: E402


@_q("geo_neighbourhood_metrics")
def _(spark, sf):
    """J11 + GE2: density joined to median price per neighbourhood."""
    p = shared(spark, sf)
    dens = EDA.neighbourhood_density(EDA.with_bands(p.master))
    price = EDA.price_by_group(EDA.price_eligible(p.listings), ["neighbourhood_cleansed"], probs=()) \
        .select(F.col("neighbourhood_cleansed").alias("neighbourhood"), "median_price")
    return dens.join(price, "neighbourhood", "left")


@query("geo_features_roundtrip")
def _(spark, sf):
    """GE4 + IO9 + IO4: enriched GeoJSON features written to the shared folder, read back,
    areas recomputed from the read geometry."""
    import uuid
    from staylens.session import scratch_path
    p = shared(spark, sf)
    feats = GEO.geojson_features(p.neighbourhood_summary.select("neighbourhood", "listing_count",
                                                                "median_price_gbp", "listings_per_km2"),
                                 p.geometry)
    path = scratch_path(spark, f"geojson-{uuid.uuid4().hex}")
    FI.write_geojson_lines(feats, path)
    back = FI.read_geojson(spark, path, collection=False)
    named = back.select(F.col("properties")["neighbourhood"].alias("neighbourhood"), "coordinates",
                        F.col("properties")["listing_count"].alias("listing_count"))
    return GEO.polygon_metrics(named).join(named.select("neighbourhood", "listing_count"), "neighbourhood")


@query("raw_file_manifest")
def _(spark, sf):
    return FI.file_manifest(spark, f"{sf}/*.parquet").drop("modificationTime")


@_q("dataset_inventory")
def _(spark, sf):
    p = shared(spark, sf)
    return FI.inventory({"listings": p.raw_listings, "calendar": p.raw_calendar, "reviews": p.raw_reviews,
                         "neighbourhoods": B_raw_neigh(spark, sf)})


def B_raw_neigh(spark, sf):
    from staylens.plans import bindings as B
    return B.raw_neighbourhoods(spark, sf)


@_q("multi_city_union")
def _(spark, sf):
    lst = shared(spark, sf).listings.drop("city")
    cities = [r[0] for r in _table(spark, sf, "region", "r_name").collect()]  # 5 regions (fixed size)
    frames = {c: lst.join(shared(spark, sf).listings.where(F.col("city") == c).select("id"), "id", "left_semi")
              for c in cities}
    u = FI.union_cities(frames)
    return u.groupBy("city").agg(F.count(F.lit(1)).alias("listings"),
                                 F.count_distinct("host_id").alias("hosts"))


@_q("listing_preview")
def _(spark, sf):
    return FI.preview(shared(spark, sf).listings.select("id", "name", "price_numeric", "room_type"), 20, ["id"])


@_q("column_samples_listings")
def _(spark, sf):
    df = shared(spark, sf).listings.select("room_type", "property_type_bucket", "city", "currency_code",
                                             "host_response_time", "instant_bookable")
    return FI.column_samples(df, 8, 50).withColumn("samples", F.concat_ws("|", "samples"))


@_q("search_listings_filtered")
def _(spark, sf):
    return SE.search_listings(shared(spark, sf).listings, room_type="entire_home", neighbourhood="nation_1",
                              min_price=1000.0, max_price=300000.0, min_rating=4.0, superhost=True,
                              limit=50).select("id", "neighbourhood_cleansed", "price_numeric", "review_scores_rating")


@_q("listing_lookup")
def _(spark, sf):
    return SE.lookup(shared(spark, sf).listings, "id", 7).select("id", "host_id", "price_numeric", "room_type")


@_q("listing_filter_page")
def _(spark, sf):
    return SE.page_with_total(
        shared(spark, sf).listings.where(F.lower("room_type") == "private_room")
        .where(F.lower("name").contains("household")).select("id", "name", "price_numeric"), "id", 20, 25)


@_q("top_neighbourhoods_by_metric")
def _(spark, sf):
    return SE.top_n_by_metric(shared(spark, sf).neighbourhood_summary, "median_price_gbp", 10) \
        .select("neighbourhood", "median_price_gbp", "listing_count")


@_q("top_neighbourhoods_null_as_zero")
def _(spark, sf):
    return SE.top_n_null_as_zero(shared(spark, sf).neighbourhood_summary, "avg_review_score", 5,
                                 "neighbourhood").select("neighbourhood", "avg_review_score")


GUARDED_EXAMPLE = """```sql
SELECT room_type, count(*) AS listings, round(median(price_numeric), 2) AS median_price
FROM listings_clean GROUP BY room_type ORDER BY listings DESC, room_type
```"""


@_q("guarded_sql_example")
def _(spark, sf):
    shared(spark, sf).listings.createOrReplaceTempView("listings_clean")
    return SE.run_guarded(spark, GUARDED_EXAMPLE, 50)


@_q("warehouse_completion_checks")
def _(spark, sf):
    """V11 + V12: expected warehouse tables registered, and every named report runs."""
    p = shared(spark, sf, WAREHOUSE_NEEDS, ("listings", "calendar"))
    from staylens.plans import reports as R
    from staylens.session import release
    wh = p.warehouse()
    R.register_views(spark, wh)
    present = {t.name for t in spark.catalog.listTables()}
    rows = [("table_present", n, n in present) for n in wh]
    for name in R.REPORT_NAMES:
        try:
            p.report(name).limit(1).collect()
            ok = True
        except Exception:  # noqa: BLE001
            ok = False
        rows.append(("report_runs", name, ok))
        release(spark)
    return spark.createDataFrame(rows, "check string, target string, passed boolean")
