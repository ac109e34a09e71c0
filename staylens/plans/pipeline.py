"""The composed pipeline over the bound tables, as one lazy object.

Every attribute is a lazy DataFrame built on first access; Catalyst sees the
whole chain from the Parquet scans to the report. ``materialize`` writes the
three expensive boundaries (clean tables, master, facts) to Parquet in the
shared checkpoint folder, which also cuts lineage for long jobs.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.operators import geo, quality, star, summaries
from staylens.plans import bindings as B
from staylens.plans import reports


_SHARED: dict = {}


#: What the listing master and the neighbourhood summary read of a listing, besides what their readers ask for.
MASTER_NEEDS = ("id", "host_id", "neighbourhood_cleansed", "room_type", "price_numeric", "bedrooms", "host_since",
                "host_is_superhost", "review_scores_rating", "availability_365", "calculated_host_listings_count",
                "has_availability", "is_de_facto_inactive")
#: What the warehouse tables, their rules and the reports read of a listing.
WAREHOUSE_NEEDS = (*MASTER_NEEDS, *star.HOST_ATTRS, *star.LISTING_ATTRS, *star.SNAPSHOT_MEASURES)
#: What one-off queries keep: the narrow listings are read several times, the others once.
LISTINGS_ONLY = ("listings",)


def shared(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None,
           kept: tuple[str, ...] | None = None) -> "Pipeline":
    """One lazy Pipeline per (session, data folder), and per ``columns`` and ``kept`` where a query asks for
    narrow tables (see ``Pipeline``).

    Its attributes are immutable lazy DataFrames, so queries in one session
    share the Python-side plan construction; every action still executes the
    full plan from the scans.
    """
    key = (id(spark), sf_dir, columns, kept)
    p = _SHARED.get(key)
    if p is None or p.spark is not spark:
        p = Pipeline(spark, sf_dir, persist=True, columns=columns, kept=kept)
        _SHARED[key] = p
    return p


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, snapshot: _dt.date = B.SNAPSHOT,
                 currency_code: str = "GBP", persist: bool = False,
                 columns: tuple[str, ...] | None = None, kept: tuple[str, ...] | None = None):
        """``persist``: keep the clean/rejected tables and the master in executor
        memory/disk once computed (the pipeline's materialisation boundaries), for
        sessions that run many reports over one snapshot. ``kept``: only these of them
        (listings, calendar, reviews, master); a table that isn't kept is made of the columns
        that its reader needs, each time it is read. ``columns``: of the clean listings only these,
        and reviews without their texts."""
        self.persist = persist
        self.columns = columns
        self.kept = kept
        self.spark = spark
        self.sf_dir = sf_dir
        self.snapshot = snapshot
        self.currency_code = currency_code

    # -- raw (bound) -------------------------------------------------------
    @cached_property
    def raw_listings(self) -> DataFrame:
        return B.raw_listings(self.spark, self.sf_dir)

    @cached_property
    def raw_calendar(self) -> DataFrame:
        return B.raw_calendar(self.spark, self.sf_dir)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        return B.raw_reviews(self.spark, self.sf_dir)

    @cached_property
    def geometry(self) -> DataFrame:
        return B.neighbourhood_geometry(self.spark, self.sf_dir)

    # -- clean + quarantine ------------------------------------------------
    def _keep(self, df: DataFrame, name: str = "") -> DataFrame:
        if self.persist and (self.kept is None or name in self.kept):
            from pyspark import StorageLevel
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        return df

    def _quarantine(self, q: quality.Quarantined, name: str) -> quality.Quarantined:
        return quality._split(self._keep(q.flagged, name)) if self.persist else q

    @cached_property
    def listings_q(self) -> quality.Quarantined:
        q = quality.clean_listings(self.raw_listings, self.currency_code)
        if self.columns is not None:
            wanted = {*self.columns, "rejection_reason"}
            q = quality._split(q.flagged.select(*[c for c in q.flagged.columns if c in wanted]))
        return self._quarantine(q, "listings")

    @cached_property
    def calendar_q(self) -> quality.Quarantined:
        return self._quarantine(quality.clean_calendar(self.raw_calendar), "calendar")

    @cached_property
    def reviews_q(self) -> quality.Quarantined:
        q = quality.clean_reviews(self.raw_reviews)
        if self.columns is not None:
            q = quality._split(q.flagged.drop("comments", "reviewer_name"))
        return self._quarantine(q, "reviews")

    @property
    def listings(self) -> DataFrame:
        return self.listings_q.clean

    @property
    def calendar(self) -> DataFrame:
        return self.calendar_q.clean

    @property
    def reviews(self) -> DataFrame:
        return self.reviews_q.clean

    @cached_property
    def neighbourhoods(self) -> DataFrame:
        metrics = geo.polygon_metrics(self.geometry)
        return quality.clean_neighbourhoods(B.raw_neighbourhoods(self.spark, self.sf_dir), metrics)

    # -- summaries + master ------------------------------------------------
    @cached_property
    def calendar_summary(self) -> DataFrame:
        return summaries.calendar_summary(self.calendar)

    @cached_property
    def review_summary(self) -> DataFrame:
        return summaries.review_summary(self.reviews, self.snapshot)

    @cached_property
    def neighbourhood_summary(self) -> DataFrame:
        return summaries.neighbourhood_summary(self.listings, self.neighbourhoods)

    @cached_property
    def master(self) -> DataFrame:
        return self._keep(summaries.listing_master(self.listings, self.review_summary,
                                                   self.calendar_summary, self.neighbourhood_summary,
                                                   self.snapshot), "master")

    @cached_property
    def listing_states(self) -> DataFrame:
        """Price, room type and inactivity of the listings with their calendars' spans; only the raw
        columns that these and the rejection rules need are joined, checked for copies and kept."""
        raw = self.raw_listings.select("id", "price", "latitude", "longitude", "room_type", "minimum_nights")
        spans = self.calendar_summary.select(
            F.col("listing_id").alias("id"), "first_calendar_date", "last_calendar_date", "availability_rate")
        return self._keep(quality.clean_listings(raw, self.currency_code).clean.select(
            "id", "price_numeric", "room_type", "is_de_facto_inactive").join(spans, "id"))

    # -- star schema -------------------------------------------------------
    @cached_property
    def dim_neighbourhood(self) -> DataFrame:
        return star.dim_neighbourhood(self.neighbourhoods)

    @cached_property
    def dim_host(self) -> DataFrame:
        return star.dim_host(self.listings)

    @cached_property
    def dim_listing(self) -> DataFrame:
        return star.dim_listing(self.listings, self.dim_host, self.dim_neighbourhood)

    @cached_property
    def dim_date(self) -> DataFrame:
        days = self.calendar.select("date").unionByName(self.reviews.select("date"))
        return star.dim_date(self.spark, B.DIM_DATE_START, B.DIM_DATE_END, days)

    @cached_property
    def dim_city(self) -> DataFrame:
        r = self.spark.read.parquet(f"{self.sf_dir}/region.parquet")
        cities = r.select(F.upper(F.substring("r_name", 1, 3)).alias("city_code"),
                          F.col("r_name").alias("city_name"),
                          F.lit("GB").alias("country_code"),
                          F.lit(self.currency_code).alias("currency_code"),
                          F.lit("Europe/London").alias("timezone"))
        return star.dim_city(self.spark, cities)

    @cached_property
    def fact_calendar(self) -> DataFrame:
        return star.fact_calendar(self.calendar)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return star.fact_reviews(self.reviews)

    @cached_property
    def fact_listing_snapshot(self) -> DataFrame:
        return star.fact_listing_snapshot(self.master, self.dim_host, self.dim_neighbourhood,
                                          self.snapshot)

    def warehouse(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in
                ["dim_city", "dim_neighbourhood", "dim_host", "dim_listing", "dim_date",
                 "fact_calendar", "fact_reviews", "fact_listing_snapshot"]}

    def report(self, name: str) -> DataFrame:
        """Run a named report; only the warehouse tables that it names are built."""
        needed = {n: getattr(self, n) for n in reports.needed_tables(name)}
        return reports.run_report(self.spark, name, needed)

    # -- materialisation ---------------------------------------------------
    def materialize(self, out_dir: str) -> dict[str, str]:
        """Write clean/rejected, master and facts once; re-point attributes at them."""
        paths = {}
        for name, q in [("listings", self.listings_q), ("calendar", self.calendar_q),
                        ("reviews", self.reviews_q)]:
            p = f"{out_dir}/{name}_flagged"
            (q.flagged.withColumn("is_rejected", F.col("rejection_reason").isNotNull())
             .write.mode("overwrite").partitionBy("is_rejected").parquet(p))
            flagged = self.spark.read.parquet(p).drop("is_rejected")
            setattr(self, f"{name}_q", quality._split(flagged))
            paths[name] = p
        for name in ["master", "fact_calendar", "fact_listing_snapshot"]:
            p = f"{out_dir}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(p)
            self.__dict__[name] = self.spark.read.parquet(p)
            paths[name] = p
        return paths
