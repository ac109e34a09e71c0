"""Exploratory tables (AG10-AG36, AG46, AG58, PF10-PF18, W3, T6).

Every table is one lazy aggregation over a column-parameterised input. Grouped
medians/quantiles use Spark's exact ``percentile`` (partial aggregation per
task); global quantile filters use ``exact_quantile`` which finds order
statistics with a distributed range sort instead of one reducer.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import bands as Bd
from staylens.functions import scalars as S
from staylens.functions.statmath import t_critical
from staylens.operators.ordered import exact_quantiles, null_safe_join, ordered_index, with_quantiles


# ------------------------------------------------------------------ helpers
def exact_quantile(df: DataFrame, col: str, prob: float) -> DataFrame:
    """One-row DataFrame ``q``: exact linear-interpolation quantile of ``col``."""
    one = df.sparkSession.range(1).select(F.lit(1).alias("__k"))
    return with_quantiles(one, df.select(F.col(col).alias("v"), F.lit(1).alias("__k")), ["__k"], {"q": ("v", prob)}).select("q")


def _column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row: exact quantiles ``q{column}_{probability}`` by place, of all columns in one pass."""
    numbered = df.select(F.lit(1).alias("__k"), *(F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)))
    one = df.sparkSession.range(1).select(F.lit(1).alias("__k"))
    return with_quantiles(one, numbered, ["__k"], {
        f"q{i}_{j}": (f"__v{i}", p) for i in range(len(cols)) for j, p in enumerate(probs)}).drop("__k")


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row tables side by side."""
    return null_safe_join(a, b, [])


def with_bands(lm: DataFrame, portfolio: str = "host_portfolio_size",
               availability: str = "availability_365",
               tenure: str = "host_tenure_years") -> DataFrame:
    """SC31/SC33/SC34: host segment, availability band and tenure band columns."""
    return lm.select("*",
                     Bd.band(F.col(portfolio), Bd.HOST_SEGMENT_BANDS).alias("host_segment"),
                     Bd.band(F.col(availability), Bd.AVAILABILITY_BANDS).alias("avail_band"),
                     Bd.band(F.col(tenure), Bd.TENURE_BANDS).alias("tenure_band"))


def price_eligible(df: DataFrame, price: str = "price_numeric", strict: bool = False) -> DataFrame:
    """PF10: non-null, non-negative price (strict: > 0, for features)."""
    p = F.col(price)
    return df.where(p.isNotNull() & ((p > 0) if strict else (p >= 0)))


def population_exclusion(df: DataFrame, price: str = "price_numeric") -> DataFrame:
    """PF11: total / missing / negative / eligible counts as rows."""
    p = F.col(price)
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(p.isNull()).alias("missing"),
                 F.count_if(p < 0).alias("negative"),
                 F.count_if(p >= 0).alias("eligible"))
    return agg.select(F.expr("stack(4, 'total', total, 'missing_price', missing, "
                             "'negative_price', negative, 'eligible', eligible) "
                             "AS (population, listing_count)"))


# ------------------------------------------------------------------ summaries
def numeric_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG10 + G2: describe() per column in ONE aggregation pass, unpivoted."""
    probs = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = _one_row(df.agg(*aggs), _column_quantiles(df, cols, probs))
    rows = []
    for i, c in enumerate(cols):
        q = [F.col(f"q{i}_{j}") for j in range(len(probs))]
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
            F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
            F.col(f"lo{i}").alias("min"),
            *[q[j].alias(f"p{int(p * 100):02d}") for j, p in enumerate(probs)],
            F.col(f"hi{i}").alias("max"),
            (F.col("__rows") - F.col(f"n{i}")).alias("missing_count"),
            ((F.col("__rows") - F.col(f"n{i}")) * 100.0 / F.col("__rows")).alias("missing_pct")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def money_mean(c: Column | str, scale: int = 2) -> Column:
    """Mean of a money column from an exact decimal sum (order-independent)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double") / F.count(c)


def price_by_group(df: DataFrame, group: Sequence[str], price: str = "price_numeric",
                   probs: Sequence[float] = (0.25, 0.75, 0.95)) -> DataFrame:
    """AG11/AG12/AG14/AG19/AG31: count, median, mean and quantiles per group."""
    named = {"median_price": 0.5, **{f"p{int(p * 100)}": p for p in probs}}
    agg = df.groupBy(*group).agg(F.count(price).alias("listing_count"), money_mean(price).alias("mean_price"))
    return with_quantiles(agg, df, group, {n: (price, p) for n, p in named.items()}).select(
        *group, "listing_count", "median_price", "mean_price", *[n for n in named if n != "median_price"])


def adaptive_floor(df: DataFrame, min_abs: int, frac: float) -> Column:
    """PF17: max(min_abs, floor(frac * rows)) as a scalar subquery column."""
    return F.greatest(F.lit(min_abs), F.floor(F.lit(frac) * F.count(F.lit(1))).cast("long"))


def having_floor(grouped: DataFrame, base: DataFrame, count_col: str, min_abs: int,
                 frac: float) -> DataFrame:
    """Keep groups whose count >= max(min_abs, floor(frac * |base|))."""
    floor = base.agg(adaptive_floor(base, min_abs, frac).alias("__floor"))
    # one-row threshold table joined on a constant key (broadcast)
    g = grouped.withColumn("__one", F.lit(1))
    f = floor.withColumn("__one", F.lit(1))
    return g.join(F.broadcast(f), "__one").where(F.col(count_col) >= F.col("__floor")) \
        .drop("__one", "__floor")


def mean_ci(df: DataFrame, group: Sequence[str], value: str = "price_numeric",
            min_n: int = 3) -> DataFrame:
    """AG13: 95 % t-interval of the mean per group; fewer than ``min_n`` -> null.

    Spark reduces each group to (n, mean, sd); the t critical value for
    n - 1 degrees of freedom is computed on that per-group table.
    """
    agg = df.groupBy(*group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("sd"))
    half = t_critical(F.col("n") - 1) * F.col("sd") / F.sqrt(F.col("n"))
    ok = F.col("n") >= min_n
    return agg.select(*group, "n", "mean",
                      F.when(ok, F.col("mean") - half).alias("ci_lower"),
                      F.when(ok, F.col("mean") + half).alias("ci_upper"))


def segment_summary(lm: DataFrame, segment: str, order: Sequence[str],
                    superhost: str = "host_is_superhost") -> DataFrame:
    """AG15/AG25: per-segment counts and medians, in the fixed segment order."""
    sh = F.col(superhost).cast("double")
    agg = lm.groupBy(segment).agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.count_distinct("host_id").alias("unique_hosts"),
        F.avg(sh).alias("superhost_rate"))
    agg = with_quantiles(agg, lm, [segment], {f"median_{n}": (c, 0.5) for n, c in (
        ("price", "price_numeric"), ("rating", "review_scores_rating"), ("occupancy", "occupancy_proxy"),
        ("availability", "availability_365"), ("portfolio", "host_portfolio_size"))}).select(
        segment, "listing_count", "unique_hosts", "median_price", "median_rating", "median_occupancy",
        "median_availability", "median_portfolio", "superhost_rate")
    return agg.withColumn("segment_rank", Bd.band_rank(F.col(segment), list(order)))


def availability_band_summary(lm: DataFrame, band_col: str = "avail_band") -> DataFrame:
    """AG17: every band present (empty bands -> 0), share of all listings."""
    spark = lm.sparkSession
    labels = Bd.labels(Bd.AVAILABILITY_BANDS)
    bands = spark.createDataFrame([(b, i + 1) for i, b in enumerate(labels)], "band string, band_rank int")
    total = lm.agg(F.count(F.lit(1)).alias("__total"))
    banded = lm.withColumn("band", F.col(band_col))
    agg = with_quantiles(banded.groupBy("band").agg(F.count(F.lit(1)).alias("listing_count")), banded, ["band"], {
        "median_price": ("price_numeric", 0.5), "median_occupancy": ("occupancy_proxy", 0.5)})
    j = (bands.join(agg, "band", "left").withColumn("__one", F.lit(1))
         .join(F.broadcast(total.withColumn("__one", F.lit(1))), "__one"))
    n = F.coalesce(F.col("listing_count"), F.lit(0))
    return j.select("band", "band_rank", n.alias("listing_count"),
                    (n * 100.0 / F.col("__total")).alias("share_pct"),
                    "median_price", "median_occupancy")


def neighbourhood_density(lm: DataFrame) -> DataFrame:
    """AG18: count, distinct hosts and the (per-neighbourhood constant) density."""
    return lm.groupBy(F.col("neighbourhood_cleansed").alias("neighbourhood")).agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.count_distinct("host_id").alias("unique_hosts"),
        F.max("neighbourhood_density_per_km2").alias("listings_per_km2"))


def price_by_distance(eda: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """AG19 + GE3: price per distance band from a city centre."""
    geo = eda.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    d = S.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(centre[0]), F.lit(centre[1]))
    geo = geo.withColumn("dist_band", Bd.band(d, Bd.DISTANCE_BANDS))
    out = price_by_group(geo, ["dist_band"], probs=(0.75,))
    return out.withColumn("band_rank", Bd.band_rank(F.col("dist_band"), Bd.labels(Bd.DISTANCE_BANDS)))


def room_type_mix(lm: DataFrame, group: str = "neighbourhood_cleansed",
                  room_type: str = "room_type",
                  types: Sequence[str] = ("entire_home", "hotel_room", "private_room",
                                          "shared_room")) -> DataFrame:
    """AG20: row-normalised crosstab (% per group), absent types -> 0."""
    base = lm.where(F.col(room_type).isNotNull() & F.col(group).isNotNull())
    pv = base.groupBy(group).pivot(room_type, list(types)).count()
    tot = sum(F.coalesce(F.col(t), F.lit(0)) for t in types)
    return pv.select(F.col(group), *[(F.coalesce(F.col(t), F.lit(0)) * 100.0 / tot).alias(t)
                                     for t in types])


def monthly_availability(cal: DataFrame) -> DataFrame:
    """AG21: per month days, available days, distinct listings, rates."""
    ai = F.col("available").cast("int")
    agg = cal.groupBy(S.month_bucket(F.col("date")).alias("month")).agg(
        F.count(ai).alias("total_days"), F.sum(ai).cast("long").alias("available_days"),
        F.count_distinct("listing_id").alias("unique_listings"))
    rate = F.col("available_days") / F.col("total_days")
    return agg.select("*", rate.alias("availability_rate"), (1 - rate).alias("occupancy_rate"))


def weekpart_availability(cal: DataFrame) -> DataFrame:
    """AG22: weekday vs weekend availability."""
    ai = F.col("available").cast("int")
    wk = S.is_weekend(F.col("date"))
    agg = cal.groupBy(wk.alias("is_weekend")).agg(
        F.count(ai).alias("total_days"), F.sum(ai).cast("long").alias("available_days"),
        F.count_distinct("listing_id").alias("unique_listings"))
    rate = F.col("available_days") / F.col("total_days")
    return agg.select("*", rate.alias("availability_rate"), (1 - rate).alias("occupancy_rate"),
                      F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("label"))


def minimum_nights_monthly(cal: DataFrame, longstay: int = 28) -> DataFrame:
    """AG23: median/mean minimum nights and % long-stay per month (nulls skipped)."""
    mn = F.col("minimum_nights")
    monthly = cal.select(S.month_bucket(F.col("date")).alias("month"), "minimum_nights")
    agg = monthly.groupBy("month").agg(F.avg(mn).alias("mean_min_nights"),
                                       (F.avg((mn >= longstay).cast("int")) * 100).alias("pct_longstay"))
    return with_quantiles(agg, monthly, ["month"], {"median_min_nights": ("minimum_nights", 0.5)}).select(
        "month", "median_min_nights", "mean_min_nights", "pct_longstay")


def monthly_review_volume(rev: DataFrame) -> DataFrame:
    """AG24: reviews and active listings per month."""
    agg = rev.groupBy(S.month_bucket(F.col("date")).alias("month")).agg(
        F.count("id").alias("review_count"), F.count_distinct("listing_id").alias("active_listings"))
    return agg.withColumn("reviews_per_active_listing",
                          F.col("review_count") / F.col("active_listings"))


def temporal_summary(cal: DataFrame) -> DataFrame:
    """AG29 + J13 + SC21: monthly availability joined to monthly minimum nights."""
    a = monthly_availability(cal)
    m = minimum_nights_monthly(cal)
    return a.join(m, "month", "left").withColumn("season", S.season(F.col("month")))


def response_rate_summary(lm: DataFrame) -> DataFrame:
    """AG26: right-closed response-rate bins."""
    el = lm.where(F.col("host_response_rate").isNotNull())
    el = el.withColumn("response_rate_band", Bd.cut(F.col("host_response_rate"), Bd.RESPONSE_RATE_BINS))
    el = el.where(F.col("response_rate_band").isNotNull())
    agg = el.groupBy("response_rate_band").agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.avg(F.col("host_is_superhost").cast("double")).alias("superhost_rate"))
    return with_quantiles(agg, el, ["response_rate_band"], {
        "median_rating": ("review_scores_rating", 0.5), "median_price": ("price_numeric", 0.5),
        "median_occupancy": ("occupancy_proxy", 0.5)})


def correlation_matrix(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """AG27: Pearson correlations over complete rows, one aggregation pass."""
    comp = df.select(*cols).dropna()
    pairs = [(a, b) for a in cols for b in cols]
    wide = comp.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    short = {c: c.replace(prefix, "") for c in cols}
    rows = [F.struct(F.lit(short[a]).alias("dim_a"), F.lit(short[b]).alias("dim_b"),
                     F.col(f"`{a}|{b}`").alias("pearson_r")) for a, b in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def score_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG28: per score dimension n, nulls, mean, median, std, p10..p90, min, max."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    wide = _one_row(df.agg(*aggs), _column_quantiles(df, cols, probs))
    rows = []
    for i, c in enumerate(cols):
        q = [F.col(f"q{i}_{j}") for j in range(len(probs))]
        nulls = F.col("__rows") - F.col(f"n{i}")
        rows.append(F.struct(F.lit(c).alias("dimension"), F.col(f"n{i}").alias("n_rated"),
                             nulls.alias("null_count"), (nulls * 100.0 / F.col("__rows")).alias("null_pct"),
                             F.col(f"m{i}").alias("mean"), q[2].alias("median"),
                             F.col(f"s{i}").alias("std"), q[0].alias("p10"), q[1].alias("p25"),
                             q[3].alias("p75"), q[4].alias("p90"),
                             F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def market_concentration(lm: DataFrame, host: str = "host_id") -> DataFrame:
    """Hosts by listing count desc (host id breaks ties): share, cumulative share,
    host percentile. Range-partitioned running sum, no single-partition window."""
    hp = lm.groupBy(host).agg(F.count(F.lit(1)).alias("listing_count"))
    idx = ordered_index(hp, [F.col("listing_count").desc(), F.col(host)], rn_col="host_rank",
                        value_col="listing_count", cum_col="__cum", total_col="__hosts",
                        total_value_col="__listings")
    return idx.select(host, "listing_count", "host_rank",
                      (F.col("listing_count") / F.col("__listings")).alias("listing_share"),
                      (F.col("__cum") / F.col("__listings")).alias("cumulative_share"),
                      (F.col("host_rank") * 100.0 / F.col("__hosts")).alias("host_pct"))


def concentration_thresholds(lm: DataFrame, host: str = "host_id",
                             pcts: Sequence[float] = (0.01, 0.05, 0.10)) -> DataFrame:
    """AG46: share of listings held by the top 1/5/10 % of hosts (at least one host)."""
    mc = market_concentration(lm, host)
    aggs = []
    for p in pcts:
        k = F.greatest(F.lit(1), F.floor(F.col("__h") * F.lit(p)))
        aggs.append((F.sum(F.when(F.col("host_rank") <= k, F.col("listing_count")))
                     / F.sum("listing_count")).alias(f"top_{int(round(p * 100))}pct_share"))
    tot = mc.agg(F.max("host_rank").alias("__h")).withColumn("__one", F.lit(1))
    j = mc.withColumn("__one", F.lit(1)).join(F.broadcast(tot), "__one")
    return j.agg(*aggs)


def quantile_filter(lm: DataFrame, reviews: str = "number_of_reviews",
                    rating: str = "review_scores_rating", hi_q: float = 0.75,
                    lo_q: float = 0.25) -> DataFrame:
    """PF15: rows with reviews >= P75 and rating <= P25 (exact, distributed quantiles)."""
    hi = exact_quantile(lm, reviews, hi_q).select(F.col("q").alias("__hi"), F.lit(1).alias("__one"))
    lo = exact_quantile(lm, rating, lo_q).select(F.col("q").alias("__lo"), F.lit(1).alias("__one"))
    th = hi.join(lo, "__one")
    j = lm.withColumn("__one", F.lit(1)).join(F.broadcast(th), "__one")
    return j.where((F.col(reviews) >= F.col("__hi")) & (F.col(rating) <= F.col("__lo"))
                   & F.col(rating).isNotNull()).drop("__one", "__hi", "__lo")


def percentile_cap(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """PF16: keep rows with value <= the exact q-quantile."""
    th = exact_quantile(df, col, q).select(F.col("q").alias("__cap"), F.lit(1).alias("__one"))
    j = df.withColumn("__one", F.lit(1)).join(F.broadcast(th), "__one")
    return j.where(F.col(col) <= F.col("__cap")).drop("__one", "__cap")


def masked_group_median(df: DataFrame, group: str, value: str, min_n: int = 20) -> DataFrame:
    """AG30 + PF18: per-group median, null when the group has fewer than min_n values."""
    agg = with_quantiles(df.groupBy(group).agg(F.count(value).alias("n")), df, [group], {"median": (value, 0.5)})
    return agg.select(group, "n", F.when(F.col("n") >= min_n, F.col("median")).alias("median_masked"))


def histogram(df: DataFrame, col: str, bins: int = 60) -> DataFrame:
    """AG58: fixed-width histogram over [min, max]; empty bins kept (0). A constant column
    falls into the first bin, a column without values gives empty bins without bounds."""
    x = F.col(col)
    rng = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).withColumn("__one", F.lit(1))
    w = (F.col("hi") - F.col("lo")) / bins
    j = df.where(x.isNotNull()).withColumn("__one", F.lit(1)).join(F.broadcast(rng), "__one")
    b = F.least(F.coalesce(F.floor(F.try_divide(x - F.col("lo"), w)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = j.groupBy(F.coalesce(b, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = rng.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = all_bins.join(counts, "bin", "left")
    return out.select("bin", (F.col("lo") + F.col("bin") * w).alias("bin_start"),
                      (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_end"),
                      F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def city_comparison(lm: DataFrame, city: str = "city") -> DataFrame:
    """AG34 + AG36: KPIs per city (three superhost denominators kept apart)."""
    sh = F.col("host_is_superhost")
    agg = lm.groupBy(city).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_distinct("host_id").alias("hosts"),
        F.avg("review_scores_rating").alias("mean_rating"),
        F.avg(sh.cast("double")).alias("superhost_rate_nonnull"),
        (F.count_if(sh) / F.count(F.lit(1))).alias("superhost_rate_all_rows"),
        (F.count_if(F.col("availability_365") > 270) * 100.0 / F.count(F.lit(1))).alias("pct_avail_gt_270"),
        F.avg(F.when(F.col("room_type") == "entire_home", 1.0).otherwise(0.0)).alias("entire_home_share"),
        (F.count_if(F.col("is_professional_host")) / F.count(F.lit(1))).alias("professional_share"))
    return with_quantiles(agg, lm, [city], {
        "median_price": ("price_numeric", 0.5), "p25_price": ("price_numeric", 0.25), "p75_price": ("price_numeric", 0.75),
        "p95_price": ("price_numeric", 0.95), "median_occupancy": ("occupancy_proxy", 0.5)})


def relative_to_group_median(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """SC41: value / median(value) of its group (aggregate + join, skew-safe)."""
    med = exact_quantiles(df, [group], {"__med": (value, 0.5)})
    return df.join(med, group, "left").withColumn(out, S.safe_ratio(F.col(value), F.col("__med"))).drop("__med")


def top_values(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """T5: value counts, top n (ties broken by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc_nulls_last()).limit(n))
