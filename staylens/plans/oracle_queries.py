"""Final oracle SELECTs (DuckDB) keyed like ``staylens.plans.catalog.QUERIES``."""

from __future__ import annotations

from staylens.operators.bootstrap import poisson_steps
from staylens.plans.oracle import compose

ORACLES: dict[str, str] = {}


def oracle(name: str, needs: list[str], final: str) -> None:
    ORACLES[name] = compose(final, needs)


def rnd(cols: list[str], n: int = 6) -> str:
    return ", ".join(f"round({c}, {n}) AS {c}" for c in cols)


oracle("clean_listings", ["listings"], "SELECT * FROM listings")
oracle("rejected_listings", ["flagged_listings"],
       "SELECT id, latitude, longitude, price_numeric, rejection_reason FROM flagged_listings "
       "WHERE rejection_reason IS NOT NULL")
oracle("clean_calendar", ["calendar"], "SELECT * FROM calendar")
oracle("rejected_calendar", ["flagged_calendar"],
       "SELECT * FROM flagged_calendar WHERE rejection_reason IS NOT NULL")
oracle("clean_reviews", ["reviews"], "SELECT * FROM reviews")
oracle("rejected_reviews", ["flagged_reviews"],
       "SELECT * FROM flagged_reviews WHERE rejection_reason IS NOT NULL")
oracle("neighbourhoods_clean", ["neighbourhoods"],
       "SELECT neighbourhood, " + rnd(["centroid_latitude", "centroid_longitude", "area_km2"])
       + " FROM neighbourhoods")
oracle("calendar_summary", ["calendar_summary"],
       "SELECT * REPLACE (" + rnd(["availability_rate", "occupancy_proxy", "avg_minimum_nights",
                                   "avg_maximum_nights"]) + ") FROM calendar_summary")
oracle("review_summary", ["review_summary"],
       "SELECT * REPLACE (" + rnd(["avg_comment_length"]) + ") FROM review_summary")
oracle("neighbourhood_summary", ["neighbourhood_summary"],
       "SELECT * REPLACE (" + rnd(["median_price_gbp", "mean_price_gbp"], 2) + ", "
       + rnd(["price_null_share", "entire_home_share", "superhost_share", "avg_review_score",
              "avg_availability_365", "area_km2", "listings_per_km2"], 4)
       + ") FROM neighbourhood_summary")

_MASTER_COLS = ["id", "review_count_calc", "first_review_calc", "last_review_calc",
                "unique_reviewer_count", "review_count_l12m", "review_count_l30d",
                "avg_comment_length", "duplicate_comment_count", "calendar_days",
                "available_days", "unavailable_days", "availability_rate", "occupancy_proxy",
                "weekend_available_days", "weekday_available_days",
                "neighbourhood_listing_count", "neighbourhood_median_price_gbp",
                "neighbourhood_density_per_km2", "host_tenure_years", "price_per_bedroom_gbp",
                "reviews_per_month_calc", "host_portfolio_size", "is_professional_host",
                "revenue_proxy_gbp", "is_active_supply"]
_MASTER_DOUBLES = ["avg_comment_length", "availability_rate", "occupancy_proxy",
                   "neighbourhood_median_price_gbp", "neighbourhood_density_per_km2",
                   "host_tenure_years", "price_per_bedroom_gbp", "reviews_per_month_calc",
                   "revenue_proxy_gbp"]
oracle("listing_master", ["master"],
       "SELECT " + ", ".join(f"round({c}, 4) AS {c}" if c in _MASTER_DOUBLES else c
                             for c in _MASTER_COLS) + " FROM master")
oracle("listing_master_totals", ["master"], """
SELECT count(*) AS row_count,
  CAST(sum(CASE WHEN is_active_supply THEN 1 ELSE 0 END) AS BIGINT) AS active_listings,
  CAST(sum(CASE WHEN is_professional_host THEN 1 ELSE 0 END) AS BIGINT) AS professional_host_listings,
  round(quantile_cont(price_numeric, 0.5), 2) AS median_price_gbp,
  round(sum(revenue_proxy_gbp), 2) AS total_revenue_proxy_gbp,
  round(quantile_cont(occupancy_proxy, 0.5), 2) AS median_occupancy_proxy
FROM master""")

oracle("dim_city", [], """
SELECT row_number() OVER (ORDER BY city_name) AS city_key, * FROM (
  SELECT upper(substr(r_name, 1, 3)) AS city_code,
         r_name AS city_name,
         'GB' AS country_code, 'GBP' AS currency_code, 'Europe/London' AS timezone
  FROM region)""")
oracle("dim_neighbourhood", ["dim_neighbourhood"],
       "SELECT * REPLACE (" + rnd(["area_km2", "centroid_latitude", "centroid_longitude"])
       + ") FROM dim_neighbourhood")
oracle("dim_host", ["dim_host"], "SELECT * FROM dim_host")
oracle("dim_listing", ["dim_listing"], "SELECT * FROM dim_listing")
oracle("dim_date", ["dim_date"], "SELECT * FROM dim_date")
oracle("fact_calendar", ["fact_calendar"], "SELECT * FROM fact_calendar")
oracle("fact_reviews", ["fact_reviews"], "SELECT * FROM fact_reviews")
oracle("fact_listing_snapshot", ["fact_listing_snapshot"],
       "SELECT * REPLACE (" + rnd(["host_tenure_years", "price_per_bedroom_gbp",
                                   "reviews_per_month_calc", "revenue_proxy_gbp",
                                   "occupancy_proxy", "availability_rate"], 4)
       + ") FROM fact_listing_snapshot")

oracle("report_median_price_by_room_type", ["fact_listing_snapshot", "dim_listing"], """
SELECT dl.room_type, count(*) AS listing_count, count(fs.price_numeric) AS priced_listing_count,
  round(median(fs.price_numeric), 2) AS median_price_gbp,
  round(avg(fs.price_numeric), 2) AS mean_price_gbp,
  round(stddev_samp(fs.price_numeric), 2) AS std_price_gbp
FROM fact_listing_snapshot fs JOIN dim_listing dl USING (listing_key)
GROUP BY dl.room_type""")
oracle("report_top_neighbourhoods_by_listing_count", ["fact_listing_snapshot", "dim_neighbourhood"], """
SELECT dn.neighbourhood_name AS neighbourhood, count(*) AS listing_count,
  round(median(fs.price_numeric), 2) AS median_price_gbp,
  round(avg(fs.review_scores_rating), 3) AS avg_review_score,
  round(dn.area_km2, 2) AS area_km2,
  round(count(*) / NULLIF(dn.area_km2, 0), 1) AS listings_per_km2
FROM fact_listing_snapshot fs JOIN dim_neighbourhood dn USING (neighbourhood_key)
GROUP BY dn.neighbourhood_name, dn.area_km2
ORDER BY listing_count DESC, neighbourhood LIMIT 10""")
oracle("report_weekend_vs_weekday_availability", ["fact_calendar", "dim_date"], """
SELECT CASE WHEN dd.is_weekend THEN 'weekend' ELSE 'weekday' END AS day_segment,
  count(*) AS calendar_rows, CAST(sum(fc.available_int) AS BIGINT) AS available_rows,
  round(avg(fc.available_int) * 100, 2) AS availability_pct,
  round(avg(fc.minimum_nights), 2) AS avg_minimum_nights
FROM fact_calendar fc JOIN dim_date dd USING (date_key)
GROUP BY dd.is_weekend""")
oracle("report_occupancy_proxy_distribution", ["fact_listing_snapshot"], """
SELECT decile, count(*) AS listings,
  round(min(occupancy_proxy), 4) AS min_in_decile, round(max(occupancy_proxy), 4) AS max_in_decile,
  round(avg(occupancy_proxy), 4) AS mean_in_decile, round(avg(price_numeric), 2) AS mean_price_gbp,
  round(avg(revenue_proxy_gbp), 2) AS mean_revenue_proxy_gbp
FROM (SELECT occupancy_proxy, price_numeric, revenue_proxy_gbp,
             ntile(10) OVER (ORDER BY occupancy_proxy, listing_key) AS decile
      FROM fact_listing_snapshot WHERE occupancy_proxy IS NOT NULL)
GROUP BY decile""")
oracle("report_superhost_price_rating_gap", ["fact_listing_snapshot", "dim_host"], """
SELECT coalesce(CAST(dh.host_is_superhost AS VARCHAR), 'unknown') AS superhost_status,
  count(*) AS listing_count, round(median(fs.price_numeric), 2) AS median_price_gbp,
  round(avg(fs.price_numeric), 2) AS mean_price_gbp,
  round(avg(fs.review_scores_rating), 3) AS mean_review_score,
  round(avg(fs.occupancy_proxy), 4) AS mean_occupancy_proxy,
  round(avg(fs.host_tenure_years), 2) AS mean_host_tenure_years
FROM fact_listing_snapshot fs JOIN dim_host dh USING (host_key)
GROUP BY dh.host_is_superhost""")


# ---------------------------------------------------------------- EDA
def r4(cols):
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


oracle("eda_population_exclusion", ["lm"], """
SELECT * FROM (VALUES ('total', (SELECT count(*) FROM lm)),
  ('missing_price', (SELECT count(*) FROM lm WHERE price_numeric IS NULL)),
  ('negative_price', (SELECT count(*) FROM lm WHERE price_numeric < 0)),
  ('eligible', (SELECT count(*) FROM lm WHERE price_numeric >= 0))) t(population, listing_count)""")

_NUM = ["price_numeric", "availability_365", "number_of_reviews", "review_scores_rating",
        "review_scores_cleanliness", "review_scores_location", "host_tenure_years",
        "occupancy_proxy", "reviews_per_month_calc", "host_portfolio_size", "host_response_rate"]
_PCT = [(1, 0.01), (5, 0.05), (25, 0.25), (50, 0.5), (75, 0.75), (95, 0.95), (99, 0.99)]
oracle("eda_numeric_summary", ["lm"], "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean,
  round(stddev_samp({c}::DOUBLE), 4) AS std, round(min({c}::DOUBLE), 4) AS min, """
    + ", ".join(f"round(quantile_cont({c}::DOUBLE, {p}), 4) AS p{k:02d}" for k, p in _PCT)
    + f""", round(max({c}::DOUBLE), 4) AS max, count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) * 100.0 / count(*), 4) AS missing_pct FROM lm""" for c in _NUM))


def _price_group(group, src="eda", probs=(25, 75, 95)):
    qs = "".join(f", round(quantile_cont(price_numeric, {p / 100}), 4) AS p{p}" for p in probs)
    return (f"SELECT {group}, count(price_numeric) AS listing_count, "
            f"round(median(price_numeric), 4) AS median_price, "
            f"round(sum(price_numeric::DECIMAL(28,2))::DOUBLE / count(price_numeric), 4) AS mean_price"
            f"{qs} FROM {src} GROUP BY {group}")


oracle("eda_price_by_room_type", ["eda"], _price_group("room_type"))
oracle("eda_price_by_neighbourhood", ["eda", "lm"],
       f"SELECT * FROM ({_price_group('neighbourhood_cleansed', probs=())}) "
       "WHERE listing_count >= (SELECT greatest(10, floor(0.001 * count(*))) FROM lm)")
oracle("eda_price_by_neighbourhood_room_type", ["eda", "lm"],
       f"SELECT * FROM ({_price_group('neighbourhood_cleansed, room_type', probs=())}) "
       "WHERE listing_count >= (SELECT greatest(5, floor(0.0005 * count(*))) FROM lm)")


def _segment(seg, labels):
    arr = ", ".join(f"'{x}'" for x in labels)
    return f"""SELECT {seg}, count(*) AS listing_count, count(DISTINCT host_id) AS unique_hosts,
  round(median(price_numeric), 4) AS median_price, round(median(review_scores_rating), 4) AS median_rating,
  round(median(occupancy_proxy), 4) AS median_occupancy,
  round(median(availability_365), 4) AS median_availability,
  round(median(host_portfolio_size), 4) AS median_portfolio,
  round(avg(CAST(host_is_superhost AS DOUBLE)), 4) AS superhost_rate,
  CAST(list_position([{arr}], {seg}) AS INTEGER) AS segment_rank
FROM lm GROUP BY {seg}"""


oracle("eda_host_segment_summary", ["lm"], _segment("host_segment", ["solo", "multi", "professional"]))
oracle("eda_host_tenure_summary", ["lm"], _segment("tenure_band", [
    "New  (0-2 yr)", "Established  (2-5 yr)", "Experienced  (5-10 yr)", "Veteran  (10+ yr)"]))
oracle("eda_availability_band_summary", ["lm"], """
SELECT b.band, b.band_rank, coalesce(a.listing_count, 0) AS listing_count,
  round(coalesce(a.listing_count, 0) * 100.0 / (SELECT count(*) FROM lm), 4) AS share_pct,
  a.median_price, a.median_occupancy
FROM (VALUES ('Blocked / inactive  (0-30 d)', 1), ('Occasional  (31-90 d)', 2),
             ('Active  (91-270 d)', 3), ('Always-on  (271-365 d)', 4)) b(band, band_rank)
LEFT JOIN (SELECT avail_band AS band, count(*) AS listing_count,
                  round(median(price_numeric), 4) AS median_price,
                  round(median(occupancy_proxy), 4) AS median_occupancy
           FROM lm GROUP BY avail_band) a USING (band)""")
oracle("eda_neighbourhood_density", ["lm"], """
SELECT neighbourhood_cleansed AS neighbourhood, count(*) AS listing_count,
  count(DISTINCT host_id) AS unique_hosts, round(max(neighbourhood_density_per_km2), 4) AS listings_per_km2
FROM lm GROUP BY neighbourhood_cleansed""")
oracle("eda_price_by_distance_band", ["eda"], """
SELECT dist_band, count(price_numeric) AS listing_count, round(median(price_numeric), 4) AS median_price,
  round(sum(price_numeric::DECIMAL(28,2))::DOUBLE / count(price_numeric), 4) AS mean_price, round(quantile_cont(price_numeric, 0.75), 4) AS p75,
  CAST(list_position(['0-2 km', '2-5 km', '5-10 km', '10-20 km', '20+ km'], dist_band) AS INTEGER) AS band_rank
FROM (SELECT *, CASE WHEN d <= 2 THEN '0-2 km' WHEN d <= 5 THEN '2-5 km' WHEN d <= 10 THEN '5-10 km'
                     WHEN d <= 20 THEN '10-20 km' ELSE '20+ km' END AS dist_band
      FROM (SELECT *, 2 * 6371.0 * asin(sqrt(
              pow(sin((radians(51.508) - radians(latitude)) / 2), 2)
              + cos(radians(latitude)) * cos(radians(51.508))
                * pow(sin((radians(-0.1281) - radians(longitude)) / 2), 2))) AS d
            FROM eda WHERE latitude IS NOT NULL AND longitude IS NOT NULL))
GROUP BY dist_band""")


def _mix(group):
    types = ["entire_home", "hotel_room", "private_room", "shared_room"]
    return (f"SELECT {group}, " + ", ".join(
        f"round(count(*) FILTER (WHERE room_type = '{t}') * 100.0 / count(*), 4) AS {t}" for t in types)
        + f" FROM lm WHERE room_type IS NOT NULL AND {group} IS NOT NULL GROUP BY {group}")


oracle("eda_room_type_mix", ["lm"], _mix("neighbourhood_cleansed"))
oracle("eda_room_type_share_by_city", ["lm"], _mix("city"))
_MONTHLY = """SELECT date_trunc('month', date) AS month, count(available) AS total_days,
  CAST(sum(CAST(available AS INTEGER)) AS BIGINT) AS available_days,
  count(DISTINCT listing_id) AS unique_listings,
  round(sum(CAST(available AS INTEGER)) / count(available), 4) AS availability_rate,
  round(1 - sum(CAST(available AS INTEGER)) / count(available), 4) AS occupancy_rate
FROM calendar GROUP BY date_trunc('month', date)"""
oracle("eda_monthly_availability", ["calendar"], _MONTHLY)
oracle("eda_weekpart_availability", ["calendar"], """
SELECT dayofweek(date) IN (0, 6) AS is_weekend, count(available) AS total_days,
  CAST(sum(CAST(available AS INTEGER)) AS BIGINT) AS available_days,
  count(DISTINCT listing_id) AS unique_listings,
  round(sum(CAST(available AS INTEGER)) / count(available), 4) AS availability_rate,
  round(1 - sum(CAST(available AS INTEGER)) / count(available), 4) AS occupancy_rate,
  CASE WHEN dayofweek(date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS label
FROM calendar GROUP BY dayofweek(date) IN (0, 6)""")
_MINN = """SELECT date_trunc('month', date) AS month,
  round(median(minimum_nights), 4) AS median_min_nights, round(avg(minimum_nights), 4) AS mean_min_nights,
  round(avg(CAST(minimum_nights >= 28 AS INTEGER)) * 100, 4) AS pct_longstay
FROM calendar GROUP BY date_trunc('month', date)"""
oracle("eda_minimum_nights_monthly", ["calendar"], _MINN)
oracle("eda_monthly_review_volume", ["reviews"], """
SELECT date_trunc('month', date) AS month, count(id) AS review_count,
  count(DISTINCT listing_id) AS active_listings,
  round(count(id) / count(DISTINCT listing_id), 4) AS reviews_per_active_listing
FROM reviews GROUP BY date_trunc('month', date)""")
oracle("eda_temporal_summary", ["calendar"], f"""
SELECT a.*, m.median_min_nights, m.mean_min_nights, m.pct_longstay,
  CASE WHEN month(a.month) IN (12, 1, 2) THEN 'Winter' WHEN month(a.month) IN (3, 4, 5) THEN 'Spring'
       WHEN month(a.month) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
FROM ({_MONTHLY}) a LEFT JOIN ({_MINN}) m USING (month)""")
oracle("eda_response_rate_summary", ["lm"], """
SELECT response_rate_band, count(*) AS listing_count,
  round(avg(CAST(host_is_superhost AS DOUBLE)), 4) AS superhost_rate,
  round(median(review_scores_rating), 4) AS median_rating, round(median(price_numeric), 4) AS median_price,
  round(median(occupancy_proxy), 4) AS median_occupancy
FROM (SELECT *, CASE WHEN host_response_rate > -0.001 AND host_response_rate <= 0.5 THEN '0-50%'
                     WHEN host_response_rate > 0.5 AND host_response_rate <= 0.8 THEN '51-80%'
                     WHEN host_response_rate > 0.8 AND host_response_rate <= 0.95 THEN '81-95%'
                     WHEN host_response_rate > 0.95 AND host_response_rate <= 1.001 THEN '96-100%' END
                  AS response_rate_band
      FROM lm WHERE host_response_rate IS NOT NULL)
WHERE response_rate_band IS NOT NULL GROUP BY response_rate_band""")
_CORR = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location",
         "price_numeric", "availability_365", "number_of_reviews"]
oracle("eda_correlation_matrix", ["lm"], "\nUNION ALL\n".join(
    f"SELECT '{a.replace('review_scores_', '')}' AS dim_a, '{b.replace('review_scores_', '')}' AS dim_b, "
    f"round(corr({a}, {b}), 4) AS pearson_r FROM cc" for a in _CORR for b in _CORR).replace(
    "FROM cc", "FROM (SELECT " + ", ".join(_CORR) + " FROM lm WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _CORR) + ")"))
_SCORES = ["review_scores_rating", "review_scores_cleanliness", "review_scores_location",
           "number_of_reviews", "reviews_per_month_calc"]
oracle("eda_review_score_summary", ["lm"], "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS dimension, count({c}) AS n_rated, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, round(avg({c}::DOUBLE), 4) AS mean,
  round(median({c}::DOUBLE), 4) AS median, round(stddev_samp({c}::DOUBLE), 4) AS std,
  round(quantile_cont({c}::DOUBLE, 0.1), 4) AS p10, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
  round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, round(quantile_cont({c}::DOUBLE, 0.9), 4) AS p90,
  round(min({c}::DOUBLE), 4) AS min, round(max({c}::DOUBLE), 4) AS max FROM lm""" for c in _SCORES))
_MC = """SELECT host_id, listing_count,
  row_number() OVER (ORDER BY listing_count DESC, host_id) AS host_rank,
  listing_count / sum(listing_count) OVER () AS listing_share,
  sum(listing_count) OVER (ORDER BY listing_count DESC, host_id ROWS UNBOUNDED PRECEDING)
    / sum(listing_count) OVER () AS cumulative_share,
  row_number() OVER (ORDER BY listing_count DESC, host_id) * 100.0 / count(*) OVER () AS host_pct
FROM (SELECT host_id, count(*) AS listing_count FROM lm GROUP BY host_id)"""
oracle("eda_market_concentration", ["lm"],
       f"SELECT host_id, listing_count, host_rank, " + r4(["listing_share", "cumulative_share", "host_pct"])
       + f" FROM ({_MC})")
oracle("eda_concentration_thresholds", ["lm"], f"""
SELECT """ + ", ".join(
    f"round(sum(listing_count) FILTER (WHERE host_rank <= greatest(1, floor(h * {p})))"
    f" / sum(listing_count), 4) AS top_{k}pct_share" for k, p in [(1, 0.01), (5, 0.05), (10, 0.1)])
    + f" FROM (SELECT *, max(host_rank) OVER () AS h FROM ({_MC}))")
oracle("eda_high_review_low_score", ["lm"], """
SELECT id, neighbourhood_cleansed, room_type, property_type_bucket, round(price_numeric, 4) AS price_numeric,
  number_of_reviews, round(review_scores_rating, 4) AS review_scores_rating,
  round(review_scores_cleanliness, 4) AS review_scores_cleanliness, host_segment,
  round(host_response_rate, 4) AS host_response_rate
FROM lm WHERE number_of_reviews >= (SELECT quantile_cont(number_of_reviews, 0.75) FROM lm)
  AND review_scores_rating <= (SELECT quantile_cont(review_scores_rating, 0.25) FROM lm)
  AND review_scores_rating IS NOT NULL""")
oracle("eda_price_cap_p99", ["eda"], """
SELECT id, round(price_numeric, 4) AS price_numeric FROM eda
WHERE price_numeric <= (SELECT quantile_cont(price_numeric, 0.99) FROM eda)""")
oracle("eda_rating_by_neighbourhood_masked", ["lm"], """
SELECT neighbourhood_cleansed, count(review_scores_rating) AS n,
  round(CASE WHEN count(review_scores_rating) >= 20 THEN median(review_scores_rating) END, 4) AS median_masked
FROM lm GROUP BY neighbourhood_cleansed""")
oracle("eda_price_by_property_bucket", ["eda"], _price_group("property_type_bucket", probs=()))
oracle("eda_review_count_buckets", ["eda"], """
SELECT review_bucket, count(*) AS listing_count, round(median(price_numeric), 4) AS median_price,
  round(avg(review_scores_rating), 4) AS mean_rating
FROM (SELECT *, CASE WHEN number_of_reviews IS NULL THEN NULL WHEN number_of_reviews <= 0 THEN '0'
                     WHEN number_of_reviews <= 5 THEN '1-5' WHEN number_of_reviews <= 20 THEN '6-20'
                     WHEN number_of_reviews <= 100 THEN '21-100' ELSE '100+' END AS review_bucket FROM eda)
GROUP BY review_bucket""")
oracle("eda_city_comparison", ["lm"], """
SELECT city, count(*) AS listings, count(DISTINCT host_id) AS hosts,
  round(median(price_numeric), 4) AS median_price,
  round(quantile_cont(price_numeric, 0.25), 4) AS p25_price,
  round(quantile_cont(price_numeric, 0.75), 4) AS p75_price,
  round(quantile_cont(price_numeric, 0.95), 4) AS p95_price,
  round(avg(review_scores_rating), 4) AS mean_rating, round(median(occupancy_proxy), 4) AS median_occupancy,
  round(avg(CAST(host_is_superhost AS DOUBLE)), 4) AS superhost_rate_nonnull,
  round(count(*) FILTER (WHERE host_is_superhost) / count(*), 4) AS superhost_rate_all_rows,
  round(count(*) FILTER (WHERE availability_365 > 270) * 100.0 / count(*), 4) AS pct_avail_gt_270,
  round(avg(CASE WHEN room_type = 'entire_home' THEN 1.0 ELSE 0.0 END), 4) AS entire_home_share,
  round(count(*) FILTER (WHERE is_professional_host) / count(*), 4) AS professional_share
FROM lm GROUP BY city""")
oracle("eda_price_histogram", ["eda"], """
SELECT b.bin, round(r.lo + b.bin * (r.hi - r.lo) / 60, 4) AS bin_start,
  round(r.lo + (b.bin + 1) * (r.hi - r.lo) / 60, 4) AS bin_end, coalesce(c.n, 0) AS count
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(60)) b
CROSS JOIN (SELECT min(price_numeric) AS lo, max(price_numeric) AS hi FROM eda) r
LEFT JOIN (SELECT CAST(least(floor((price_numeric - lo) / ((hi - lo) / 60)), 59) AS INTEGER) AS bin,
                  count(*) AS n
           FROM eda, (SELECT min(price_numeric) AS lo, max(price_numeric) AS hi FROM eda) rr
           WHERE price_numeric IS NOT NULL GROUP BY 1) c USING (bin)""")
oracle("eda_price_relative_to_city_median", ["eda"], """
SELECT id, city, round(CASE WHEN m = 0 OR m IS NULL THEN NULL ELSE price_numeric / m END, 4) AS price_vs_city_median
FROM (SELECT *, median(price_numeric) OVER (PARTITION BY city) AS m FROM eda)""")
oracle("eda_top_neighbourhoods_value_counts", ["lm"], """
SELECT neighbourhood_cleansed, count(*) AS count FROM lm GROUP BY 1
ORDER BY count DESC, neighbourhood_cleansed NULLS LAST LIMIT 5""")


# ---------------------------------------------------------------- changes
oracle("snapshot_diff", ["snap_diff"], "SELECT * FROM snap_diff")
oracle("snapshot_diff_summary", ["snap_diff"], """
SELECT DATE '2000-01-01' AS old_snapshot, DATE '2002-01-01' AS new_snapshot,
  count(*) FILTER (WHERE change_type = 'new_listing') AS new_listings,
  count(*) FILTER (WHERE change_type = 'removed_listing') AS removed_listings,
  count(*) FILTER (WHERE change_type = 'price_change') AS price_changes,
  count(*) FILTER (WHERE change_type = 'status_change') AS status_changes,
  count(*) AS total_changes FROM snap_diff""")
oracle("snapshot_key_sets", ["snap_old", "snap_new"], """
SELECT 'added' AS key_set, id FROM (SELECT id FROM snap_new EXCEPT SELECT id FROM snap_old)
UNION ALL SELECT 'removed', id FROM (SELECT id FROM snap_old EXCEPT SELECT id FROM snap_new)
UNION ALL SELECT 'common', id FROM (SELECT id FROM snap_old INTERSECT SELECT id FROM snap_new)""")
# two snapshots: a version of the old one ends with the new one if its listing changed or left
oracle("scd2_listing_history", ["snap_old", "snap_new"], """
SELECT o.id, o.price_numeric, o.room_type, o.is_de_facto_inactive, o.snapshot_date AS valid_from,
  CASE WHEN n.id IS NULL OR (o.price_numeric, o.room_type, o.is_de_facto_inactive)
       IS DISTINCT FROM (n.price_numeric, n.room_type, n.is_de_facto_inactive) THEN d.day END AS valid_to,
  n.id IS NOT NULL AND (o.price_numeric, o.room_type, o.is_de_facto_inactive)
       IS NOT DISTINCT FROM (n.price_numeric, n.room_type, n.is_de_facto_inactive) AS is_current
FROM snap_old o LEFT JOIN snap_new n ON n.id = o.id, (SELECT max(snapshot_date) AS day FROM snap_new) d
UNION ALL
SELECT n.id, n.price_numeric, n.room_type, n.is_de_facto_inactive, n.snapshot_date, NULL, TRUE
FROM snap_new n LEFT JOIN snap_old o ON n.id = o.id
WHERE o.id IS NULL OR (o.price_numeric, o.room_type, o.is_de_facto_inactive)
  IS DISTINCT FROM (n.price_numeric, n.room_type, n.is_de_facto_inactive)""")
oracle("dataset_version_upsert", ["snap_old", "snap_new", "listings"], """
SELECT snapshot_date, row_count, 'bound' AS city FROM (
  SELECT DATE '2002-01-01' AS snapshot_date, (SELECT count(*) FROM snap_new) AS row_count
  UNION ALL SELECT DATE '2000-01-01', (SELECT count(*) FROM listings))""")

# ---------------------------------------------------------------- validation
_SUITE = [
    ("not_null", "id", None, None, 1.0, "count(*)", "count(*) FILTER (WHERE id IS NULL)"),
]


def _exp(idx, kind, col, el, un, mostly=1.0):
    return (f"SELECT {idx} AS idx, '{kind}' AS expectation, '{col}' AS \"column\", "
            f"CASE WHEN el > 0 THEN un / el <= {1.0 - mostly} + 1e-12 ELSE TRUE END AS success, "
            f"CAST(un AS VARCHAR) AS observed, el AS element_count, un AS unexpected_count, "
            f"round(CASE WHEN el > 0 THEN un * 100.0 / el ELSE 0.0 END, 4) AS unexpected_pct, "
            f"'listing_master' AS suite FROM (SELECT ({el}) AS el, CAST(({un}) AS BIGINT) AS un FROM master)"
            f" LIMIT 1")


def _nn(i, c):
    return _exp(i, "not_null", c, "count(*)", f"count(*) FILTER (WHERE {c} IS NULL)")


def _bt(i, c, lo, hi, mostly=1.0):
    cond = " AND ".join(x for x in [f"{c} >= {lo}" if lo is not None else "",
                                    f"{c} <= {hi}" if hi is not None else ""] if x)
    return _exp(i, "between", c, f"count({c})",
                f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({cond}))", mostly)


_master_suite = [
    "SELECT 0 AS idx, 'row_count_between' AS expectation, NULL::VARCHAR AS \"column\", "
    "count(*) BETWEEN 1000 AND 200000 AS success, CAST(count(*) AS VARCHAR) AS observed, "
    "count(*) AS element_count, 0::BIGINT AS unexpected_count, 0.0::DOUBLE AS unexpected_pct, "
    "'listing_master' AS suite FROM master",
    "SELECT 1, 'column_set', NULL, TRUE, 'all present', NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, 'listing_master'",
    "SELECT 2, 'column_exists', 'id', TRUE, 'present', NULL, NULL, NULL, 'listing_master'",
    _nn(3, "id"),
    _exp(4, "unique", "id", "count(id)",
         "(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM master WHERE id IS NOT NULL "
         "GROUP BY id HAVING count(*) > 1))"),
    _nn(5, "host_id"), _nn(6, "neighbourhood_cleansed"), _nn(7, "latitude"),
    _bt(8, "latitude", -90.0, 90.0), _nn(9, "room_type"),
    _exp(10, "in_set", "room_type", "count(room_type)",
         "count(*) FILTER (WHERE room_type IS NOT NULL AND room_type NOT IN "
         "('entire_home', 'private_room', 'shared_room', 'hotel_room'))"),
    _bt(11, "accommodates", 1, 100), _bt(12, "minimum_nights", 1, None, 0.99),
    _bt(13, "availability_365", 0, 365), _bt(14, "price_numeric", 0.01, 50000, 0.99),
    _bt(15, "review_scores_rating", 1.0, 5.0, 0.99), _nn(16, "is_de_facto_inactive"),
    _bt(17, "host_tenure_years", 0.0, 25.0, 0.99), _bt(18, "occupancy_proxy", 0.0, 1.0),
]
oracle("validation_listing_master", ["master"], "\nUNION ALL\n".join(f"({q})" for q in _master_suite))
oracle("validation_suite_summary", ["master", "calendar"], f"""
SELECT 'listing_master' AS suite, count(*) AS evaluated, count(*) FILTER (WHERE success) AS passed,
  count(*) FILTER (WHERE NOT success) AS failed
FROM ({" UNION ALL ".join(f"({q})" for q in _master_suite)})
UNION ALL
SELECT 'calendar_clean', 4,
  (count(*) FILTER (WHERE listing_id IS NULL) = 0)::INT + (count(*) FILTER (WHERE date IS NULL) = 0)::INT
  + (count(*) FILTER (WHERE minimum_nights < 1) <= 0.01 * count(minimum_nights) + 1e-12)::INT
  + (count(*) FILTER (WHERE available NOT IN (TRUE, FALSE)) = 0)::INT,
  4 - ((count(*) FILTER (WHERE listing_id IS NULL) = 0)::INT + (count(*) FILTER (WHERE date IS NULL) = 0)::INT
  + (count(*) FILTER (WHERE minimum_nights < 1) <= 0.01 * count(minimum_nights) + 1e-12)::INT
  + (count(*) FILTER (WHERE available NOT IN (TRUE, FALSE)) = 0)::INT)
FROM calendar""")
oracle("validation_warehouse_rules", ["dim_listing", "fact_calendar", "fact_reviews", "fact_listing_snapshot"], """
SELECT rule, violations::BIGINT AS violations,
  CASE WHEN regexp_matches(rule, 'unique') THEN 'uniqueness' WHEN regexp_matches(rule, '_not_null') THEN 'non_null'
       WHEN regexp_matches(rule, 'referential') THEN 'referential'
       WHEN regexp_matches(rule, '_in_range|bounds') THEN 'range' WHEN regexp_matches(rule, 'valid') THEN 'domain'
       WHEN regexp_matches(rule, 'matches') THEN 'shape' WHEN regexp_matches(rule, 'present') THEN 'shape'
       WHEN regexp_matches(rule, 'positive') THEN 'range' WHEN regexp_matches(rule, 'non_negative') THEN 'range'
       WHEN regexp_matches(rule, 'monotonic') THEN 'structural' WHEN regexp_matches(rule, 'zero_or_one') THEN 'domain'
       ELSE 'other' END AS category,
  violations = 0 AS passed
FROM (
  SELECT 'listing_key_not_null' AS rule, count(*) FILTER (WHERE listing_key IS NULL) AS violations FROM dim_listing
  UNION ALL SELECT 'listing_key_unique', coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM dim_listing
      GROUP BY listing_key HAVING count(*) > 1)
  UNION ALL SELECT 'calendar_referential_listing', count(*) FROM fact_calendar fc
      WHERE NOT EXISTS (SELECT 1 FROM dim_listing dl WHERE dl.listing_key = fc.listing_key)
  UNION ALL SELECT 'reviews_referential_listing', count(*) FROM fact_reviews fr
      WHERE NOT EXISTS (SELECT 1 FROM dim_listing dl WHERE dl.listing_key = fr.listing_key)
  UNION ALL SELECT 'calendar_available_int_zero_or_one', count(*) FILTER (WHERE available_int NOT IN (0, 1))
      FROM fact_calendar
  UNION ALL SELECT 'calendar_key_unique', coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM fact_calendar
      GROUP BY listing_key, date_key HAVING count(*) > 1)
  UNION ALL SELECT 'price_non_negative', count(*) FILTER (WHERE price_numeric < 0) FROM fact_listing_snapshot
  UNION ALL SELECT 'occupancy_in_range', count(*) FILTER (WHERE NOT (occupancy_proxy BETWEEN 0 AND 1))
      FROM fact_listing_snapshot
  UNION ALL SELECT 'snapshot_listing_parity',
      abs((SELECT count(*) FROM fact_listing_snapshot) - (SELECT count(*) FROM dim_listing)))""")
oracle("validation_date_dimension", ["dim_date"], """
SELECT count(*) AS rows, count(DISTINCT date_key) AS distinct_keys, min(date) AS min_date, max(date) AS max_date,
  date_diff('day', min(date), max(date)) + 1 = count(*) AS is_continuous FROM dim_date""")


# ---------------------------------------------------------------- profiling
_RAW_LISTING_COLS = ["id", "listing_url", "scrape_id", "name", "host_id", "host_name", "host_since",
                     "host_response_time", "host_response_rate", "host_acceptance_rate",
                     "host_is_superhost", "host_identity_verified", "neighbourhood_cleansed", "city",
                     "latitude", "longitude", "property_type", "room_type", "accommodates", "bathrooms",
                     "bathrooms_text", "bedrooms", "beds", "amenities", "price", "minimum_nights",
                     "maximum_nights", "has_availability", "availability_365", "number_of_reviews",
                     "last_scraped", "review_scores_rating", "review_scores_cleanliness",
                     "review_scores_location", "license", "instant_bookable",
                     "calculated_host_listings_count"]


def _profile_sql(cols, src, extra_select="", group=""):
    parts = []
    for c in cols:
        v = f"CAST({c} AS VARCHAR)"
        n = f"TRY_CAST({v} AS DOUBLE)"
        parts.append(
            f"SELECT {extra_select}'{c}' AS \"column\", 'string' AS dtype, count(*) AS rows, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 4) AS null_pct, "
            f"count(DISTINCT {v}) AS distinct_count, min({v}) AS min_text, max({v}) AS max_text, "
            f"round(min({n}), 4) AS min_num, round(max({n}), 4) AS max_num, round(avg({n}), 4) AS mean_num "
            f"FROM {src} {group}")
    return "\nUNION ALL\n".join(parts)


# Fields by completeness class; others are optional.
_FIELDS = {
    "listings": ("id host_id latitude longitude last_scraped neighbourhood_cleansed room_type",
                 "price property_type accommodates bedrooms beds minimum_nights maximum_nights host_is_superhost "
                 "host_since review_scores_rating amenities availability_365 number_of_reviews instant_bookable"),
    "calendar": ("listing_id date available", "minimum_nights maximum_nights"),
    "reviews": ("id listing_id date", "reviewer_id comments"),
}


def _field_class(source, column):
    critical, important = (x.split() for x in _FIELDS[source])
    return "'critical'" if column in critical else "'important'" if column in important else "'optional'"


def _field_sql(source, table, cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source, '{c}' AS \"column\", {_field_class(source, c)} AS completeness_class, count(*) AS rows, "
        f"count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct FROM {table}"
        for c in cols)


oracle("profile_field_completeness", ["raw_listings_full", "raw_calendar_full", "raw_reviews"], "\nUNION ALL\n".join([
    _field_sql("listings", "raw_listings_full", _RAW_LISTING_COLS),
    _field_sql("calendar", "raw_calendar_full", "listing_id date available price adjusted_price minimum_nights maximum_nights".split()),
    _field_sql("reviews", "raw_reviews", "listing_id id date reviewer_id reviewer_name comments".split())]))
oracle("profile_raw_listings", ["raw_listings_full"], _profile_sql(_RAW_LISTING_COLS, "raw_listings_full"))
oracle("profile_extended_listings", ["listings"], "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS non_null,
  count(DISTINCT {c}::DOUBLE) AS distinct_count, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q1,
  round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median, round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q3,
  round(stddev_samp({c}::DOUBLE), 4) AS std,
  round(count(DISTINCT {c}::DOUBLE) / count(*), 4) AS cardinality_ratio,
  CASE WHEN (count(*) - count({c})) * 100.0 / count(*) <= 0 THEN 'complete'
       WHEN (count(*) - count({c})) * 100.0 / count(*) <= 5 THEN 'mostly_complete'
       WHEN (count(*) - count({c})) * 100.0 / count(*) <= 30 THEN 'partial' ELSE 'sparse' END AS completeness,
  {_field_class("listings", c)} AS completeness_class
FROM listings""" for c in ["price_numeric", "availability_365", "review_scores_rating", "accommodates",
                           "bedrooms"]).replace(
    "count(DISTINCT price_numeric::DOUBLE) AS distinct_count,", "count(DISTINCT price_numeric::DOUBLE) AS distinct_count,"))
_TOPV = ["room_type", "property_type", "host_response_time", "bathrooms_text", "amenities",
         "city", "neighbourhood_cleansed", "has_availability", "instant_bookable", "host_is_superhost"]
oracle("profile_top_values", ["raw_listings"], """
SELECT "column", value, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank,
         count(*) OVER (PARTITION BY "column") AS nd
  FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM raw_listings "
    f"WHERE {c} IS NOT NULL GROUP BY 2" for c in _TOPV) + """))
WHERE nd <= 200 AND rank <= 5""")
_IQR = ["latitude", "longitude", "minimum_nights", "maximum_nights", "availability_365",
        "number_of_reviews", "accommodates", "bedrooms", "beds", "review_scores_rating"]


def _iqr(c):
    sent = c in ("maximum_nights",)
    num = f"TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)"
    val = f"CASE WHEN {num} >= 1073741824.0 THEN NULL ELSE {num} END" if sent else num
    sc = f"count(*) FILTER (WHERE {num} >= 1073741824.0)" if sent else "0"
    return f"""SELECT '{c}' AS "column", s.n AS non_null,
  round(CASE WHEN s.n >= 4 THEN s.q1 - 1.5 * (s.q3 - s.q1) END, 4) AS iqr_lower,
  round(CASE WHEN s.n >= 4 THEN s.q3 + 1.5 * (s.q3 - s.q1) END, 4) AS iqr_upper,
  count(*) FILTER (WHERE s.n >= 4 AND v < s.q1 - 1.5 * (s.q3 - s.q1)) AS low_outliers,
  count(*) FILTER (WHERE s.n >= 4 AND v > s.q3 + 1.5 * (s.q3 - s.q1)) AS high_outliers,
  s.sc AS sentinel_int_max_rows
FROM (SELECT {val} AS v FROM raw_listings) x,
     (SELECT quantile_cont({val}, 0.25) AS q1, quantile_cont({val}, 0.75) AS q3, count({val}) AS n,
             {sc} AS sc FROM raw_listings) s
GROUP BY s.n, s.q1, s.q3, s.sc"""


oracle("profile_iqr_outliers", ["raw_listings"], "\nUNION ALL\n".join(_iqr(c) for c in _IQR))


def _nb(c, lo, hi):
    return f"coalesce(NOT (TRY_CAST({c} AS DOUBLE) BETWEEN {lo} AND {hi}), TRUE)"


_PRICE = "TRY_CAST(regexp_replace(price, '[^0-9.\\-]', '', 'g') AS DOUBLE)"
_LRULES = [("price_negative", f"{_PRICE} < 0"), ("price_zero", f"{_PRICE} = 0"),
           ("latitude_out_of_range", _nb("latitude", -90, 90)),
           ("longitude_out_of_range", _nb("longitude", -180, 180)),
           ("latitude_outside_city_bbox", _nb("latitude", 51.2, 51.8)),
           ("longitude_outside_city_bbox", _nb("longitude", -0.55, 0.35)),
           ("minimum_nights_le_zero", "TRY_CAST(minimum_nights AS DOUBLE) <= 0"),
           ("minimum_nights_ge_365", "TRY_CAST(minimum_nights AS DOUBLE) >= 365"),
           ("maximum_nights_int_max_sentinel", "TRY_CAST(maximum_nights AS DOUBLE) >= 1073741824"),
           ("availability_365_out_of_range", _nb("availability_365", 0, 365)),
           ("number_of_reviews_negative", "TRY_CAST(number_of_reviews AS DOUBLE) < 0"),
           ("accommodates_le_zero", "TRY_CAST(accommodates AS DOUBLE) <= 0"),
           ("bedrooms_negative", "TRY_CAST(bedrooms AS DOUBLE) < 0"),
           ("beds_negative", "TRY_CAST(beds AS DOUBLE) < 0")]
_CRULES = [("available_not_in_t_f", "coalesce(NOT (available IN ('t', 'f')), TRUE)"),
           ("minimum_nights_le_zero", "TRY_CAST(minimum_nights AS DOUBLE) <= 0"),
           ("minimum_nights_ge_365", "TRY_CAST(minimum_nights AS DOUBLE) >= 365"),
           ("maximum_nights_int_max_sentinel", "TRY_CAST(maximum_nights AS DOUBLE) >= 1073741824")]
oracle("profile_domain_rules", ["raw_listings", "raw_calendar"], "\nUNION ALL\n".join(
    [f"SELECT 'listings' AS source_file, '{n}' AS rule, count(*) FILTER (WHERE {c}) AS violation_count "
     f"FROM raw_listings" for n, c in _LRULES]
    + [f"SELECT 'calendar', '{n}', count(*) FILTER (WHERE {c}) FROM raw_calendar" for n, c in _CRULES]))
oracle("profile_key_integrity", ["typed_listings", "flagged_calendar", "flagged_reviews"], """
SELECT * FROM (VALUES
 ('listings_rows', (SELECT count(*) FROM typed_listings)::DOUBLE),
 ('listings_id_nulls', (SELECT count(*) FILTER (WHERE id IS NULL) FROM typed_listings)::DOUBLE),
 ('listings_id_distinct', (SELECT count(DISTINCT id) FROM typed_listings)::DOUBLE),
 ('listings_id_duplicate_rows', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM typed_listings
     GROUP BY id HAVING count(*) > 1))::DOUBLE),
 ('calendar_key_duplicate_rows', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM flagged_calendar
     GROUP BY listing_id, date HAVING count(*) > 1))::DOUBLE),
 ('calendar_orphan_rows', (SELECT count(*) FROM flagged_calendar
     WHERE listing_id IS NULL OR listing_id NOT IN (SELECT id FROM typed_listings WHERE id IS NOT NULL))::DOUBLE),
 ('reviews_orphan_rows', (SELECT count(*) FROM flagged_reviews
     WHERE listing_id IS NULL OR listing_id NOT IN (SELECT id FROM typed_listings WHERE id IS NOT NULL))::DOUBLE),
 ('reviews_id_duplicate_rows', (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM flagged_reviews
     GROUP BY id HAVING count(*) > 1))::DOUBLE),
 ('listings_without_calendar', (SELECT count(DISTINCT id) FROM typed_listings WHERE id IS NOT NULL AND id NOT IN
     (SELECT listing_id FROM flagged_calendar WHERE listing_id IS NOT NULL))::DOUBLE)) t("check", value)""")
oracle("profile_exact_duplicates", ["raw_calendar_full", "raw_reviews"], """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_calendar_full)) AS distinct_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_calendar_full)) AS duplicate_rows,
  'calendar' AS source FROM raw_calendar_full
UNION ALL
SELECT count(*), (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_reviews)),
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_reviews)), 'reviews' FROM raw_reviews""")


def _templates(src, col):
    return (f"(SELECT lower(trim(coalesce({col}, ''))) AS norm, count(*) AS occurrences FROM {src} GROUP BY 1)")


oracle("document_text_templates_summary", [], f"""
SELECT CAST(coalesce(sum(occurrences) FILTER (WHERE occurrences > 1), 0) AS BIGINT) AS duplicate_text_rows,
  count(*) FILTER (WHERE occurrences > 1) AS distinct_template_count FROM {_templates('documents', 'text')}""")
oracle("document_text_templates_top", [], f"""
SELECT occurrences, substr(norm, 1, 100) AS preview FROM {_templates('documents', 'text')}
ORDER BY occurrences DESC, norm LIMIT 20""")
oracle("review_comment_templates_summary", ["raw_reviews"], f"""
SELECT CAST(coalesce(sum(occurrences) FILTER (WHERE occurrences > 1), 0) AS BIGINT) AS duplicate_text_rows,
  count(*) FILTER (WHERE occurrences > 1) AS distinct_template_count FROM {_templates('raw_reviews', 'comments')}""")
_NORM = "regexp_replace(lower(trim(coalesce({0}, ''))), '\\s+', ' ', 'g')"
oracle("listing_duplicate_blocks", ["listings"], f"""
SELECT block_size, id, host_id, neighbourhood_cleansed, name FROM (
  SELECT *, count(*) OVER (PARTITION BY neighbourhood_cleansed, host_id, round(latitude, 3),
                                        round(longitude, 3), {_NORM.format('name')}) AS block_size
  FROM listings WHERE {_NORM.format('name')} <> '') WHERE block_size > 1""")
oracle("document_duplicate_blocks", [], f"""
SELECT block_size, doc_id, lang, source FROM (
  SELECT *, count(*) OVER (PARTITION BY lang, {_NORM.format('text')}) AS block_size
  FROM documents WHERE {_NORM.format('text')} <> '') WHERE block_size > 1""")
_SC = ["price_numeric", "host_response_rate", "bedrooms", "review_scores_rating", "bathroom_count",
       "host_is_superhost", "room_type"]
_SCT = {"price_numeric": "double", "host_response_rate": "double", "bedrooms": "double",
        "review_scores_rating": "double", "bathroom_count": "double", "host_is_superhost": "boolean",
        "room_type": "string"}


def _np(city):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS col, '{_SCT[c]}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS np "
        f"FROM listings WHERE city = '{city}'" for c in _SC)


oracle("schema_compare_cities", ["listings"], f"""
SELECT coalesce(a.col, b.col) AS "column",
  CASE WHEN a.col IS NOT NULL AND b.col IS NOT NULL THEN 'both' WHEN a.col IS NOT NULL THEN 'only_a' ELSE 'only_b' END
    AS presence,
  a.dtype AS dtype_a, b.dtype AS dtype_b, round(a.np, 4) AS null_pct_a, round(b.np, 4) AS null_pct_b,
  abs(a.np - b.np) > 10 AS null_rate_drift, a.dtype <> b.dtype AS dtype_mismatch
FROM ({_np('AFRICA')}) a FULL JOIN ({_np('AMERICA')}) b ON a.col = b.col""")
oracle("neighbourhood_name_parity", [], """
SELECT 'only_a' AS side, name FROM (SELECT trim(n_name || ' ') AS name FROM nation
  EXCEPT ALL SELECT trim(n_name) FROM nation)
UNION ALL SELECT 'only_b', name FROM (SELECT trim(n_name) AS name FROM nation
  EXCEPT ALL SELECT trim(n_name || ' ') FROM nation)""")
oracle("sample_listings_first_2000", ["listings"], """
SELECT id, host_id, round(price_numeric, 4) AS price_numeric FROM listings ORDER BY id LIMIT 2000""")
oracle("profile_completeness_rollup", ["raw_listings_full", "raw_calendar_full", "raw_reviews"], """
SELECT source, count(*) AS columns, count(*) FILTER (WHERE null_count = 0) AS full_columns,
  count(*) FILTER (WHERE null_count > 0 AND null_count < rows) AS partial_columns,
  count(*) FILTER (WHERE null_count = rows) AS fully_null_columns,
  count(*) FILTER (WHERE null_count * 100.0 / rows >= 30) AS columns_ge_30pct_null
FROM (SELECT 'listings' AS source, UNNEST(map_values(m)) AS null_count, rows FROM (
        SELECT count(*) AS rows, MAP {""" + ", ".join(
    f"'{c}': count(*) FILTER (WHERE {c} IS NULL)" for c in _RAW_LISTING_COLS) + """} AS m FROM raw_listings_full)
      UNION ALL
      SELECT 'calendar', UNNEST([count(*) FILTER (WHERE listing_id IS NULL), count(*) FILTER (WHERE date IS NULL),
        count(*) FILTER (WHERE available IS NULL), count(*) FILTER (WHERE price IS NULL),
        count(*) FILTER (WHERE adjusted_price IS NULL), count(*) FILTER (WHERE minimum_nights IS NULL),
        count(*) FILTER (WHERE maximum_nights IS NULL)]), count(*) FROM raw_calendar_full
      UNION ALL
      SELECT 'reviews', UNNEST([count(*) FILTER (WHERE listing_id IS NULL), count(*) FILTER (WHERE id IS NULL),
        count(*) FILTER (WHERE date IS NULL), count(*) FILTER (WHERE reviewer_id IS NULL),
        count(*) FILTER (WHERE reviewer_name IS NULL), count(*) FILTER (WHERE comments IS NULL)]), count(*)
      FROM raw_reviews)
GROUP BY source""")


# ---------------------------------------------------------------- statistics
def _welch(src, cond, a, b):
    return f"""SELECT '{a}' AS group_a, '{b}' AS group_b, n1, n2, round(m1, 4) AS m1, round(m2, 4) AS m2,
  round(v1, 4) AS v1, round(v2, 4) AS v2, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 4) AS statistic,
  round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS dof,
  round((m1 - m2) / sqrt((v1 + v2) / 2), 4) AS effect_size, round(m1 - m2, 4) AS mean_diff,
  round(sqrt(v1 / n1 + v2 / n2), 4) AS se_diff
FROM (SELECT count(x) FILTER (WHERE g) AS n1, avg(x) FILTER (WHERE g) AS m1, var_samp(x) FILTER (WHERE g) AS v1,
             count(x) FILTER (WHERE NOT g) AS n2, avg(x) FILTER (WHERE NOT g) AS m2,
             var_samp(x) FILTER (WHERE NOT g) AS v2
      FROM (SELECT ln(1 + price_numeric) AS x, {cond} AS g FROM {src}) WHERE x IS NOT NULL AND g IS NOT NULL)"""


oracle("stats_welch_room_type_log_price", ["eda"], _welch(
    "eda WHERE room_type IN ('entire_home', 'private_room')", "room_type = 'entire_home'",
    "entire_home", "private_room"))
oracle("stats_welch_review_count_log_price", ["eda"], _welch(
    "eda WHERE number_of_reviews IS NOT NULL", "number_of_reviews > 10", "high_review", "low_review"))
oracle("stats_mann_whitney_superhost_rating", ["lm"], """
SELECT n1, n2, round(u, 4) AS statistic,
  round((abs(u - n1 * n2 / 2) - 0.5) / sqrt(n1 * n2 / 12 * ((n + 1) - tie / (n * (n - 1)))), 4) AS z,
  round(2 * u / (n1 * n2) - 1, 4) AS effect_size
FROM (SELECT count(*) FILTER (WHERE g) AS n1, count(*) FILTER (WHERE NOT g) AS n2, count(*)::DOUBLE AS n,
             sum(r) FILTER (WHERE g) - count(*) FILTER (WHERE g) * (count(*) FILTER (WHERE g) + 1) / 2 AS u,
             (SELECT sum(pow(t, 3) - t) FROM (SELECT count(*)::DOUBLE AS t FROM lm
                WHERE review_scores_rating IS NOT NULL AND host_is_superhost IS NOT NULL
                GROUP BY review_scores_rating)) AS tie
      FROM (SELECT host_is_superhost AS g,
                   (rank() OVER (ORDER BY review_scores_rating)
                    + count(*) OVER (PARTITION BY review_scores_rating) - 1
                    + rank() OVER (ORDER BY review_scores_rating)) / 2.0 AS r
            FROM lm WHERE review_scores_rating IS NOT NULL AND host_is_superhost IS NOT NULL))""")


def _bootstrap(source: str, value: str, group: str, replicates: int) -> str:
    """Keyed Poisson draws, a row per replicate."""
    u = "(('0x' || substr({0}, 1 + 8 * CAST(rep % 8 AS INT), 8))::BIGINT)"
    steps = "[" + ", ".join(map(str, poisson_steps())) + "]"
    return f"""
SELECT * FROM (WITH base AS (SELECT CAST({value} AS DOUBLE) AS x, CAST({group} AS INT) AS g FROM {source}
  WHERE {value} IS NOT NULL AND {group} IS NOT NULL),
counts AS (SELECT g, x, count(*) AS c, CAST(CAST(x AS DECIMAL(38,9)) AS VARCHAR) AS name FROM base GROUP BY g, x),
copies AS (SELECT *, unnest(CASE WHEN c <= 30 THEN range(0, c) ELSE [-1] END) AS copy FROM counts),
digests AS (SELECT g, x, c, copy, block, sha256('42|' || g || '|' || name || '|' || copy || '|' || block) AS one,
    CASE WHEN copy < 0 THEN sha256('42|' || g || '|' || name || '|' || copy || '|' || block || '|b') END AS other
  FROM copies, range(0, {-(-replicates // 8)}) t(block)),
draws AS (SELECT g, x, c, copy, block * 8 + k AS rep, one, other FROM digests, range(0, 8) s(k)),
weights AS (SELECT rep, g, x, CASE WHEN copy >= 0 THEN len(list_filter({steps}, lambda t: t <= {u.format("one")}))
    ELSE greatest(0, floor(c + sqrt(c) * sqrt(-2 * ln(({u.format("one")} + 0.5) / 4294967296.0))
      * cos(2 * pi() * (({u.format("other")} + 0.5) / 4294967296.0)) + 0.5)) END AS w FROM draws WHERE rep < {replicates}),
means AS (SELECT rep, g, sum(w * x) / nullif(sum(w), 0) AS m FROM weights GROUP BY rep, g),
diffs AS (SELECT max(m) FILTER (WHERE g = 1) - max(m) FILTER (WHERE g = 0) AS d FROM means GROUP BY rep)
SELECT (SELECT round(avg(x) FILTER (WHERE g = 1) - avg(x) FILTER (WHERE g = 0), 4) FROM base) AS mean_diff,
  round(quantile_cont(d, 0.025), 4) AS ci_low, round(quantile_cont(d, 0.975), 4) AS ci_high, count(d) AS replicates FROM diffs)"""


oracle("stats_bootstrap_superhost_price", ["eda"], _bootstrap("eda", "price_numeric", "host_is_superhost", 2000))
oracle("stats_kruskal_neighbourhood_price", ["eda"], """
SELECT CAST(n AS BIGINT) AS n_total, k AS groups, round(h, 4) AS statistic, round((h - k + 1) / (n - k), 4) AS effect_size
FROM (SELECT n, k, (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - tie / (pow(n, 3) - n)) AS h
      FROM (SELECT sum(rs * rs / c) AS s, count(*) AS k, sum(c)::DOUBLE AS n, max(tie) AS tie FROM (
              SELECT nb, sum(r) AS rs, count(*) AS c,
                     (SELECT sum(pow(t, 3) - t) FROM (SELECT count(*)::DOUBLE AS t FROM kw GROUP BY price_numeric)) AS tie
              FROM (SELECT neighbourhood_cleansed AS nb, (2 * rank() OVER (ORDER BY price_numeric)
                           + count(*) OVER (PARTITION BY price_numeric) - 1) / 2.0 AS r FROM kw)
              GROUP BY nb)))""".replace("kw", "(SELECT * FROM eda WHERE neighbourhood_cleansed IN ("
    "SELECT neighbourhood_cleansed FROM eda GROUP BY 1 HAVING count(price_numeric) >= "
    "(SELECT greatest(30, floor(count(*) * 0.001)) FROM eda)))"))
oracle("stats_weekend_availability_diff", ["calendar"], """
SELECT n_total, round(we, 4) AS weekend_rate, round(wd, 4) AS weekday_rate, round(we - wd, 4) AS statistic,
  abs(we - wd) > 0.01 AS significant
FROM (SELECT count(available) AS n_total,
        sum(CAST(available AS INT)) FILTER (WHERE dayofweek(date) IN (0, 6))
          / count(available) FILTER (WHERE dayofweek(date) IN (0, 6)) AS we,
        sum(CAST(available AS INT)) FILTER (WHERE dayofweek(date) NOT IN (0, 6))
          / count(available) FILTER (WHERE dayofweek(date) NOT IN (0, 6)) AS wd FROM calendar)""")
_WP = """SELECT listing_id, avg(CAST(available AS DOUBLE)) FILTER (WHERE dayofweek(date) NOT IN (0, 6)) AS weekday_rate,
  avg(CAST(available AS DOUBLE)) FILTER (WHERE dayofweek(date) IN (0, 6)) AS weekend_rate
FROM calendar GROUP BY listing_id"""
oracle("calendar_listing_weekpart_pivot", ["calendar"], f"""
SELECT listing_id, round(weekday_rate, 4) AS weekday_rate, round(weekend_rate, 4) AS weekend_rate,
  round(weekend_rate - weekday_rate, 4) AS diff FROM ({_WP})""")
oracle("stats_wilcoxon_weekend_weekday", ["calendar"], f"""
SELECT n, n_pairs, round(w, 4) AS statistic,
  round((w - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - tie / 48), 4) AS z,
  round(md / sd, 4) AS effect_size, round(md, 4) AS mean_diff
FROM (SELECT count(*) FILTER (WHERE d <> 0) AS n,
        sum(r) FILTER (WHERE d > 0) AS w,
        (SELECT sum(pow(t, 3) - t) FROM (SELECT count(*)::DOUBLE AS t FROM ({_WP}) WHERE weekend_rate - weekday_rate <> 0
           GROUP BY abs(weekend_rate - weekday_rate))) AS tie,
        (SELECT count(*) FROM ({_WP}) WHERE weekend_rate - weekday_rate IS NOT NULL) AS n_pairs,
        (SELECT avg(weekend_rate - weekday_rate) FROM ({_WP})) AS md,
        (SELECT stddev_samp(weekend_rate - weekday_rate) FROM ({_WP})) AS sd
      FROM (SELECT d, (2 * rank() OVER (ORDER BY abs(d)) + count(*) OVER (PARTITION BY abs(d)) - 1) / 2.0 AS r
            FROM (SELECT weekend_rate - weekday_rate AS d FROM ({_WP})) WHERE d IS NOT NULL AND d <> 0))""")


# ---------------------------------------------------------------- CDC
oracle("cdc_scd2_history", ["cdc_history"], "SELECT * FROM cdc_history")
oracle("cdc_dead_letters", [], """
SELECT o_orderkey AS listing_id, o_orderkey * 10 + 4 AS lsn, 'u' AS op, 'update' AS action,
  'invalid_price_numeric' AS failure_reason
FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'""")
oracle("cdc_dead_letter_alarm", [], """
SELECT count(*) AS depth, count(*) > 100 AS alarm FROM orders
WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'""")
# an event of order k at place p of its list arrives in batch (k + p) % 3; batch 0 comes twice
_PLACED = """SELECT k, kind, row_number() OVER (PARTITION BY k ORDER BY kind) - 1 AS place FROM (
  SELECT o_orderkey AS k, unnest(list_filter([1, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 2 END,
    CASE WHEN o_orderstatus = 'O' THEN 3 END, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 4 END,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 5 END], lambda x: x IS NOT NULL)) AS kind FROM orders)"""
oracle("cdc_conservation", ["cdc_history"], f"""
SELECT n + again AS events_in, n - twice - bad AS applied, twice + again - bad_again AS duplicate, bad + bad_again AS dead,
  (SELECT count(*) FROM cdc_history) AS versions, bad + bad_again AS dead_letters
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE (k + place) % 3 = 0) AS again, count(*) FILTER (WHERE kind = 2) AS twice,
  count(*) FILTER (WHERE kind = 5) AS bad, count(*) FILTER (WHERE kind = 5 AND (k + place) % 3 = 0) AS bad_again FROM ({_PLACED}))""")
oracle("cdc_progress", ["cdc_events"], "SELECT 'listings' AS source_table, max(lsn) AS last_lsn FROM cdc_events")
oracle("cdc_two_tables_compacted", ["cdc_history"], """
SELECT t AS source_table, h.*, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS conflicts,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED') AS malformed
FROM (VALUES ('listings'), ('hosts')) v(t), (SELECT count(*) AS versions, count(*) FILTER (WHERE is_current) AS current_versions,
  CAST(sum(lsn) AS BIGINT) AS lsn_sum, CAST(sum(CAST(round(price_numeric * 100) AS BIGINT)) AS BIGINT) AS price_cents FROM cdc_history) h""")
oracle("cdc_reconciliation", ["cdc_history"], """
SELECT count(*) AS snapshot_rows, count(*) AS stream_rows, count(*) AS matched_rows, 0::BIGINT AS mismatched_rows
FROM cdc_history WHERE is_current AND NOT is_deleted""")
oracle("calendar_upsert_last_lsn", ["calendar"], """
SELECT listing_id, date, available, minimum_nights FROM calendar
WHERE (listing_id, date) NOT IN (SELECT (l_orderkey, CAST(l_shipdate AS DATE)) FROM lineitem)
UNION ALL
SELECT listing_id, date, max_by(available, o) AS available, max_by(minimum_nights, o) AS minimum_nights FROM (
  SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date, l_linestatus = 'O' AS available,
         CAST(l_quantity AS BIGINT) AS minimum_nights,
         (l_linenumber, l_linestatus = 'O', CAST(l_quantity AS BIGINT)) AS o
  FROM lineitem) GROUP BY 1, 2""")


# ---------------------------------------------------------------- features
_AMEN = [("wifi", "has_wifi"), ("kitchen", "has_kitchen"), ("air conditioning", "has_air_conditioning"),
         ("washer", "has_washer"), ("parking", "has_parking"), ("pool", "has_pool"),
         ("dedicated workspace", "has_workspace"), ("gym", "has_gym"), ("elevator", "has_elevator"),
         ("tv", "has_tv"), ("bathtub", "has_bathtub"), ("dishwasher", "has_dishwasher")]
_FNUM = ["accommodates", "bedrooms", "beds", "bathroom_count", "minimum_nights", "host_tenure_years",
         "host_response_rate", "latitude", "longitude", "availability_365", "review_scores_rating",
         "review_scores_cleanliness", "review_scores_location", "reviews_per_month_calc",
         "calculated_host_listings_count", "number_of_reviews"]
_FDBL = {"bedrooms", "beds", "bathroom_count", "host_tenure_years", "host_response_rate", "latitude",
         "longitude", "review_scores_rating", "review_scores_cleanliness", "review_scores_location",
         "reviews_per_month_calc"}
_ARR = ("CASE WHEN json_valid(amenities) AND json_type(amenities) = 'ARRAY' "
        "THEN list_transform(CAST(json_extract_string(amenities, '$[*]') AS VARCHAR[]), lambda x: lower(x)) "
        "ELSE []::VARCHAR[] END")


def _bin(c):
    return f"coalesce(CAST({c} AS INTEGER), 0) AS {c}"


oracle("features_listing_matrix", ["master"], "SELECT id, host_id, " + ", ".join(
    f"round({c}, 4) AS {c}" if c in _FDBL else c for c in _FNUM)
    + ", round(CASE WHEN accommodates IS NULL OR accommodates = 0 THEN NULL ELSE beds / accommodates END, 4)"
      " AS beds_per_guest, "
    + ", ".join(_bin(c) for c in ["host_is_superhost", "instant_bookable", "bathroom_is_shared"])
    + ", room_type, neighbourhood_cleansed, property_type_bucket, "
    + ", ".join(f"CAST(len(list_filter(arr, lambda x: contains(x, '{kw}'))) > 0 AS INTEGER) AS {n}" for kw, n in _AMEN)
    + ", len(arr) AS amenity_count, round(ln(1 + price_numeric), 4) AS log_price, round(price_numeric, 4) AS price_numeric"
    + f" FROM (SELECT *, {_ARR} AS arr FROM master WHERE price_numeric IS NOT NULL AND price_numeric > 0)")
_HF = ["listing_count", "host_tenure_years", "host_response_rate", "host_acceptance_rate",
       "host_is_superhost", "avg_price", "avg_availability_365", "avg_review_scores_rating",
       "avg_reviews_per_month", "avg_accommodates", "avg_minimum_nights", "pct_entire_home",
       "neighbourhood_count"]
oracle("features_host", ["host_agg"], "SELECT host_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT median({c}) FROM host_agg))"
    + (" + 1e-9" if c in ("avg_price", "avg_review_scores_rating") else "") + f", 4) AS {c}" for c in _HF)
    + " FROM host_agg")
_CLUSTER_INPUTS = ["log_price", "accommodates", "bedrooms", "minimum_nights", "availability_365", "review_scores_rating",
                   "reviews_per_month_calc", "distance_to_centre_km", "amenity_count"]
_IMPUTED = "SELECT id, room_type, neighbourhood_cleansed, price_numeric, " + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM clust_feat)) AS {c}" for c in _CLUSTER_INPUTS) + " FROM clust_feat"
oracle("features_clustering", ["clust_feat"], "SELECT id, room_type, neighbourhood_cleansed, round(price_numeric, 4) AS price_numeric, "
       + ", ".join(f"round({c}, 4) AS {c}" for c in _CLUSTER_INPUTS) + f" FROM ({_IMPUTED})")
oracle("segments_listing_profile_of_labels", ["clust_feat"], f"""
SELECT *, row_number() OVER (ORDER BY median_price, cluster) AS price_rank FROM (
SELECT CAST(id % 6 AS INTEGER) AS cluster, count(*) AS size, round(count(*) * 100.0 / (SELECT count(*) FROM clust_feat), 4) AS pct_of_city,
  round(median(price_numeric), 4) AS median_price, round(median(minimum_nights), 4) AS median_minimum_nights,
  round(avg(amenity_count), 4) AS mean_amenity_count, round(avg(distance_to_centre_km), 4) AS mean_distance_km,
  """ + ", ".join(f"round(avg(CAST(room_type = '{r}' AS DOUBLE)) * 100, 4) AS pct_{r}" for r in (
      "entire_home", "private_room", "shared_room", "hotel_room")) + f"""
FROM ({_IMPUTED}) GROUP BY 1)""")
_SPLIT = "(((host_id % 2147483648) * 2654435761 + 42) % 4294967296) % 100 < 20"
oracle("model_group_split", ["master"], f"""
SELECT {_SPLIT} AS is_test, count(*) AS listings, count(DISTINCT host_id) AS hosts
FROM master WHERE price_numeric IS NOT NULL AND price_numeric > 0 GROUP BY 1""")


def _metrics(pred, src, name):
    return f"""SELECT count(*) AS n, round(avg(abs(p - y)), 4) AS mae, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
  round(avg(abs(p - y) / y) * 100, 4) AS mape, round(1 - sum((p - y) * (p - y)) / (count(*) * var_pop(y)), 4) AS r2,
  round(avg(CAST(abs(p - y) / y <= 0.2 AS DOUBLE)) * 100, 4) AS pct_within_20, '{name}' AS model
FROM (SELECT price_numeric AS y, {pred} AS p FROM {src})"""


_TR = f"(SELECT * FROM master WHERE price_numeric > 0 AND NOT ({_SPLIT}))"
_TE = f"(SELECT * FROM master WHERE price_numeric > 0 AND {_SPLIT})"
_G = f"(SELECT median(price_numeric) FROM {_TR})"
_RT = f"(SELECT room_type, median(price_numeric) AS m FROM {_TR} GROUP BY room_type)"
_NR = f"(SELECT neighbourhood_cleansed, room_type, median(price_numeric) AS m FROM {_TR} GROUP BY 1, 2)"
oracle("model_baseline_medians", ["master"], "\nUNION ALL\n".join([
    _metrics(_G, _TE, "global_median"),
    _metrics(f"coalesce(rt.m, {_G})", f"{_TE} t LEFT JOIN {_RT} rt ON t.room_type = rt.room_type",
             "room_type_median"),
    _metrics(f"coalesce(nr.m, rt.m, {_G})", f"{_TE} t LEFT JOIN {_RT} rt ON t.room_type = rt.room_type "
             f"LEFT JOIN {_NR} nr ON t.neighbourhood_cleansed = nr.neighbourhood_cleansed AND t.room_type = nr.room_type",
             "neighbourhood_room_type_median")]))


# ---------------------------------------------------------------- sources / search
oracle("geo_neighbourhood_metrics", ["lm", "listings"], """
SELECT d.*, p.median_price FROM (
  SELECT neighbourhood_cleansed AS neighbourhood, count(*) AS listing_count, count(DISTINCT host_id) AS unique_hosts,
         round(max(neighbourhood_density_per_km2), 4) AS listings_per_km2 FROM lm GROUP BY 1) d
LEFT JOIN (SELECT neighbourhood_cleansed AS neighbourhood, round(median(price_numeric), 4) AS median_price
           FROM listings WHERE price_numeric >= 0 GROUP BY 1) p USING (neighbourhood)""")
oracle("dataset_inventory", ["raw_listings_full", "raw_calendar_full", "raw_reviews"], """
SELECT 'listings' AS source, count(*) AS rows, 37 AS columns, 'loaded' AS load_status FROM raw_listings_full
UNION ALL SELECT 'calendar', count(*), 7, 'loaded' FROM raw_calendar_full
UNION ALL SELECT 'reviews', count(*), 6, 'loaded' FROM raw_reviews
UNION ALL SELECT 'neighbourhoods', count(*), 2, 'loaded' FROM nation""")
oracle("multi_city_union", ["listings"], """
SELECT city, count(*) AS listings, count(DISTINCT host_id) AS hosts FROM listings GROUP BY city""")
oracle("listing_preview", ["listings"], """
SELECT id, name, round(price_numeric, 4) AS price_numeric, room_type FROM listings ORDER BY id LIMIT 20""")
oracle("column_samples_listings", ["listings"], """
SELECT c."column", c.dtype, s.samples FROM (VALUES ('room_type', 'string'), ('property_type_bucket', 'string'),
  ('city', 'string'), ('currency_code', 'string'), ('host_response_time', 'string'), ('instant_bookable', 'boolean'))
  c("column", dtype)
LEFT JOIN (
  SELECT "column", array_to_string(list_sort(list(value)), '|') AS samples FROM (
    SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value) AS rk,
           count(*) OVER (PARTITION BY "column") AS nd FROM (
      SELECT 'room_type' AS "column", room_type AS value, count(*) AS cnt FROM listings WHERE room_type IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'property_type_bucket', property_type_bucket, count(*) FROM listings
        WHERE property_type_bucket IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'city', city, count(*) FROM listings WHERE city IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'currency_code', currency_code, count(*) FROM listings WHERE currency_code IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'host_response_time', host_response_time, count(*) FROM listings
        WHERE host_response_time IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'instant_bookable', CAST(instant_bookable AS VARCHAR), count(*) FROM listings
        WHERE instant_bookable IS NOT NULL GROUP BY 2))
  WHERE nd <= 50 AND rk <= 8 GROUP BY "column") s USING ("column")""")
oracle("search_listings_filtered", ["listings"], """
SELECT id, neighbourhood_cleansed, round(price_numeric, 4) AS price_numeric,
  round(review_scores_rating, 4) AS review_scores_rating FROM listings
WHERE room_type = 'entire_home' AND neighbourhood_cleansed ILIKE '%nation_1%' AND price_numeric >= 1000
  AND price_numeric <= 300000 AND review_scores_rating >= 4 AND host_is_superhost = TRUE
ORDER BY id LIMIT 50""")
oracle("listing_lookup", ["listings"], """
SELECT id, host_id, round(price_numeric, 4) AS price_numeric, room_type FROM listings WHERE id = 7 LIMIT 1""")
oracle("listing_filter_page", ["listings"], """
SELECT id, name, round(price_numeric, 4) AS price_numeric,
  (SELECT count(*) FROM listings WHERE lower(room_type) = 'private_room' AND contains(lower(name), 'household'))
    AS total_count
FROM listings WHERE lower(room_type) = 'private_room' AND contains(lower(name), 'household')
ORDER BY id LIMIT 25 OFFSET 20""")
oracle("top_neighbourhoods_by_metric", ["neighbourhood_summary"], """
SELECT neighbourhood, round(median_price_gbp, 4) AS median_price_gbp, listing_count FROM neighbourhood_summary
ORDER BY median_price_gbp DESC NULLS LAST, neighbourhood LIMIT 10""")
oracle("top_neighbourhoods_null_as_zero", ["neighbourhood_summary"], """
SELECT neighbourhood, round(avg_review_score, 4) AS avg_review_score FROM neighbourhood_summary
ORDER BY coalesce(avg_review_score, 0) DESC, neighbourhood LIMIT 5""")
oracle("guarded_sql_example", ["listings"], """
SELECT room_type, count(*) AS listings, round(median(price_numeric), 2) AS median_price
FROM listings GROUP BY room_type ORDER BY listings DESC, room_type LIMIT 50""")
oracle("warehouse_completion_checks", [], """
SELECT * FROM (VALUES ('table_present', 'dim_city', TRUE), ('table_present', 'dim_neighbourhood', TRUE),
  ('table_present', 'dim_host', TRUE), ('table_present', 'dim_listing', TRUE), ('table_present', 'dim_date', TRUE),
  ('table_present', 'fact_calendar', TRUE), ('table_present', 'fact_reviews', TRUE),
  ('table_present', 'fact_listing_snapshot', TRUE),
  ('report_runs', 'median_price_by_room_type', TRUE), ('report_runs', 'top_neighbourhoods_by_listing_count', TRUE),
  ('report_runs', 'weekend_vs_weekday_availability', TRUE), ('report_runs', 'occupancy_proxy_distribution', TRUE),
  ('report_runs', 'superhost_price_rating_gap', TRUE)) t("check", target, passed)""")


# ---------------------------------------------------------------- round trips, comparisons, classes, ranks
oracle("io_csv_roundtrip", ["raw_listings"], """
SELECT id, 'a "name",' || chr(10) || id AS name, price, host_is_superhost, room_type FROM raw_listings""")
oracle("io_json_roundtrip", ["calendar_summary"], "SELECT listing_id, calendar_days, available_days FROM calendar_summary")
oracle("io_partitioned_replace", ["listings"], """
SELECT room_type, count(*) FILTER (WHERE room_type <> 'entire_home' OR price_numeric IS NOT NULL) AS listings,
  count(price_numeric) AS priced FROM listings WHERE room_type IS NOT NULL GROUP BY room_type""")
oracle("snapshot_archive", ["snap_old", "snap_new"], """
SELECT DISTINCT 'bound' AS city, snapshot_date FROM (SELECT snapshot_date FROM snap_old UNION ALL SELECT snapshot_date FROM snap_new)""")
oracle("listings_valid_coordinates", ["raw_listings"], """
SELECT CAST(id AS BIGINT) AS id FROM raw_listings WHERE TRY_CAST(latitude AS DOUBLE) BETWEEN -90 AND 90
  AND TRY_CAST(longitude AS DOUBLE) BETWEEN -180 AND 180""")
oracle("eda_host_segment_comparison", ["lm"], """
SELECT CASE WHEN host_portfolio_size <= 1 THEN '1 listing' WHEN host_portfolio_size <= 5 THEN '2-5 listings'
    WHEN host_portfolio_size <= 20 THEN '6-20 listings' WHEN host_portfolio_size > 20 THEN '21+ listings' END AS segment,
  count(*) AS listing_count, count(DISTINCT host_id) AS unique_hosts, round(avg(CAST(host_is_superhost AS DOUBLE)), 4) AS superhost_rate,
  round(median(price_numeric), 4)::DOUBLE AS median_price, round(median(review_scores_rating), 4)::DOUBLE AS median_rating,
  round(median(reviews_per_month_calc), 4)::DOUBLE AS median_reviews_per_month, median(availability_365)::DOUBLE AS median_availability,
  round(median(occupancy_proxy), 4)::DOUBLE AS median_occupancy
FROM lm GROUP BY 1""")
oracle("eda_rating_classes", ["lm"], """
SELECT * FROM (WITH med AS (SELECT neighbourhood_cleansed, count(review_scores_rating) AS n, median(review_scores_rating::DOUBLE) AS m FROM lm
  GROUP BY 1 HAVING count(review_scores_rating) >= 20),
cuts AS (SELECT quantile_cont(m, 0.33) AS low, quantile_cont(m, 0.67) AS high FROM med)
SELECT neighbourhood_cleansed, n, round(m, 4) AS median_rating,
  CASE WHEN m >= high THEN 'upper' WHEN m >= low THEN 'middle' ELSE 'lower' END AS rating_class FROM med, cuts)""")
oracle("model_city_error_rank", ["master", "listings"], f"""
SELECT * FROM (WITH rt AS (SELECT room_type, median(price_numeric::DOUBLE) AS p FROM {_TR} GROUP BY 1),
errors AS (SELECT l.city, avg(abs(rt.p - te.price_numeric)) AS mae, count(*) AS n_test
  FROM {_TE} te JOIN rt ON rt.room_type = te.room_type JOIN listings l ON l.id = te.id GROUP BY 1)
SELECT e.city, round(mae, 4) AS mae, n_test, (SELECT count(*) FROM listings l WHERE l.city = e.city) AS listings,
  rank() OVER (ORDER BY round(mae, 6)) AS mae_rank FROM errors e)""")
