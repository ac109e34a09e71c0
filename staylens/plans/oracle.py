"""DuckDB oracle SQL for the registered queries.

Written independently from the Spark code, from the operator definitions:
the binding of the rental model to the driver tables is re-stated here in
DuckDB SQL as CTEs, and every oracle is a final SELECT over the CTEs it needs.
All literals in arithmetic are DOUBLE (DuckDB would otherwise use DECIMAL).
"""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


def compose(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {body}\n{final}"


SNAP = "DATE '2024-02-15'"

# ---------------------------------------------------------------- bindings
cte("host_stats", [], """
SELECT o_custkey, min(o_orderdate) AS first_order_ts, count(*) AS host_orders
FROM orders GROUP BY o_custkey""")

cte("geo", [], """
SELECT n_nationkey, n_name, r_name,
       51.28::DOUBLE + (n_nationkey % 5) * 0.08::DOUBLE AS lat0,
       -0.5::DOUBLE + floor(n_nationkey / 5) * 0.12::DOUBLE AS lon0
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

cte("raw_listings", ["host_stats", "geo"], """
SELECT
  CAST(o_orderkey AS VARCHAR) AS id,
  'Stay ' || CAST(o_orderkey AS VARCHAR) || ' ' || lower(c_mktsegment) AS name,
  CAST(o_custkey AS VARCHAR) AS host_id,
  c_name AS host_name,
  strftime(first_order_ts, '%Y-%m-%d') AS host_since,
  CASE o_custkey % 4 WHEN 0 THEN 'within an hour' WHEN 1 THEN 'within a few hours'
       WHEN 2 THEN 'within a day' END AS host_response_time,
  CAST(o_custkey % 101 AS VARCHAR) || '%' AS host_response_rate,
  CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey % 91 + 10 AS VARCHAR) || '%' END
    AS host_acceptance_rate,
  CASE o_orderstatus WHEN 'F' THEN 't' WHEN 'O' THEN 'f' END AS host_is_superhost,
  CASE WHEN o_custkey % 3 = 0 THEN 'f' ELSE 't' END AS host_identity_verified,
  ' ' || n_name || ' ' AS neighbourhood_cleansed,
  r_name AS city,
  CASE WHEN o_orderkey % 211 = 0 THEN '95.0' WHEN o_orderkey % 223 = 0 THEN NULL
       ELSE printf('%.6f', lat0 + (o_orderkey % 800) * 0.0001::DOUBLE) END AS latitude,
  CASE WHEN o_orderkey % 227 = 0 THEN '-190.5'
       ELSE printf('%.6f', lon0 + (o_orderkey % 1200) * 0.0001::DOUBLE) END AS longitude,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Camper/RV' WHEN 'BUILDING' THEN 'Entire rental unit'
       WHEN 'FURNITURE' THEN 'Private room in townhouse' WHEN 'HOUSEHOLD' THEN 'Entire home'
       ELSE CASE WHEN c_mktsegment IS NOT NULL THEN 'Room in boutique hotel' END
  END AS property_type,
  CASE WHEN o_orderkey % 101 = 0 THEN 'Submarine'
       WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'Entire home/apt'
       WHEN o_orderpriority = '2-HIGH' THEN 'Private room'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Shared room'
       ELSE 'Hotel room' END AS room_type,
  CAST(o_orderkey % 6 + 2 AS VARCHAR) AS accommodates,
  CASE o_orderkey % 6 WHEN 0 THEN '1 bath' WHEN 1 THEN '1.5 shared baths' WHEN 2 THEN 'Half-bath'
       WHEN 3 THEN '2 private baths' WHEN 5 THEN 'Shared half-bath' END AS bathrooms_text,
  CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 5 AS VARCHAR) END AS bedrooms,
  CAST(o_orderkey % 4 + 1 AS VARCHAR) AS beds,
  CASE o_orderkey % 4 WHEN 0 THEN '["Wifi", "Kitchen", "Washer"]'
       WHEN 1 THEN '["Wifi", "Free parking on premises", "Air conditioning", "Pool"]'
       WHEN 2 THEN 'not json' ELSE '[]' END AS amenities,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL
       WHEN o_orderkey % 97 = 0 THEN '-' || format('${:,.2f}', o_totalprice)
       ELSE format('${:,.2f}', o_totalprice) END AS price,
  CAST(o_orderkey % 400 + 1 AS VARCHAR) AS minimum_nights,
  CASE WHEN o_orderkey % 13 = 0 THEN '2147483647' ELSE CAST(o_orderkey % 700 + 365 AS VARCHAR) END
    AS maximum_nights,
  CASE WHEN o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'f' ELSE 't' END AS has_availability,
  CAST((o_orderkey * 7) % 366 AS VARCHAR) AS availability_365,
  CAST(o_orderkey % 120 AS VARCHAR) AS number_of_reviews,
  '2024-02-15' AS last_scraped,
  CASE WHEN o_orderkey % 8 <> 0 THEN printf('%.2f', 3.0::DOUBLE + (o_orderkey % 201) / 100.0::DOUBLE) END
    AS review_scores_rating,
  CASE WHEN o_orderkey % 10 <> 0 THEN printf('%.1f', 2.0::DOUBLE + (o_orderkey % 31) / 10.0::DOUBLE) END
    AS review_scores_cleanliness,
  printf('%.1f', 3.0::DOUBLE + (o_custkey % 21) / 10.0::DOUBLE) AS review_scores_location,
  CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'f' END AS instant_bookable,
  CAST(host_orders AS VARCHAR) AS calculated_host_listings_count
FROM orders
LEFT JOIN host_stats USING (o_custkey)
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN geo ON c_nationkey = n_nationkey""")

BOOL = ("CASE WHEN lower(trim({0})) IN ('t','true','1','yes','y') THEN TRUE "
        "WHEN lower(trim({0})) IN ('f','false','0','no','n') THEN FALSE END")


def _bool(c):
    return BOOL.format(c)


def _pct(c):
    return f"TRY_CAST(replace({c}, '%', '') AS DOUBLE) / 100.0::DOUBLE"


def _sentinel(c):
    return (f"CASE WHEN TRY_CAST({c} AS DOUBLE) < 1073741824.0 "
            f"THEN CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT) END")


def _date(c):
    return f"CAST(TRY_STRPTIME({c}, '%Y-%m-%d') AS DATE)"


cte("typed_listings", ["raw_listings"], f"""
SELECT
  TRY_CAST(id AS BIGINT) AS id, trim(name) AS name, TRY_CAST(host_id AS BIGINT) AS host_id,
  trim(host_name) AS host_name, {_date('host_since')} AS host_since, host_response_time,
  {_pct('host_response_rate')} AS host_response_rate,
  {_pct('host_acceptance_rate')} AS host_acceptance_rate,
  {_bool('host_is_superhost')} AS host_is_superhost,
  {_bool('host_identity_verified')} AS host_identity_verified,
  trim(neighbourhood_cleansed) AS neighbourhood_cleansed, city,
  TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
  property_type,
  CASE lower(trim(room_type)) WHEN 'entire home/apt' THEN 'entire_home'
       WHEN 'private room' THEN 'private_room' WHEN 'shared room' THEN 'shared_room'
       WHEN 'hotel room' THEN 'hotel_room' END AS room_type,
  TRY_CAST(accommodates AS BIGINT) AS accommodates, bathrooms_text,
  TRY_CAST(bedrooms AS DOUBLE) AS bedrooms, TRY_CAST(beds AS DOUBLE) AS beds, amenities,
  {_sentinel('minimum_nights')} AS minimum_nights, {_sentinel('maximum_nights')} AS maximum_nights,
  {_bool('has_availability')} AS has_availability,
  TRY_CAST(availability_365 AS BIGINT) AS availability_365,
  TRY_CAST(number_of_reviews AS BIGINT) AS number_of_reviews,
  {_date('last_scraped')} AS last_scraped,
  TRY_CAST(review_scores_rating AS DOUBLE) AS review_scores_rating,
  TRY_CAST(review_scores_cleanliness AS DOUBLE) AS review_scores_cleanliness,
  TRY_CAST(review_scores_location AS DOUBLE) AS review_scores_location,
  {_bool('instant_bookable')} AS instant_bookable,
  TRY_CAST(calculated_host_listings_count AS BIGINT) AS calculated_host_listings_count,
  price AS price_raw,
  TRY_CAST(regexp_replace(price, '[^0-9.\\-]', '', 'g') AS DOUBLE) AS price_numeric,
  'GBP' AS currency_code,
  CASE WHEN property_type IS NULL OR property_type = '' THEN 'other'
       WHEN regexp_matches(lower(property_type), 'apartment|condo|loft|studio|rental unit') THEN 'apartment'
       WHEN regexp_matches(lower(property_type), 'house|home|townhouse|cottage|bungalow|villa') THEN 'house'
       WHEN regexp_matches(lower(property_type), 'hotel|hostel|bed and breakfast|aparthotel') THEN 'hotel'
       WHEN regexp_matches(lower(property_type), 'boat|tent|yurt|treehouse|barn|cave|tipi|tower|camper|rv|casa particular|earthen|windmill|lighthouse|shepherd') THEN 'unique'
       ELSE 'other' END AS property_type_bucket,
  CASE WHEN TRY_CAST(regexp_extract(lower(trim(bathrooms_text)), '([0-9.]+)', 1) AS DOUBLE) IS NULL
            AND contains(lower(trim(bathrooms_text)), 'half') THEN 0.5::DOUBLE
       ELSE TRY_CAST(regexp_extract(lower(trim(bathrooms_text)), '([0-9.]+)', 1) AS DOUBLE) END
    AS bathroom_count,
  CASE WHEN contains(lower(trim(bathrooms_text)), 'shared') THEN TRUE
       WHEN contains(lower(trim(bathrooms_text)), 'private') THEN FALSE END AS bathroom_is_shared
FROM raw_listings""")

cte("flagged_listings", ["typed_listings"], """
SELECT *,
  NULLIF(concat_ws(',',
    CASE WHEN coalesce(price_numeric < 0, FALSE) THEN 'negative_price' END,
    CASE WHEN coalesce(NOT (latitude BETWEEN -90 AND 90), TRUE) THEN 'invalid_latitude' END,
    CASE WHEN coalesce(NOT (longitude BETWEEN -180 AND 180), TRUE) THEN 'invalid_longitude' END,
    CASE WHEN id IS NULL THEN 'missing_listing_id' END,
    CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_listing_key' END), '')
    AS rejection_reason
FROM (SELECT *, bedrooms IS NULL AS bedrooms_is_missing,
             coalesce(minimum_nights >= 365, FALSE) AS is_de_facto_inactive
      FROM typed_listings)""")

cte("listings", ["flagged_listings"], """
SELECT * EXCLUDE (rejection_reason) FROM flagged_listings WHERE rejection_reason IS NULL""")

cte("raw_calendar", [], """
SELECT CAST(l_orderkey AS VARCHAR) AS listing_id,
  CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN 'not-a-date'
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
  CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 AND l_orderkey % 3 = 0 THEN 'maybe'
       WHEN l_linestatus = 'O' THEN 't' WHEN l_linestatus = 'F' THEN 'f' END AS available,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS minimum_nights,
  CASE WHEN l_linenumber = 1 THEN '2147483647'
       ELSE CAST(CAST(l_quantity AS BIGINT) * 30 AS VARCHAR) END AS maximum_nights
FROM lineitem""")

cte("flagged_calendar", ["raw_calendar"], f"""
SELECT *, CASE WHEN listing_id IS NULL OR date IS NULL OR available IS NULL
                    OR count(*) OVER (PARTITION BY listing_id, date) > 1
               THEN 'invalid_or_duplicate_calendar_key' END AS rejection_reason
FROM (SELECT TRY_CAST(listing_id AS BIGINT) AS listing_id, {_date('date')} AS date,
             {_bool('available')} AS available, {_sentinel('minimum_nights')} AS minimum_nights,
             {_sentinel('maximum_nights')} AS maximum_nights
      FROM raw_calendar)""")

cte("calendar", ["flagged_calendar"], """
SELECT * EXCLUDE (rejection_reason) FROM flagged_calendar WHERE rejection_reason IS NULL""")

cte("raw_reviews", [], """
SELECT CAST(user_id AS VARCHAR) AS listing_id,
  CASE WHEN event_id % 500 = 0 THEN NULL WHEN event_id % 777 = 1 THEN CAST(event_id - 1 AS VARCHAR)
       ELSE CAST(event_id AS VARCHAR) END AS id,
  strftime(ts, '%Y-%m-%d') AS date,
  json_extract_string(props, '$.k') AS reviewer_id,
  ' ' || upper(event_type) || ' ' AS reviewer_name,
  CASE WHEN event_id % 333 = 0 THEN NULL
       WHEN value >= 50 THEN event_type || ' stay ' || CAST(event_id AS VARCHAR)
       ELSE '  ' || event_type || ' stay' END AS comments
FROM events""")

cte("flagged_reviews", ["raw_reviews"], f"""
SELECT *, count(*) OVER (PARTITION BY comments) > 1 AS comment_is_duplicate,
       CASE WHEN id IS NULL OR listing_id IS NULL OR date IS NULL
                 OR count(*) OVER (PARTITION BY id) > 1
            THEN 'missing_or_duplicate_review_key' END AS rejection_reason
FROM (SELECT TRY_CAST(listing_id AS BIGINT) AS listing_id, TRY_CAST(id AS BIGINT) AS id,
             {_date('date')} AS date, TRY_CAST(reviewer_id AS BIGINT) AS reviewer_id,
             trim(reviewer_name) AS reviewer_name, trim(coalesce(comments, '')) AS comments,
             CAST(length(trim(coalesce(comments, ''))) AS BIGINT) AS comment_length
      FROM raw_reviews)""")

cte("reviews", ["flagged_reviews"], """
SELECT * EXCLUDE (rejection_reason) FROM flagged_reviews WHERE rejection_reason IS NULL""")

# Neighbourhood boxes: exact sphere areas / centroids in closed form.
cte("neighbourhoods", ["geo"], """
SELECT trim(n_name || ' ') AS neighbourhood,
  degrees(asin((sin(radians(lat0)) + sin(radians(lat0 + 0.08::DOUBLE))) / 2)) AS centroid_latitude,
  lon0 + 0.06::DOUBLE AS centroid_longitude,
  6371.0::DOUBLE * 6371.0::DOUBLE * radians(0.12::DOUBLE)
    * (sin(radians(lat0 + 0.08::DOUBLE)) - sin(radians(lat0))) AS area_km2
FROM geo""")

# ---------------------------------------------------------------- summaries
cte("calendar_summary", ["calendar"], """
SELECT listing_id,
  count(*) AS calendar_days,
  CAST(sum(CASE WHEN available THEN 1 ELSE 0 END) AS BIGINT) AS available_days,
  CAST(sum(CASE WHEN NOT available THEN 1 ELSE 0 END) AS BIGINT) AS unavailable_days,
  CAST(sum(CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END) AS BIGINT) AS weekend_days,
  CAST(sum(CASE WHEN dayofweek(date) IN (0, 6) AND available THEN 1 ELSE 0 END) AS BIGINT)
    AS weekend_available_days,
  CAST(sum(CASE WHEN dayofweek(date) NOT IN (0, 6) AND available THEN 1 ELSE 0 END) AS BIGINT)
    AS weekday_available_days,
  sum(CASE WHEN available THEN 1 ELSE 0 END)::DOUBLE / count(*) AS availability_rate,
  1 - sum(CASE WHEN available THEN 1 ELSE 0 END)::DOUBLE / count(*) AS occupancy_proxy,
  min(date) AS first_calendar_date, max(date) AS last_calendar_date,
  avg(minimum_nights)::DOUBLE AS avg_minimum_nights,
  avg(maximum_nights)::DOUBLE AS avg_maximum_nights
FROM calendar GROUP BY listing_id""")

cte("review_summary", ["reviews"], f"""
SELECT listing_id,
  count(*) AS review_count_calc, min(date) AS first_review_calc, max(date) AS last_review_calc,
  count(DISTINCT reviewer_id) AS unique_reviewer_count,
  CAST(sum(CASE WHEN date >= {SNAP} - INTERVAL 12 MONTH THEN 1 ELSE 0 END) AS BIGINT)
    AS review_count_l12m,
  CAST(sum(CASE WHEN date >= {SNAP} - INTERVAL 30 DAY THEN 1 ELSE 0 END) AS BIGINT)
    AS review_count_l30d,
  avg(comment_length)::DOUBLE AS avg_comment_length,
  CAST(sum(CASE WHEN comment_is_duplicate THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_comment_count
FROM reviews GROUP BY listing_id""")

cte("neighbourhood_summary", ["listings", "neighbourhoods"], """
SELECT agg.*, n.area_km2,
  CASE WHEN n.area_km2 IS NULL OR n.area_km2 = 0 THEN NULL
       ELSE agg.listing_count::DOUBLE / n.area_km2 END AS listings_per_km2
FROM (
  SELECT neighbourhood_cleansed AS neighbourhood,
    count(*) AS listing_count,
    count(DISTINCT host_id) AS unique_host_count,
    quantile_cont(price_numeric, 0.5) AS median_price_gbp,
    avg(price_numeric) AS mean_price_gbp,
    sum(CASE WHEN price_numeric IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*) AS price_null_share,
    avg(CASE WHEN room_type = 'entire_home' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS entire_home_share,
    avg(CASE WHEN host_is_superhost THEN 1.0::DOUBLE WHEN NOT host_is_superhost THEN 0.0::DOUBLE END)
      AS superhost_share,
    avg(review_scores_rating) AS avg_review_score,
    avg(availability_365)::DOUBLE AS avg_availability_365
  FROM listings GROUP BY neighbourhood_cleansed) agg
LEFT JOIN neighbourhoods n USING (neighbourhood)""")

cte("master", ["listings", "review_summary", "calendar_summary", "neighbourhood_summary"], f"""
SELECT l.*,
  rs.review_count_calc, rs.first_review_calc, rs.last_review_calc, rs.unique_reviewer_count,
  rs.review_count_l12m, rs.review_count_l30d, rs.avg_comment_length, rs.duplicate_comment_count,
  cs.calendar_days, cs.available_days, cs.unavailable_days, cs.availability_rate,
  cs.occupancy_proxy, cs.weekend_available_days, cs.weekday_available_days,
  ns.listing_count AS neighbourhood_listing_count,
  ns.median_price_gbp AS neighbourhood_median_price_gbp,
  ns.listings_per_km2 AS neighbourhood_density_per_km2,
  date_diff('day', l.host_since, {SNAP}) / 365.25::DOUBLE AS host_tenure_years,
  CASE WHEN l.bedrooms IS NULL OR l.bedrooms = 0 THEN NULL ELSE l.price_numeric / l.bedrooms END
    AS price_per_bedroom_gbp,
  rs.review_count_l12m / 12.0::DOUBLE AS reviews_per_month_calc,
  l.calculated_host_listings_count AS host_portfolio_size,
  l.calculated_host_listings_count >= 5 AS is_professional_host,
  l.price_numeric * cs.unavailable_days AS revenue_proxy_gbp,
  (l.has_availability AND NOT l.is_de_facto_inactive) AS is_active_supply
FROM listings l
LEFT JOIN review_summary rs ON l.id = rs.listing_id
LEFT JOIN calendar_summary cs ON l.id = cs.listing_id
LEFT JOIN neighbourhood_summary ns ON l.neighbourhood_cleansed = ns.neighbourhood""")

# ---------------------------------------------------------------- warehouse
cte("dim_neighbourhood", ["neighbourhoods"], """
SELECT row_number() OVER (ORDER BY neighbourhood) AS neighbourhood_key, 1 AS city_key,
       neighbourhood AS neighbourhood_name, area_km2, centroid_latitude, centroid_longitude
FROM neighbourhoods""")

cte("dim_host", ["listings"], """
SELECT row_number() OVER (ORDER BY host_id) AS host_key, host_id AS source_host_id,
  arg_min(host_since, id) FILTER (WHERE host_since IS NOT NULL) AS host_since,
  arg_min(host_is_superhost, id) FILTER (WHERE host_is_superhost IS NOT NULL) AS host_is_superhost,
  arg_min(host_response_time, id) FILTER (WHERE host_response_time IS NOT NULL) AS host_response_time,
  arg_min(host_response_rate, id) FILTER (WHERE host_response_rate IS NOT NULL) AS host_response_rate,
  arg_min(host_acceptance_rate, id) FILTER (WHERE host_acceptance_rate IS NOT NULL) AS host_acceptance_rate,
  arg_min(host_identity_verified, id) FILTER (WHERE host_identity_verified IS NOT NULL)
    AS host_identity_verified,
  max(calculated_host_listings_count) AS host_portfolio_size,
  arg_min(host_since, id) FILTER (WHERE host_since IS NOT NULL) AS valid_from,
  CAST(NULL AS DATE) AS valid_to, TRUE AS is_current
FROM listings GROUP BY host_id""")

cte("dim_listing", ["listings", "dim_host", "dim_neighbourhood"], """
SELECT l.id AS listing_key, l.id AS source_listing_id, dh.host_key, dn.neighbourhood_key,
  l.room_type, l.property_type, l.property_type_bucket, l.accommodates, l.bedrooms, l.beds,
  l.bathroom_count, l.bathroom_is_shared, l.latitude, l.longitude, l.instant_bookable,
  l.is_de_facto_inactive
FROM listings l
LEFT JOIN dim_host dh ON dh.source_host_id = l.host_id
LEFT JOIN dim_neighbourhood dn ON dn.neighbourhood_name = l.neighbourhood_cleansed""")

cte("dim_date", [], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
  year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day,
  dayofweek(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend, week(d) AS iso_week,
  strftime(d, '%B') AS month_name
FROM (SELECT unnest(generate_series(DATE '1992-01-01', DATE '2027-01-01', INTERVAL 1 DAY)) AS d)""")

cte("fact_calendar", ["calendar"], """
SELECT listing_id AS listing_key, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
  available, CASE WHEN available THEN 1 ELSE 0 END AS available_int, minimum_nights, maximum_nights
FROM calendar""")

cte("fact_reviews", ["reviews"], """
SELECT id AS review_id, listing_id AS listing_key,
  CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, reviewer_id, comment_length,
  comment_is_duplicate
FROM reviews""")

cte("fact_listing_snapshot", ["master", "dim_host", "dim_neighbourhood"], """
SELECT m.id AS listing_key, 20240215 AS snapshot_date_key, dn.neighbourhood_key, dh.host_key,
  m.price_numeric, m.currency_code, m.availability_365, m.number_of_reviews,
  m.review_scores_rating, m.has_availability, m.is_active_supply, m.is_professional_host,
  m.host_tenure_years, m.price_per_bedroom_gbp, m.reviews_per_month_calc, m.revenue_proxy_gbp,
  m.occupancy_proxy, m.availability_rate
FROM master m
LEFT JOIN dim_host dh ON dh.source_host_id = m.host_id
LEFT JOIN dim_neighbourhood dn ON dn.neighbourhood_name = m.neighbourhood_cleansed""")

# ---------------------------------------------------------------- EDA base
cte("lm", ["master"], """
SELECT *,
  CASE WHEN host_portfolio_size IS NULL THEN NULL WHEN host_portfolio_size <= 1 THEN 'solo'
       WHEN host_portfolio_size <= 4 THEN 'multi' ELSE 'professional' END AS host_segment,
  CASE WHEN availability_365 IS NULL THEN NULL
       WHEN availability_365 <= 30 THEN 'Blocked / inactive  (0-30 d)'
       WHEN availability_365 <= 90 THEN 'Occasional  (31-90 d)'
       WHEN availability_365 <= 270 THEN 'Active  (91-270 d)' ELSE 'Always-on  (271-365 d)' END
    AS avail_band,
  CASE WHEN host_tenure_years IS NULL THEN NULL WHEN host_tenure_years <= 2 THEN 'New  (0-2 yr)'
       WHEN host_tenure_years <= 5 THEN 'Established  (2-5 yr)'
       WHEN host_tenure_years <= 10 THEN 'Experienced  (5-10 yr)' ELSE 'Veteran  (10+ yr)' END
    AS tenure_band
FROM master""")

cte("eda", ["lm"], "SELECT * FROM lm WHERE price_numeric IS NOT NULL AND price_numeric >= 0")

# ---------------------------------------------------------------- snapshots
cte("snap_base", ["listings", "calendar_summary"], """
SELECT l.id, l.price_numeric, l.room_type, l.is_de_facto_inactive, cs.first_calendar_date,
       cs.last_calendar_date, cs.availability_rate
FROM listings l JOIN calendar_summary cs ON l.id = cs.listing_id""")
cte("snap_old", ["snap_base"], """
SELECT id, price_numeric, room_type, is_de_facto_inactive, DATE '2000-01-01' AS snapshot_date
FROM snap_base WHERE first_calendar_date < DATE '2000-01-01'""")
cte("snap_new", ["snap_base"], """
SELECT id, CASE WHEN availability_rate > 0.6 THEN price_numeric * 1.2::DOUBLE ELSE price_numeric END AS price_numeric,
  CASE WHEN availability_rate = 0 THEN 'hotel_room' ELSE room_type END AS room_type,
  (is_de_facto_inactive OR coalesce(availability_rate = 0, FALSE)) AS is_de_facto_inactive,
  DATE '2002-01-01' AS snapshot_date
FROM snap_base WHERE last_calendar_date >= DATE '1998-01-01'""")
cte("snap_diff", ["snap_old", "snap_new"], """
SELECT 'new_listing' AS change_type, id AS listing_id, NULL::VARCHAR AS field, NULL::VARCHAR AS old_value,
       NULL::VARCHAR AS new_value, NULL::DOUBLE AS pct_change
FROM snap_new WHERE id NOT IN (SELECT id FROM snap_old)
UNION ALL
SELECT 'removed_listing', id, NULL, NULL, NULL, NULL FROM snap_old WHERE id NOT IN (SELECT id FROM snap_new)
UNION ALL
SELECT 'price_change', o.id, 'price_numeric', printf('%.2f', o.price_numeric), printf('%.2f', n.price_numeric),
       round_even((n.price_numeric - o.price_numeric) / o.price_numeric * 100, 1)
FROM snap_old o JOIN snap_new n USING (id)
WHERE o.price_numeric > 0 AND n.price_numeric IS NOT NULL
  AND abs(n.price_numeric - o.price_numeric) / o.price_numeric > 0.05
UNION ALL
SELECT 'status_change', o.id, 'room_type', o.room_type, n.room_type, NULL
FROM snap_old o JOIN snap_new n USING (id) WHERE o.room_type IS DISTINCT FROM n.room_type
UNION ALL
SELECT 'status_change', o.id, 'is_de_facto_inactive',
       CASE WHEN o.is_de_facto_inactive THEN 'True' WHEN NOT o.is_de_facto_inactive THEN 'False' END,
       CASE WHEN n.is_de_facto_inactive THEN 'True' WHEN NOT n.is_de_facto_inactive THEN 'False' END, NULL
FROM snap_old o JOIN snap_new n USING (id)
WHERE o.is_de_facto_inactive IS DISTINCT FROM n.is_de_facto_inactive""")

cte("raw_listings_full", ["raw_listings"], """
SELECT *, 'https://rooms.invalid/' || id AS listing_url, '20240215' AS scrape_id, NULL::VARCHAR AS bathrooms,
       'LIC-' || id AS license
FROM raw_listings""")
cte("raw_calendar_full", [], """
SELECT CAST(l_orderkey AS VARCHAR) AS listing_id,
  CASE WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN 'not-a-date'
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
  CASE WHEN l_returnflag = 'N' AND l_linenumber = 6 AND l_orderkey % 3 = 0 THEN 'maybe'
       WHEN l_linestatus = 'O' THEN 't' WHEN l_linestatus = 'F' THEN 'f' END AS available,
  format('${:,.2f}', l_extendedprice) AS price, format('${:,.2f}', l_extendedprice) AS adjusted_price,
  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS minimum_nights,
  CASE WHEN l_linenumber = 1 THEN '2147483647'
       ELSE CAST(CAST(l_quantity AS BIGINT) * 30 AS VARCHAR) END AS maximum_nights
FROM lineitem""")

# ---------------------------------------------------------------- CDC
cte("cdc_events", [], """
SELECT o_orderkey AS listing_id, o_orderkey * 10 + 1 AS lsn, o_orderdate::TIMESTAMP AS valid_from,
       o_totalprice AS price_numeric, FALSE AS is_deleted, o_orderpriority, o_orderstatus FROM orders
UNION ALL
SELECT o_orderkey, o_orderkey * 10 + 2, o_orderdate::TIMESTAMP + INTERVAL 1 DAY, o_totalprice * 1.2::DOUBLE, FALSE,
       o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_orderkey * 10 + 3, o_orderdate::TIMESTAMP + INTERVAL 2 DAY, NULL, TRUE,
       o_orderpriority, o_orderstatus FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""")
cte("cdc_history", ["cdc_events"], """
SELECT listing_id, lsn, round(price_numeric, 4) AS price_numeric,
  CASE WHEN is_deleted THEN NULL WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'entire_home'
       WHEN o_orderpriority = '2-HIGH' THEN 'private_room' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'shared_room'
       ELSE 'hotel_room' END AS room_type,
  valid_from, lead(valid_from) OVER (PARTITION BY listing_id ORDER BY valid_from, lsn) AS valid_to,
  lead(valid_from) OVER (PARTITION BY listing_id ORDER BY valid_from, lsn) IS NULL AS is_current, is_deleted
FROM cdc_events""")

cte("host_agg", ["master"], """
SELECT host_id, count(*)::DOUBLE AS listing_count,
  arg_min(host_tenure_years, id) FILTER (WHERE host_tenure_years IS NOT NULL) AS host_tenure_years,
  arg_min(host_response_rate, id) FILTER (WHERE host_response_rate IS NOT NULL) AS host_response_rate,
  arg_min(host_acceptance_rate, id) FILTER (WHERE host_acceptance_rate IS NOT NULL) AS host_acceptance_rate,
  arg_min(CAST(host_is_superhost AS DOUBLE), id) FILTER (WHERE host_is_superhost IS NOT NULL) AS host_is_superhost,
  sum(price_numeric::DECIMAL(28,2))::DOUBLE / count(price_numeric) AS avg_price,
  avg(availability_365)::DOUBLE AS avg_availability_365,
  sum(review_scores_rating::DECIMAL(28,2))::DOUBLE / count(review_scores_rating) AS avg_review_scores_rating, avg(reviews_per_month_calc) AS avg_reviews_per_month,
  avg(accommodates)::DOUBLE AS avg_accommodates, avg(minimum_nights)::DOUBLE AS avg_minimum_nights,
  round(avg(CASE WHEN room_type = 'entire_home' THEN 1.0 ELSE 0.0 END) * 100, 2)::DOUBLE AS pct_entire_home,
  count(DISTINCT neighbourhood_cleansed)::DOUBLE AS neighbourhood_count
FROM master GROUP BY host_id""")

cte("clust_feat", ["master"], """
SELECT id, room_type, neighbourhood_cleansed, price_numeric::DOUBLE AS price_numeric, ln(1 + price_numeric::DOUBLE) AS log_price,
  accommodates::DOUBLE AS accommodates, bedrooms::DOUBLE AS bedrooms, minimum_nights::DOUBLE AS minimum_nights,
  availability_365::DOUBLE AS availability_365, review_scores_rating::DOUBLE AS review_scores_rating,
  reviews_per_month_calc::DOUBLE AS reviews_per_month_calc,
  round(2 * 6371.0 * asin(sqrt(pow(sin((radians(51.508) - radians(latitude)) / 2), 2)
    + cos(radians(latitude)) * cos(radians(51.508)) * pow(sin((radians(-0.1281) - radians(longitude)) / 2), 2))), 3)
    AS distance_to_centre_km,
  CASE WHEN json_valid(amenities) AND json_type(amenities) = 'ARRAY' THEN json_array_length(amenities) ELSE 0 END::DOUBLE AS amenity_count
FROM master WHERE price_numeric IS NOT NULL AND price_numeric > 0""")
