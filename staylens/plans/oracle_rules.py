"""Oracle SQL of the suites and warehouse rules: a plain SELECT for each expectation and rule."""

from __future__ import annotations

from staylens.plans.oracle_queries import ORACLES, oracle  # noqa: F401

_NOTHING = ("NULL::BIGINT", "NULL::BIGINT", "NULL::DOUBLE")


def _fixed(kind, column, ok, observed):
    return kind, column, ok, observed, *_NOTHING


def _count(kind, column, elements, unexpected, mostly=1.0):
    allowed = 1000 - round(1000 * mostly)
    return (kind, column, f"1000 * {unexpected} <= {allowed} * {elements}", f"CAST({unexpected} AS VARCHAR)", elements,
            unexpected, f"round(CASE WHEN {elements} > 0 THEN {unexpected} * 100.0::DOUBLE / {elements} ELSE 0 END, 4)")


def _rows(low):
    return ("row_count_between", None, f"count(*) >= {low}", "CAST(count(*) AS VARCHAR)", "count(*)", "0", "0.0::DOUBLE")


def _nn(c):
    return _count("not_null", c, "count(*)", f"count(*) FILTER (WHERE {c} IS NULL)")


def _in(c, values):
    return _count("in_set", c, f"count({c})", f"count(*) FILTER (WHERE {c} NOT IN ({values}))")


def _bt(c, low, high, mostly=1.0):
    out = " OR ".join(x for x in (f"{c} < {low}" if low is not None else "", f"{c} > {high}" if high is not None else "") if x)
    return _count("between", c, f"count({c})", f"count(*) FILTER (WHERE {out})", mostly)


def _uq(c, table):
    return _count("unique", c, f"count({c})", f"(SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM {table} "
                  f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))")


_TYPES = "'entire_home', 'private_room', 'shared_room', 'hotel_room'"
_SET = _fixed("column_set", None, "TRUE", "'all present'")
_SUITES = {
    ("listing_master", "master"): [
        _rows(1000), _SET, _fixed("column_exists", "id", "TRUE", "'present'"), _nn("id"), _uq("id", "master"), _nn("host_id"),
        _nn("neighbourhood_cleansed"), _nn("latitude"), _bt("latitude", -90.0, 90.0), _nn("longitude"),
        _bt("longitude", -180.0, 180.0), _nn("room_type"), _in("room_type", _TYPES), _nn("accommodates"),
        _bt("accommodates", 1, 100), _bt("minimum_nights", 1, None, 0.99), _nn("availability_365"),
        _bt("availability_365", 0, 365), _bt("price_numeric", "0.01::DOUBLE", 50000, 0.99),
        _bt("price_numeric", "0.01::DOUBLE", None, 0.55), _bt("review_scores_rating", 1.0, 5.0, 0.99),
        _nn("is_de_facto_inactive"), _in("is_de_facto_inactive", "TRUE, FALSE"), _nn("currency_code"),
        _bt("host_tenure_years", 0.0, 25.0, 0.99), _bt("occupancy_proxy", 0.0, 1.0)],
    ("calendar_clean", "calendar"): [
        _rows(365000), _SET, _nn("listing_id"), _nn("date"), _nn("available"),
        _bt("date", "DATE '2025-01-01'", "DATE '2027-12-31'"), _in("available", "TRUE, FALSE"),
        _bt("minimum_nights", 1, 365, 0.99), _bt("maximum_nights", 1, None, 0.99)],
    ("reviews_clean", "reviews"): [
        _rows(1000), _SET, _nn("id"), _uq("id", "reviews"), _nn("listing_id"), _nn("reviewer_id"), _nn("date"),
        _bt("date", "DATE '2008-01-01'", "DATE '2026-12-31'"), _nn("comment_length"), _bt("comment_length", 0, 50000),
        _nn("comment_is_duplicate"), _in("comment_is_duplicate", "TRUE, FALSE")],
}


def _suite_sql():
    for (suite, table), cells in _SUITES.items():
        for i, (kind, c, ok, observed, elements, unexpected, share) in enumerate(cells):
            column = f"'{c}'" if c else "NULL::VARCHAR"
            source = "(SELECT 1)" if elements == _NOTHING[0] else table
            yield (f"SELECT '{suite}' AS suite, {i} AS idx, '{kind}' AS expectation, {column} AS \"column\", ({ok})::BOOLEAN AS success, "
                   f"{observed} AS observed, ({elements})::BIGINT AS element_count, ({unexpected})::BIGINT AS unexpected_count, "
                   f"({share})::DOUBLE AS unexpected_pct FROM {source}")


_NEEDS = ["master", "calendar", "reviews"]
_SUITE_ROWS = "\nUNION ALL ".join(_suite_sql())
oracle("validation_suites", _NEEDS, _SUITE_ROWS)
oracle("validation_suites_summary", _NEEDS, f"""
SELECT suite, count(*) AS evaluated, count(*) FILTER (WHERE success) AS passed, count(*) FILTER (WHERE NOT success) AS failed
FROM ({_SUITE_ROWS}) GROUP BY suite""")

_CATEGORY = """CASE WHEN contains(rule, 'unique') THEN 'uniqueness' WHEN contains(rule, '_not_null') THEN 'non_null'
  WHEN contains(rule, 'referential') THEN 'referential' WHEN contains(rule, '_in_range') OR contains(rule, 'bounds') THEN 'range'
  WHEN contains(rule, 'valid') THEN 'domain' WHEN contains(rule, 'matches') OR contains(rule, 'present') THEN 'shape'
  WHEN contains(rule, 'positive') OR contains(rule, 'non_negative') THEN 'range' WHEN contains(rule, 'monotonic') THEN 'structural'
  WHEN contains(rule, 'zero_or_one') THEN 'domain' ELSE 'other' END"""


def _rules(t, missing_tables):
    """All rules over tables of the given names."""
    def bad(table, name, condition):
        return table, name, f"SELECT count(*) FILTER (WHERE {condition}) FROM {t[table]}"

    def unique(table, name, key, own="warehouse"):
        return own, name, f"SELECT count(*) - count(DISTINCT {key}) FROM {t[table]}"

    def pair_unique(table, name):
        return table, name, (f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT listing_key, date_key FROM {t[table]} "
                             f"WHERE listing_key IS NOT NULL AND date_key IS NOT NULL)) FROM {t[table]}")

    def refers(table, parent, key, name):
        return table, name, (f"SELECT count(*) FROM {t[table]} c WHERE NOT EXISTS (SELECT 1 FROM {t[parent]} p WHERE p.{key} = c.{key})")

    def same_rows(a, b, own, name):
        return own, name, f"SELECT abs((SELECT count(*) FROM {a}) - (SELECT count(*) FROM {b}))"
    listing, snap, cal, rev = "dim_listing", "fact_listing_snapshot", "fact_calendar", "fact_reviews"
    cells = [
        bad(listing, "listing_key_not_null", "listing_key IS NULL"), bad(listing, "host_key_not_null", "host_key IS NULL"),
        bad(listing, "neighbourhood_key_not_null", "neighbourhood_key IS NULL"),
        bad(listing, "room_type_valid", f"room_type IS NULL OR room_type NOT IN ({_TYPES})"),
        bad(listing, "latitude_in_range", "latitude < -90 OR latitude > 90"),
        bad(listing, "longitude_in_range", "longitude < -180 OR longitude > 180"),
        unique(listing, "listing_key_unique", "listing_key", listing),
        bad(snap, "price_null_or_non_negative", "price_numeric < 0"),
        bad(snap, "availability_365_in_range", "availability_365 < 0 OR availability_365 > 365"),
        bad(snap, "number_of_reviews_non_negative", "number_of_reviews < 0"),
        same_rows(t[snap], t[listing], snap, "fact_snapshot_matches_dim_count"),
        bad(cal, "listing_key_not_null", "listing_key IS NULL"), bad(cal, "date_key_not_null", "date_key IS NULL"),
        bad(cal, "available_int_is_zero_or_one", "available_int NOT IN (0, 1)"), pair_unique(cal, "composite_key_unique"),
        refers(cal, listing, "listing_key", "referential_integrity_to_dim_listing"),
        refers(cal, "dim_date", "date_key", "referential_integrity_to_dim_date"),
        bad(rev, "listing_key_not_null", "listing_key IS NULL"), bad(rev, "date_key_not_null", "date_key IS NULL"),
        bad(rev, "comment_length_non_negative", "comment_length < 0"), unique(rev, "review_id_unique", "review_id", rev),
        refers(rev, listing, "listing_key", "referential_integrity_to_dim_listing"),
        refers(rev, "dim_date", "date_key", "referential_integrity_to_dim_date"),
        unique("dim_neighbourhood", "dim_neighbourhood_key_unique", "neighbourhood_key"),
        ("warehouse", "dim_neighbourhood_area_positive",
         f"SELECT count(*) FILTER (WHERE area_km2 IS NULL OR area_km2 <= 0) FROM {t['dim_neighbourhood']}"),
        same_rows(t["dim_neighbourhood"], "neighbourhoods", "warehouse", "dim_neighbourhood_count_matches_source"),
        unique("dim_host", "dim_host_unique_source_id", "source_host_id"),
        ("warehouse", "dim_date_monotonic", f"SELECT abs(date_diff('day', min(date), max(date)) + 1 - count(*)) FROM {t['dim_date']}"),
        ("warehouse", "dim_date_year_bounds",
         f"SELECT CASE WHEN min(date) < DATE '2011-01-01' AND max(date) >= DATE '2026-01-01' THEN 0 ELSE 1 END FROM {t['dim_date']}"),
        unique("dim_date", "dim_date_key_unique", "date_key"),
        ("warehouse", "warehouse_tables_present", f"SELECT {missing_tables}"),
    ]
    rows = "\nUNION ALL ".join(f"SELECT '{a}' AS \"table\", '{n}' AS rule, ({q})::BIGINT AS violations" for a, n, q in cells)
    return f"SELECT *, {_CATEGORY} AS category, violations = 0 AS passed FROM ({rows})"


_TABLES = ["dim_neighbourhood", "dim_host", "dim_listing", "dim_date", "fact_calendar", "fact_reviews", "fact_listing_snapshot"]
_ALL = [*_TABLES, "neighbourhoods"]
_FAULTY = {
    "fact_calendar": """SELECT * REPLACE (CASE WHEN listing_key % 97 = 0 THEN NULL WHEN listing_key % 89 = 0 THEN listing_key + 1000000000
        ELSE listing_key END AS listing_key, CASE WHEN date_key % 53 <> 0 THEN date_key END AS date_key,
        CASE WHEN listing_key % 41 = 0 THEN 2 ELSE available_int END AS available_int) FROM fact_calendar
      UNION ALL SELECT * FROM fact_calendar WHERE listing_key % 83 = 0""",
    "fact_reviews": """SELECT * REPLACE (CASE WHEN review_id % 47 <> 0 THEN listing_key END AS listing_key,
        CASE WHEN review_id % 43 = 0 THEN date_key + 50000000 ELSE date_key END AS date_key,
        CASE WHEN review_id % 59 = 0 THEN -1 ELSE comment_length END AS comment_length) FROM fact_reviews
      UNION ALL SELECT * FROM fact_reviews WHERE review_id % 31 = 0""",
    "dim_listing": """SELECT * REPLACE (CASE WHEN listing_key % 101 <> 0 THEN listing_key END AS listing_key,
        CASE WHEN listing_key % 71 <> 0 THEN host_key END AS host_key,
        CASE WHEN listing_key % 73 <> 0 THEN neighbourhood_key END AS neighbourhood_key,
        CASE WHEN listing_key % 61 = 0 THEN 'loft' ELSE room_type END AS room_type,
        CASE WHEN listing_key % 67 = 0 THEN 95.0::DOUBLE ELSE latitude END AS latitude,
        CASE WHEN listing_key % 69 = 0 THEN -200.0::DOUBLE ELSE longitude END AS longitude) FROM dim_listing
      UNION ALL SELECT * FROM dim_listing WHERE listing_key % 79 = 0""",
    "fact_listing_snapshot": """SELECT * REPLACE (CASE WHEN listing_key % 37 = 0 THEN -1.0::DOUBLE ELSE price_numeric END AS price_numeric,
        CASE WHEN listing_key % 73 = 0 THEN 400 ELSE availability_365 END AS availability_365,
        CASE WHEN listing_key % 29 = 0 THEN -3 ELSE number_of_reviews END AS number_of_reviews) FROM fact_listing_snapshot""",
    "dim_neighbourhood": """SELECT * REPLACE (CASE WHEN neighbourhood_key % 7 <> 0 THEN area_km2 END AS area_km2) FROM dim_neighbourhood
      UNION ALL SELECT * FROM dim_neighbourhood WHERE neighbourhood_key % 11 = 0""",
    "dim_date": """SELECT * FROM dim_date WHERE date_key % 100 <> 13
      UNION ALL SELECT * FROM dim_date WHERE date_key % 10000 = 101""",
    "dim_host": "SELECT * FROM dim_host",
}
_FAULT_NAMES = {k: f"faulty_{k}" for k in _FAULTY}
_FAULT_CTES = ", ".join(f"{_FAULT_NAMES[k]} AS ({q})" for k, q in _FAULTY.items())
_FAULT_RULES = f"WITH {_FAULT_CTES} {_rules(_FAULT_NAMES, 1)}"
oracle("validation_rules", _ALL, _rules({k: k for k in _TABLES}, 0))
oracle("validation_rules_on_faults", _ALL, f"SELECT * FROM ({_FAULT_RULES})")
oracle("validation_rule_categories", _ALL, f"""
SELECT category, count(*) AS rules, count(*) FILTER (WHERE NOT passed) AS failed, sum(violations)::BIGINT AS violations
FROM ({_FAULT_RULES}) GROUP BY category""")
