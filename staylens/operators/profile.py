"""Profiling operators (AG47-AG54, PF19, PF23, W5, J10, S4, IO5).

Column profiles unpivot the profiled columns into (column, value) rows and
aggregate once per column, so a 80-column profile is one shuffle, not 80
queries. Per-column top values are bounded (top k per column).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.functions import scalars as S
from staylens.operators.ordered import with_quantiles

# The fields that must be there and those that matter, by source; others are optional.
CRITICAL_FIELDS = {
    "listings": ["id", "host_id", "latitude", "longitude", "last_scraped", "neighbourhood_cleansed", "room_type"],
    "calendar": ["listing_id", "date", "available"],
    "reviews": ["id", "listing_id", "date"],
    "neighbourhoods": ["neighbourhood"],
}
IMPORTANT_FIELDS = {
    "listings": ["price", "property_type", "accommodates", "bedrooms", "beds", "minimum_nights", "maximum_nights",
                 "host_is_superhost", "host_since", "review_scores_rating", "amenities", "availability_365",
                 "number_of_reviews", "instant_bookable"],
    "calendar": ["minimum_nights", "maximum_nights"],
    "reviews": ["reviewer_id", "comments"],
}
# Classes of a column by its share of nulls, in per cent.
NULL_CLASSES = [("complete", 0.0), ("mostly_complete", 5.0), ("partial", 30.0), ("sparse", 100.0)]
# Fixed value: the reference's default bounding box.
LONDON_BBOX = {"lat": (51.2, 51.8), "lon": (-0.55, 0.35)}


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` into (column, value string, value double)."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                      F.col(c).cast("string").try_cast("double").alias("num")) for c in cols]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("kv")).select(*keep, "kv.*")


def column_profile(df: DataFrame, cols: Sequence[str] | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """AG47: per column dtype, rows, nulls, null %, distinct, min, max (as text)."""
    cols = list(cols or [c for c in df.columns if c not in keep])
    dtypes = dict(df.dtypes)
    lng = _long(df, cols, keep)
    distinct = F.count_distinct("value").alias("distinct_count")
    agg = lng.groupBy(*keep, "column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("null_count"),
        distinct, F.min("value").alias("min_text"), F.max("value").alias("max_text"),
        F.min("num").alias("min_num"), F.max("num").alias("max_num"), F.avg("num").alias("mean_num"))
    dt = F.create_map(*[F.lit(x) for c in cols for x in (c, dtypes[c])])
    return agg.select(*keep, "column", dt[F.col("column")].alias("dtype"), "rows", "null_count",
                      (F.col("null_count") * 100.0 / F.col("rows")).alias("null_pct"),
                      "distinct_count", "min_text", "max_text", "min_num", "max_num", "mean_num")


def completeness_class(source: str, column: Column) -> Column:
    """AG48: critical, important or optional, by the field's name in its source."""
    return (F.when(column.isin(CRITICAL_FIELDS.get(source, [])), "critical")
            .when(column.isin(IMPORTANT_FIELDS.get(source, [])), "important").otherwise("optional"))


def null_class(null_pct: Column) -> Column:
    """The class of a column by its measured share of nulls."""
    return F.coalesce(*(F.when(null_pct <= F.lit(hi), label) for label, hi in NULL_CLASSES))


def field_completeness(profiles: dict[str, DataFrame]) -> DataFrame:
    """AG48: (source, column, completeness_class, rows, null_count, null_pct) of the column
    profiles of several sources."""
    out = None
    for source, profile in profiles.items():
        part = profile.select(F.lit(source).alias("source"), "column", completeness_class(source, F.col("column")).alias(
            "completeness_class"), "rows", "null_count", "null_pct")
        out = part if out is None else out.unionByName(part)
    return out


def extended_profile(df: DataFrame, numeric_cols: Sequence[str], source: str = "listings") -> DataFrame:
    """AG48: median/std/quartiles, cardinality ratio, completeness by the share of nulls and the
    class of the field in its source, per column."""
    lng = _long(df, numeric_cols)
    agg = lng.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count("num").alias("non_null"),
        F.count_distinct("num").alias("distinct_count"),
        F.stddev_samp("num").alias("std"))
    agg = with_quantiles(agg, lng, ["column"], {"q1": ("num", 0.25), "median": ("num", 0.5), "q3": ("num", 0.75)})
    return agg.select("column", "rows", "non_null", "distinct_count", "q1", "median", "q3", "std",
                      (F.col("distinct_count") / F.col("rows")).alias("cardinality_ratio"),
                      null_class((F.col("rows") - F.col("non_null")) * 100.0 / F.col("rows")).alias("completeness"),
                      completeness_class(source, F.col("column")).alias("completeness_class"))


def top_values_per_column(df: DataFrame, cols: Sequence[str], k: int = 5,
                          max_distinct: int | None = 200) -> DataFrame:
    """AG48 / T5: top-k values per column (count desc, value asc); only columns with
    at most ``max_distinct`` distinct values. One shuffle for all columns."""
    lng = _long(df, cols).where(F.col("value").isNotNull())
    vc = lng.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    if max_distinct is not None:  # columns of many values leave before anything is ranked
        few = vc.groupBy("column").agg(F.count(F.lit(1)).alias("__nd")).where(F.col("__nd") <= max_distinct)
        vc = vc.join(F.broadcast(few.select("column")), "column", "left_semi")
    w = Window.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))
    return vc.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


def iqr_outliers(df: DataFrame, cols: Sequence[str],
                 sentinel_cols: Sequence[str] = ("maximum_nights", "minimum_maximum_nights",
                                                 "maximum_maximum_nights"),
                 sentinel: int = S.INT_SENTINEL) -> DataFrame:
    """AG49: Tukey fences (Q1 - 1.5 IQR, Q3 + 1.5 IQR) and outlier counts per column.

    Sentinel values are removed first (and counted); fewer than 4 values ->
    null fences and zero outliers.
    """
    lng = _long(df, cols)
    is_sent = F.col("column").isin(list(sentinel_cols)) & (F.col("num") >= F.lit(float(sentinel)))
    lng = lng.select("column", F.when(~is_sent | is_sent.isNull(), F.col("num")).alias("num"),
                     F.coalesce(is_sent, F.lit(False)).alias("is_sentinel"))
    q = lng.groupBy("column").agg(
        F.count("num").alias("non_null"),
        F.count_if("is_sentinel").alias("sentinel_int_max_rows"))
    q = with_quantiles(q, lng, ["column"], {"__q1": ("num", 0.25), "__q3": ("num", 0.75)})
    iqr = F.col("__q3") - F.col("__q1")
    bounds = q.select("column", "non_null", "sentinel_int_max_rows",
                      F.when(F.col("non_null") >= 4, F.col("__q1") - 1.5 * iqr).alias("iqr_lower"),
                      F.when(F.col("non_null") >= 4, F.col("__q3") + 1.5 * iqr).alias("iqr_upper"))
    # one row per profiled column: bounded by len(cols)
    j = lng.join(F.broadcast(bounds), "column")
    cnt = j.groupBy("column").agg(F.count_if(F.col("num") < F.col("iqr_lower")).alias("low_outliers"),
                                  F.count_if(F.col("num") > F.col("iqr_upper")).alias("high_outliers"))
    return bounds.join(cnt, "column", "left").select(
        "column", "non_null", "iqr_lower", "iqr_upper",
        F.coalesce("low_outliers", F.lit(0)).alias("low_outliers"),
        F.coalesce("high_outliers", F.lit(0)).alias("high_outliers"), "sentinel_int_max_rows")


def rule_counts(df: DataFrame, source: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """PF19: violation counts of many domain rules in ONE pass, one row per rule."""
    agg = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, cond) in enumerate(rules)])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").cast("long").alias("violation_count"))
            for i, (name, _) in enumerate(rules)]
    return agg.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(source).alias("source_file"), "r.*")


def _num(c: str) -> Column:
    return F.col(c).cast("string").try_cast("double")


def _not_between(c: str, lo, hi) -> Column:
    """~between counting nulls as violations (as the reference's rule set does)."""
    return F.coalesce(~_num(c).between(lo, hi), F.lit(True))


def listing_domain_rules(raw: DataFrame, bbox: dict = LONDON_BBOX) -> DataFrame:
    """PF19 for raw listings (rules on columns that are present)."""
    price = S.clean_price("price")
    cand = [
        ("price_negative", "price", price < 0),
        ("price_zero", "price", price == 0),
        ("latitude_out_of_range", "latitude", _not_between("latitude", -90, 90)),
        ("longitude_out_of_range", "longitude", _not_between("longitude", -180, 180)),
        ("latitude_outside_city_bbox", "latitude", _not_between("latitude", *bbox["lat"])),
        ("longitude_outside_city_bbox", "longitude", _not_between("longitude", *bbox["lon"])),
        ("minimum_nights_le_zero", "minimum_nights", _num("minimum_nights") <= 0),
        ("minimum_nights_ge_365", "minimum_nights", _num("minimum_nights") >= 365),
        ("maximum_nights_int_max_sentinel", "maximum_nights", _num("maximum_nights") >= S.INT_SENTINEL),
        ("availability_30_out_of_range", "availability_30", _not_between("availability_30", 0, 30)),
        ("availability_60_out_of_range", "availability_60", _not_between("availability_60", 0, 60)),
        ("availability_90_out_of_range", "availability_90", _not_between("availability_90", 0, 90)),
        ("availability_365_out_of_range", "availability_365", _not_between("availability_365", 0, 365)),
        ("number_of_reviews_negative", "number_of_reviews", _num("number_of_reviews") < 0),
        ("accommodates_le_zero", "accommodates", _num("accommodates") <= 0),
        ("bedrooms_negative", "bedrooms", _num("bedrooms") < 0),
        ("beds_negative", "beds", _num("beds") < 0),
    ]
    rules = [(n, cond) for n, c, cond in cand if c in raw.columns]
    return rule_counts(raw, "listings", rules)


def calendar_domain_rules(raw: DataFrame) -> DataFrame:
    rules = [
        ("available_not_in_t_f", F.coalesce(~F.col("available").isin("t", "f"), F.lit(True))),
        ("minimum_nights_le_zero", _num("minimum_nights") <= 0),
        ("minimum_nights_ge_365", _num("minimum_nights") >= 365),
        ("maximum_nights_int_max_sentinel", _num("maximum_nights") >= S.INT_SENTINEL),
    ]
    return rule_counts(raw, "calendar", rules)


def exact_duplicate_rows(df: DataFrame) -> DataFrame:
    """AG51: extra copies of identical rows = rows - distinct rows (one row)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("__one", F.lit(1)).join(
        df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows")).withColumn("__one", F.lit(1)),
        "__one").select("rows", "distinct_rows",
                        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"))


def text_templates(df: DataFrame, text: str, top_n: int = 20) -> tuple[DataFrame, DataFrame]:
    """AG52: repeated texts after trim+lower: (summary row, top-n templates with preview).

    Grouping is on the full normalised text (Spark hashes it for the shuffle);
    a template with a third of all rows collapses in the partial aggregation.
    """
    norm = F.lower(F.trim(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    counts = df.groupBy(norm.alias("norm")).agg(F.count(F.lit(1)).alias("occurrences"))
    summary = counts.agg(
        F.coalesce(F.sum(F.when(F.col("occurrences") > 1, F.col("occurrences"))), F.lit(0))
        .cast("long").alias("duplicate_text_rows"),
        F.count_if(F.col("occurrences") > 1).alias("distinct_template_count"))
    top = (counts.orderBy(F.col("occurrences").desc(), F.col("norm")).limit(top_n)
           .select("occurrences", S.preview(F.col("norm"), 100).alias("preview")))
    return summary, top


def duplicate_blocks(df: DataFrame, block: Sequence[Column], id_col: str,
                     keep_cols: Sequence[str]) -> DataFrame:
    """Rows in blocks of >1 rows sharing all block keys (nulls equal), with block size."""
    names = [f"__b{i}" for i in range(len(block))]
    keyed = df.select(*keep_cols, *[b.alias(n) for b, n in zip(block, names)])
    sizes = (keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("block_size"))
             .where(F.col("block_size") > 1))
    sz = sizes.select(*[F.col(n).alias(n + "_") for n in names], "block_size")
    cond = None
    for n in names:
        c = keyed[n].eqNullSafe(sz[n + "_"])
        cond = c if cond is None else cond & c
    return keyed.join(sz, cond, "inner").select("block_size", *keep_cols)


def schema_compare(profile_a: DataFrame, profile_b: DataFrame, drift_pp: float = 10.0) -> DataFrame:
    """J10 + PF23: full outer join of two column profiles with presence and drift flags."""
    a = profile_a.select(F.col("column").alias("ca"), F.col("dtype").alias("dtype_a"),
                         F.col("null_pct").alias("null_pct_a"))
    b = profile_b.select(F.col("column").alias("cb"), F.col("dtype").alias("dtype_b"),
                         F.col("null_pct").alias("null_pct_b"))
    j = a.join(b, F.col("ca") == F.col("cb"), "full")
    presence = (F.when(F.col("ca").isNotNull() & F.col("cb").isNotNull(), "both")
                .when(F.col("ca").isNotNull(), "only_a").otherwise("only_b"))
    return j.select(F.coalesce("ca", "cb").alias("column"), presence.alias("presence"),
                    "dtype_a", "dtype_b", "null_pct_a", "null_pct_b",
                    (F.abs(F.col("null_pct_a") - F.col("null_pct_b")) > drift_pp).alias("null_rate_drift"),
                    (F.col("dtype_a") != F.col("dtype_b")).alias("dtype_mismatch"))


def name_parity(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Names only in a, only in b (both directions of EXCEPT), one row per name."""
    x = a.select(F.trim(F.col(col)).alias("name")).distinct()
    y = b.select(F.trim(F.col(col)).alias("name")).distinct()
    return (x.exceptAll(y).select(F.lit("only_a").alias("side"), "name")
            .unionByName(y.exceptAll(x).select(F.lit("only_b").alias("side"), "name")))


def bounded_sample(df: DataFrame, key: str, n: int = 2000) -> DataFrame:
    """IO5: deterministic first-n rows by key (a sample is the feature here)."""
    return df.orderBy(key).limit(n)


def completeness_rollup(profile: DataFrame, source_col: str = "source",
                        sparse_pct: float = 30.0) -> DataFrame:
    """AG54: per source, full / partial / fully-null columns and columns >= 30 % null."""
    return profile.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(F.col("null_count") == 0).alias("full_columns"),
        F.count_if((F.col("null_count") > 0) & (F.col("null_count") < F.col("rows"))).alias("partial_columns"),
        F.count_if(F.col("null_count") == F.col("rows")).alias("fully_null_columns"),
        F.count_if(F.col("null_pct") >= sparse_pct).alias("columns_ge_30pct_null"))
