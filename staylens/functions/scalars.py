"""Scalar cleaners and derived columns as Spark Column expressions.

All functions take and return ``Column`` objects and compile to built-in
expressions, so they stay inside whole-stage codegen. Raw text is never cast
with a bare ``cast``: Spark 4 runs in ANSI mode, where a bad cast raises.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------
TRUE_TOKENS = ["t", "true", "1", "yes", "y"]
FALSE_TOKENS = ["f", "false", "0", "no", "n"]
ROOM_TYPES = {
    "entire home/apt": "entire_home",
    "private room": "private_room",
    "shared room": "shared_room",
    "hotel room": "hotel_room",
}
INT_SENTINEL = 2 ** 30
# Property-type buckets: first matching bucket wins, substring match on the
# lower-cased text, empty/null text is "other".
PROPERTY_BUCKETS = [
    ("apartment", ["apartment", "condo", "loft", "studio", "rental unit"]),
    ("house", ["house", "home", "townhouse", "cottage", "bungalow", "villa"]),
    ("hotel", ["hotel", "hostel", "bed and breakfast", "aparthotel"]),
    ("unique", ["boat", "tent", "yurt", "treehouse", "barn", "cave", "tipi", "tower",
                "camper", "rv", "casa particular", "earthen", "windmill", "lighthouse",
                "shepherd"]),
]
INACTIVE_MIN_NIGHTS = 365
PROFESSIONAL_PORTFOLIO = 5
EARTH_RADIUS_KM = 6371.0
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> null (pandas treats NaN as missing; Spark orders NaN above all)."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def clean_price(c) -> Column:
    """SC1: keep digits, '.', '-' and parse; anything unparsable -> null."""
    stripped = F.regexp_replace(_c(c).cast("string"), r"[^0-9.\-]", "")
    return _try_double(stripped)


def _try_double(c: Column) -> Column:
    return nan_to_null(c.try_cast("double"))


def clean_percentage(c) -> Column:
    """SC2: '88%' -> 0.88."""
    return _try_double(F.replace(_c(c).cast("string"), F.lit("%"), F.lit(""))) / F.lit(100.0)


def parse_bool(c) -> Column:
    """SC3: t/true/1/yes/y -> true, f/false/0/no/n -> false, else null."""
    norm = F.lower(F.trim(_c(c).cast("string")))
    return (F.when(norm.isin(TRUE_TOKENS), F.lit(True))
            .when(norm.isin(FALSE_TOKENS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def parse_date(c) -> Column:
    """SC4: ISO date text -> date, invalid -> null."""
    return F.try_to_date(_c(c).cast("string"), "yyyy-MM-dd")


def validate_range(c, lo: float, hi: float) -> Column:
    """PF3: value outside [lo, hi] -> null."""
    v = _try_double(_c(c).cast("string"))
    return F.when(v.between(lo, hi), v)


def cap_sentinel(c, threshold: int = INT_SENTINEL) -> Column:
    """PF4: values >= threshold (INT_MAX-style sentinels) -> null, as long."""
    v = _try_double(_c(c).cast("string"))
    return F.when(v < F.lit(float(threshold)), v).cast("long")


def normalize_room_type(c) -> Column:
    """SC5: display name -> canonical code; unknown -> null."""
    norm = F.lower(F.trim(_c(c).cast("string")))
    mapping = F.create_map(*[F.lit(x) for kv in ROOM_TYPES.items() for x in kv])
    return mapping[norm]


def bucket_property_type(c) -> Column:
    """SC6: ordered substring rules -> apartment/house/hotel/unique/other."""
    s = F.lower(_c(c).cast("string"))
    expr = None
    for bucket, words in PROPERTY_BUCKETS:
        cond = None
        for w in words:
            hit = s.contains(w)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, F.lit(bucket)) if expr is None else expr.when(cond, F.lit(bucket))
    return F.when(s.isNull() | (s == ""), F.lit("other")).otherwise(expr.otherwise(F.lit("other")))


def parse_bathrooms(c) -> tuple[Column, Column]:
    """SC7: bathrooms text -> (count double, is_shared boolean).

    The first run of digits/dots is the count; 'half' with no number is 0.5.
    Shared flag: 'shared' -> true, else 'private' -> false, else null.
    """
    s = F.lower(F.trim(_c(c).cast("string")))
    num = F.regexp_extract(s, r"([\d.]+)", 1).try_cast("double")
    count = F.when(num.isNull() & s.contains("half"), F.lit(0.5)).otherwise(num)
    shared = (F.when(s.contains("shared"), F.lit(True))
              .when(s.contains("private"), F.lit(False))
              .otherwise(F.lit(None).cast("boolean")))
    return nan_to_null(count), shared


def trim_keep_null(c) -> Column:
    """SC8."""
    return F.trim(_c(c).cast("string"))


def normalise_name(c) -> Column:
    """SC9: trim, lower, collapse whitespace runs; null -> ''."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))),
                            r"\s+", " ")


def comment_length(c) -> Column:
    """SC10: length after null -> '' and trim."""
    return F.length(F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))).cast("long")


def preview(c, n: int = 100) -> Column:
    """SC11."""
    return F.substring(_c(c), 1, n)


def safe_ratio(num, den) -> Column:
    """num / den with den 0 or null -> null (SC12, SC29)."""
    d = _c(den)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(
        _c(num).cast("double") / d.cast("double"))


def years_between(later, earlier) -> Column:
    """SC13: whole days / 365.25 (double, not decimal)."""
    return F.datediff(_c(later), _c(earlier)).cast("double") / F.lit(365.25)


def is_weekend(c) -> Column:
    """SC18: Saturday or Sunday (Spark dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(_c(c)).isin(1, 7)


def date_key(c) -> Column:
    """SC19: yyyymmdd as int."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def month_bucket(c) -> Column:
    """SC20: first day of the month."""
    return F.trunc(_c(c), "MM")


def season(c) -> Column:
    """SC21: meteorological season of a date's month."""
    m = F.month(_c(c))
    return (F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer").otherwise("Autumn"))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """SC25: great-circle distance in km (R = 6371)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def json_string_list(c) -> Column:
    """SC26: JSON array text -> lower-cased array<string>; bad JSON -> []."""
    arr = F.from_json(_c(c), "array<string>")
    return F.coalesce(F.transform(arr, lambda x: F.lower(x)), F.array().cast("array<string>"))


def any_contains(arr, keywords) -> Column:
    """SC27: 1 when any element contains any keyword, else 0."""
    kws = [keywords] if isinstance(keywords, str) else list(keywords)

    def hit(x):
        cond = None
        for k in kws:
            h = x.contains(k)
            cond = h if cond is None else (cond | h)
        return cond

    return F.coalesce(F.exists(_c(arr), hit), F.lit(False)).cast("int")


def coerce_binary(c) -> Column:
    """SC30: bool / 't' / 'f' / 1 / 0 -> 0/1 int, null -> 0."""
    return F.coalesce(parse_bool(c).cast("int"), F.lit(0))


def bool_text(c) -> Column:
    """SC42: boolean -> 'true'/'false', null -> 'unknown'."""
    b = _c(c)
    return F.when(b, F.lit("true")).when(~b, F.lit("false")).otherwise(F.lit("unknown"))


def snake_case(name: str) -> str:
    """PF2: lower-case, non-alphanumeric runs -> '_', strip '_' (names only)."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def ascii_key(c) -> Column:
    """SC39: accent-folded, lower-cased, trimmed key.

    Latin accents are folded with ``translate``, which is exact for the
    Latin-1 / Latin Extended-A letters used by European place names.
    """
    src = ("ÀÁÂÃÄÅàáâãäåÇçÈÉÊËèéêëÌÍÎÏìíîïÑñÒÓÔÕÖØòóôõöøÙÚÛÜùúûüÝýÿ"
           "ĀāĂăĄąĆćČčĎďĒēĘęĚěĞğĪīıŁłŃńŇňŌōŐőŘřŚśŞşŠšŢţŤťŪūŮůŰűŹźŻżŽž")
    dst = ("AAAAAAaaaaaaCcEEEEeeeeIIIIiiiiNnOOOOOOooooooUUUUuuuuYyy"
           "AaAaAaCcCcDdEeEeEeGgIiiLlNnNnOoOoRrSsSsSsTtTtUuUuUuZzZzZz")
    folded = F.translate(_c(c).cast("string"), src, dst)
    folded = F.regexp_replace(F.regexp_replace(folded, "ß", "ss"), "[^\\x00-\\x7F]", "")
    return F.trim(F.lower(folded))


def mojibake_key(c) -> Column:
    """SC40: UTF-8 text whose bytes were read as Latin-1 -> re-decoded text; the trimmed text
    itself if it holds other letters or its bytes are no UTF-8."""
    text = _c(c).cast("string")
    latin = ~text.rlike("[^\\x{00}-\\x{FF}]")
    again = F.try_validate_utf8(F.encode(F.when(latin, text), "ISO-8859-1").cast("string"))
    return F.coalesce(again, F.trim(text))


def round_if_number(c, n: int) -> Column:
    """SC43: numeric text rounded half-even to n places; non-numeric -> null."""
    return F.bround(_c(c).cast("string").try_cast("double"), n)
