"""Band (bucket) definitions as ordered rule lists and their Column builders.

Fixed values: labels and edges of the reference's bands, in natural order.
A band is ``(label, upper_bound_inclusive)``; the last band has bound None.
Null input gives a null band (the reference put nulls in the last band; we
keep missing values distinguishable).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST_SEGMENT_BANDS = [("solo", 1), ("multi", 4), ("professional", None)]
HOST_SEGMENT_BANDS_4 = [("1 listing", 1), ("2-5 listings", 5), ("6-20 listings", 20),
                        ("21+ listings", None)]
AVAILABILITY_BANDS = [("Blocked / inactive  (0-30 d)", 30), ("Occasional  (31-90 d)", 90),
                      ("Active  (91-270 d)", 270), ("Always-on  (271-365 d)", None)]
TENURE_BANDS = [("New  (0-2 yr)", 2), ("Established  (2-5 yr)", 5),
                ("Experienced  (5-10 yr)", 10), ("Veteran  (10+ yr)", None)]
DISTANCE_BANDS = [("0-2 km", 2), ("2-5 km", 5), ("5-10 km", 10), ("10-20 km", 20),
                  ("20+ km", None)]
# right-closed bins (lo, hi]
RESPONSE_RATE_BINS = [("0-50%", -0.001, 0.50), ("51-80%", 0.50, 0.80),
                      ("81-95%", 0.80, 0.95), ("96-100%", 0.95, 1.001)]
REVIEW_COUNT_BUCKETS = [("0", 0), ("1-5", 5), ("6-20", 20), ("21-100", 100), ("100+", None)]
PRICE_BANDS = [("<75", 75), ("75-135", 135), ("135-250", 250), ("250-500", 500), ("500+", None)]


def band(c: Column, bands) -> Column:
    """Ordered upper-bound bands: first band whose bound is >= value."""
    expr = None
    for label, hi in bands:
        cond = F.lit(True) if hi is None else (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(c.isNotNull(), expr)


def band_lt(c: Column, bands) -> Column:
    """Ordered strict upper-bound bands (value < bound)."""
    expr = None
    for label, hi in bands:
        cond = F.lit(True) if hi is None else (c < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(c.isNotNull(), expr)


def cut(c: Column, bins) -> Column:
    """SC36: right-closed bins ``lo < x <= hi``; outside all bins -> null."""
    expr = None
    for label, lo, hi in bins:
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def band_rank(c: Column, labels) -> Column:
    """Explicit category order as a sortable rank column."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), c)


def labels(bands) -> list[str]:
    return [b[0] for b in bands]
