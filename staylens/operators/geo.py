"""Geospatial operators (GE1-GE4, J12) as column expressions.

Areas use the Lambert cylindrical equal-area projection on a sphere of radius
6371 km (x = R*lon, y = R*sin(lat), radians): it preserves area exactly, so the
planar shoelace formula on projected rings gives spherical-polygon areas for
lat/lon-aligned edges; centroids are shoelace centroids mapped back to WGS84.
Everything runs per feature row with higher-order functions; the only shuffle
is the per-feature sum over polygon rings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.scalars import EARTH_RADIUS_KM, haversine_km

R = EARTH_RADIUS_KM


def _ring_sums(ring: Column) -> tuple[Column, Column, Column]:
    """Shoelace cross sum and centroid moments of one closed ring of [lon, lat]."""
    idx = F.sequence(F.lit(0), F.size(ring) - 2)

    def xy(i):
        p = ring[i]
        return F.radians(p[0]) * F.lit(R), F.sin(F.radians(p[1])) * F.lit(R)

    def term(kind):
        def f(acc, i):
            x0, y0 = xy(i)
            x1, y1 = xy(i + 1)
            cross = x0 * y1 - x1 * y0
            if kind == "a":
                return acc + cross
            if kind == "x":
                return acc + (x0 + x1) * cross
            return acc + (y0 + y1) * cross
        return F.aggregate(idx, F.lit(0.0), f)

    return term("a"), term("x"), term("y")


def polygon_metrics(features: DataFrame, name: str = "neighbourhood",
                    coords: str = "coordinates") -> DataFrame:
    """GE1: area_km2 and centroid (lat, lon) of MultiPolygon features.

    Ring 0 of each polygon is the shell, further rings are holes.
    """
    polys = features.select(F.col(name), F.posexplode(F.col(coords)).alias("__pi", "__poly"))
    rings = polys.select(name, "__pi", F.posexplode("__poly").alias("__ri", "__ring"))
    a, mx, my = _ring_sums(F.col("__ring"))
    rings = rings.select(name, "__ri", (a / 2).alias("__a"), (mx / 6).alias("__mx"),
                         (my / 6).alias("__my"))
    sign = F.when(F.col("__ri") == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    orient = F.signum(F.col("__a"))
    eff = rings.select(name, (sign * F.abs(F.col("__a"))).alias("__ea"),
                       (sign * orient * F.col("__mx")).alias("__emx"),
                       (sign * orient * F.col("__my")).alias("__emy"))
    agg = eff.groupBy(name).agg(F.sum("__ea").alias("area_km2"), F.sum("__emx").alias("__mx"),
                                F.sum("__emy").alias("__my"))
    cx = F.col("__mx") / F.col("area_km2")
    cy = F.col("__my") / F.col("area_km2")
    return agg.select(
        F.col(name),
        F.degrees(F.asin(cy / F.lit(R))).alias("centroid_latitude"),
        F.degrees(cx / F.lit(R)).alias("centroid_longitude"),
        F.col("area_km2"))


def density(count: Column, area: Column) -> Column:
    """GE2: count per km2, null for zero/unknown area."""
    return F.when(area.isNull() | (area == 0), F.lit(None).cast("double")).otherwise(
        count.cast("double") / area)


def valid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """PF22: rows with plausible WGS84 coordinates."""
    return df.where(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def distance_to(df: DataFrame, lat0: float, lon0: float, lat: str = "latitude",
                lon: str = "longitude", out: str = "distance_km") -> DataFrame:
    """GE3 helper: great-circle distance of each row to a fixed centre."""
    return df.withColumn(out, haversine_km(F.col(lat), F.col(lon), F.lit(lat0), F.lit(lon0)))


def fallback_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      value_cols: list[str]) -> DataFrame:
    """Attach right-side values by exact name, else mojibake form, else ASCII key.

    Three left joins on alternate keys (right keys that stand twice are left out),
    first hit wins via ``coalesce``. Right is a per-name table (one row per
    neighbourhood), so each join keeps the left row count.
    """
    from staylens.functions.scalars import ascii_key, mojibake_key

    def side(keyexpr, tag):
        r = right.select(keyexpr.alias(f"__k{tag}"), *[F.col(v).alias(f"__{tag}_{v}") for v in value_cols])
        # keep a key only when it is unambiguous
        alone = r.groupBy(f"__k{tag}").agg(F.count(F.lit(1)).alias("__n")).where("__n = 1").select(f"__k{tag}")
        return r.join(alone, f"__k{tag}")

    l = left.withColumn("__ke", F.col(left_key)) \
            .withColumn("__km", mojibake_key(F.col(left_key))) \
            .withColumn("__ka", ascii_key(F.col(left_key)))
    e = side(F.col(right_key), "e")
    m = side(F.col(right_key), "m")
    a = side(ascii_key(F.col(right_key)), "a")
    j = (l.join(e, l["__ke"] == e["__ke"], "left")
          .join(m, l["__km"] == m["__km"], "left")
          .join(a, l["__ka"] == a["__ka"], "left"))
    out = [F.col(c) for c in left.columns]
    for v in value_cols:
        out.append(F.coalesce(F.col(f"__e_{v}"), F.col(f"__m_{v}"), F.col(f"__a_{v}")).alias(v))
    out.append(F.when(F.col("__e_" + value_cols[0]).isNotNull(), "exact")
               .when(F.col("__m_" + value_cols[0]).isNotNull(), "mojibake")
               .when(F.col("__a_" + value_cols[0]).isNotNull(), "ascii").alias("match_kind"))
    return j.select(*out)


def geojson_features(metrics: DataFrame, geometry: DataFrame, name: str = "neighbourhood",
                     props: list[str] | None = None) -> DataFrame:
    """GE4 / IO9: one GeoJSON Feature (JSON text) per neighbourhood with metrics."""
    props = props or [c for c in metrics.columns if c != name]
    j = geometry.join(metrics, name, "left")
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("geometry_type").alias("type"), F.col("coordinates")).alias("geometry"),
        F.struct(F.col(name), *[F.col(p) for p in props]).alias("properties")))
    return j.select(F.col(name), feature.alias("feature"))
