"""Models and segmentation on Spark MLlib (M3-M19, AG40-AG45, AG57, SC44, W6, W7).

Training data stays distributed: MLlib fits K-Means, linear and tree models
with per-partition statistics; only model parameters and per-k / per-model
metric rows (a handful) are seen by the driver.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from types import SimpleNamespace
from typing import Sequence

import numpy as np
from pyspark.ml import Pipeline as MLPipeline
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer, TargetEncoder,
                                VectorAssembler)
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from staylens.functions import bands as Bd
from staylens.operators import lloyd
from staylens.operators.features import column_medians
from staylens.operators.ordered import exact_quantiles, null_safe_join, ordered_index, with_quantiles
from staylens.session import release


# ------------------------------------------------------------------ scaling (M3)
def _logged(df: DataFrame, cols: Sequence[str], log_cols: Sequence[str]) -> DataFrame:
    return df.select("*", *[(F.log1p(F.col(c)) if c in log_cols else F.col(c).cast("double")).alias(f"__l_{c}")
                            for c in cols])


def scaler(df: DataFrame, cols: Sequence[str], log_cols: Sequence[str] = ()) -> DataFrame:
    """One row: mean and population deviation of each column, after log1p where asked."""
    x = _logged(df, cols, log_cols)
    return x.agg(*[F.avg(f"__l_{c}").alias(f"__mu_{c}") for c in cols],
                 *[F.stddev_pop(f"__l_{c}").alias(f"__sd_{c}") for c in cols])


def scaled(df: DataFrame, stats: DataFrame, cols: Sequence[str], log_cols: Sequence[str] = ()) -> DataFrame:
    """``z_<column>`` of each column by fitted ``scaler`` statistics; a constant gives 0."""
    j = null_safe_join(_logged(df, cols, log_cols), stats, [])
    return j.select(*df.columns, *[
        F.when(F.col(f"__sd_{c}") > 0, (F.col(f"__l_{c}") - F.col(f"__mu_{c}")) / F.col(f"__sd_{c}"))
        .otherwise(F.lit(0.0)).alias(f"z_{c}") for c in cols])


def log_scale(df: DataFrame, cols: Sequence[str], log_cols: Sequence[str] = ()) -> DataFrame:
    """log1p on skewed columns, then (x - mean) / population std, one aggregation."""
    return scaled(df, scaler(df, cols, log_cols), cols, log_cols)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


# ------------------------------------------------------------------ K-Means (M4-M6)
#: Initialisations of a fit, and the most that are tried while a larger k fits worse.
INITS, MOST_INITS = 3, 10


class FittedKMeans(KMeansModel):
    """MLlib's model of the centres of a fit, with its summary."""

    def __init__(self, fit: lloyd.Fit, spark: SparkSession):
        jvm, gateway = spark._jvm, spark.sparkContext._gateway
        centres = gateway.new_array(jvm.org.apache.spark.mllib.linalg.Vector, len(fit.centres))
        for j, c in enumerate(fit.centres.tolist()):
            values = gateway.new_array(jvm.double, len(c))
            for i, x in enumerate(c):
                values[i] = x
            centres[j] = jvm.org.apache.spark.mllib.linalg.DenseVector(values)
        parent = jvm.org.apache.spark.mllib.clustering.KMeansModel(centres, "euclidean", fit.cost, fit.steps)
        super().__init__(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{uuid.uuid4().hex[:12]}", parent))
        self.fit = fit

    @property
    def summary(self):
        return SimpleNamespace(k=self.fit.k, trainingCost=self.fit.cost, numIter=self.fit.steps)


class Fits:
    """K-Means fits over some vectors, each made once: starting centres by MLlib, then
    ``lloyd.run`` over blocks of the points that all fits share. ``close`` lets go of the points.

    Of a cached table MLlib keeps no points of its own: every step of finding the starting centres
    would read its rows and rebuild their vectors. The points are a table that isn't cached."""

    def __init__(self, vec: DataFrame):
        self.spark, self.vec, self.points, self.made = vec.sparkSession, vec, vec.select("features"), {}

    @cached_property
    def blocks(self):
        return lloyd.point_blocks(self.vec)

    @cached_property
    def count(self) -> int:
        return self.blocks.map(len).sum()

    def get(self, wanted: Sequence[tuple[int, int]]) -> list[lloyd.Fit]:
        """The fits of these (k, seed)."""
        def start(one):
            model = KMeans(k=one[0], seed=one[1], featuresCol="features", maxIter=0).fit(self.points)
            return lloyd.Fit(one[0], one[1], np.array(model.clusterCenters()))
        new = [w for w in wanted if w not in self.made]
        if new:
            with ThreadPoolExecutor(INITS) as pool:  # their small jobs fill each other's gaps
                started = list(pool.map(start, new))
            lloyd.run(self.blocks, started, self.count)
            self.made.update(zip(new, started))
        return [self.made[w] for w in wanted]

    def silhouettes(self, fits: Sequence[lloyd.Fit]) -> list[float]:
        return lloyd.silhouettes(self.blocks, fits, self.count)

    def close(self) -> None:
        if "blocks" in self.__dict__:
            self.blocks.unpersist()


def best_kmeans(vec: DataFrame, k: int, seed: int = 42, inits: int = INITS, below: float | None = None, fits: Fits | None = None):
    """The K-Means model of least cost over several initialisations. While it costs more than
    ``below`` (the cost for a smaller k), up to ``MOST_INITS`` are tried."""
    own = fits or Fits(vec)
    try:
        best = min(own.get([(k, seed + i) for i in range(inits)]), key=lambda f: f.cost)
        for i in range(inits, max(inits, MOST_INITS)):
            if below is None or best.cost <= below:
                break
            best = min(best, *own.get([(k, seed + i)]), key=lambda f: f.cost)
        return FittedKMeans(best, own.spark)
    finally:
        if fits is None:
            own.close()


def kmeans_sweep(vec: DataFrame, ks: Sequence[int], seed: int = 42, inits: int = INITS, fits: Fits | None = None) -> DataFrame:
    """M4 + W7: inertia and silhouette per k, percent drop of inertia vs previous k. The fits of all k
    run side by side; with ``fits`` they can be used again."""
    spark = vec.sparkSession
    own = fits or Fits(vec)
    try:
        own.get([(int(k), seed + i) for k in ks for i in range(inits)])
        found, below = [], None
        for k in ks:
            found.append(best_kmeans(vec, int(k), seed, inits, below, own).fit)
            below = found[-1].cost
        rows = [(f.k, f.cost, s) for f, s in zip(found, own.silhouettes(found))]
    finally:
        if fits is None:
            own.close()
    t = spark.createDataFrame(rows, "k int, inertia double, silhouette_sq double")
    w = Window.orderBy("k")  # a row per k
    prev = F.lag("inertia").over(w)
    return t.withColumn("pct_drop", F.try_divide(prev - F.col("inertia"), prev) * 100)


def choose_k(sweep_rows: list) -> int:
    """M5: the first k whose drop of inertia is under half of the first drop; the best
    silhouette if there is none, or if that k is 2 or less."""
    rows = sorted(sweep_rows, key=lambda r: r["k"])
    drops = [(r["k"], r["pct_drop"]) for r in rows if r["pct_drop"] is not None]
    found = next((k for k, drop in drops if drop < 0.5 * drops[0][1]), None)
    if found is None or found <= 2:
        return max(rows, key=lambda r: r["silhouette_sq"])["k"]
    return found


def fit_kmeans(vec: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """M6: final fit, cluster label attached to every row."""
    return best_kmeans(vec, k, seed).transform(vec).withColumnRenamed("prediction", "cluster")


def _ranked(prof: DataFrame, by: str, cluster: str) -> DataFrame:
    """Rank of the clusters by price (a window over one row per cluster), ties by cluster."""
    return prof.withColumn("price_rank", F.row_number().over(Window.orderBy(F.col(by), F.col(cluster))))


def cluster_profile(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """AG40 + AG42 + W6: per-cluster stats, size share, price rank (ties by cluster id)."""
    n_all = labelled.agg(F.count(F.lit(1)).alias("__n"))
    room = lambda r: (F.avg((F.col("room_type") == r).cast("double")) * 100).alias(
        f"pct_{'entire_home' if r == 'entire_home' else r}")
    prof = labelled.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("size"),
        *[F.avg(c).alias(f"mean_{n}") for n, c in (
            ("price", "price_numeric"), ("review_scores_rating", "review_scores_rating"),
            ("reviews_per_month", "reviews_per_month_calc"), ("availability_365", "availability_365"),
            ("accommodates", "accommodates"), ("bedrooms", "bedrooms"), ("minimum_nights", "minimum_nights"),
            ("distance_km", "distance_to_centre_km"), ("amenity_count", "amenity_count"))],
        *map(room, ("entire_home", "private_room", "shared_room", "hotel_room")),
        F.mode("room_type", deterministic=True).alias("modal_room_type"),
        F.mode("neighbourhood_cleansed", deterministic=True).alias("modal_neighbourhood"))
    prof = with_quantiles(prof, labelled, [cluster], {
        "median_price": ("price_numeric", 0.5), "median_minimum_nights": ("minimum_nights", 0.5),
        "median_distance_km": ("distance_to_centre_km", 0.5)})
    out = _ranked(null_safe_join(prof, n_all, []).withColumn("pct_of_city", F.col("size") * 100.0 / F.col("__n")),
                  "median_price", cluster)
    return out.drop("__n").withColumn("segment_name", segment_name())


def host_profile(labelled: DataFrame, cluster: str = "cluster") -> DataFrame:
    """AG41 + SC44: host clusters with means, medians, share, price rank and name."""
    n_all = labelled.agg(F.count(F.lit(1)).alias("__n"))
    means = [("listing_count", "listing_count"), ("avg_price", "avg_price"), ("tenure", "host_tenure_years"),
             ("response_rate", "host_response_rate"), ("acceptance_rate", "host_acceptance_rate"),
             ("availability", "avg_availability_365"), ("rating", "avg_review_scores_rating"),
             ("reviews_per_month", "avg_reviews_per_month"), ("accommodates", "avg_accommodates"),
             ("pct_entire_home", "pct_entire_home"), ("neighbourhood_count", "neighbourhood_count")]
    prof = labelled.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("hosts"), (F.avg("host_is_superhost") * 100).alias("pct_superhost"),
        *[F.avg(c).alias(f"mean_{n}") for n, c in means])
    prof = with_quantiles(prof, labelled, [cluster], {
        "median_listing_count": ("listing_count", 0.5), "median_avg_price": ("avg_price", 0.5)})
    out = null_safe_join(prof, n_all, []).withColumn("pct_of_city", F.col("hosts") * 100.0 / F.col("__n")).drop("__n")
    return _ranked(out, "median_avg_price", cluster).withColumn("cluster_name", host_segment_name())


def host_segment_name():
    """SC44 for hosts: ordered naming rules, then the tier of the price rank."""
    # Names, thresholds and their order.
    rules = [
        ((F.col("mean_response_rate") < 0.70) & (F.col("mean_acceptance_rate") < 0.50), "Passive Listers"),
        ((F.col("pct_superhost") >= 50) & (F.col("mean_listing_count") >= 2), "Professional Superhosts"),
        ((F.col("pct_superhost") >= 40) & (F.col("mean_reviews_per_month") > 1.5), "Active Superhost Operators"),
        ((F.col("mean_pct_entire_home") > 80) & (F.col("mean_availability") < 120)
         & (F.col("mean_reviews_per_month") < 0.5), "Part-Time Apartment Hosts"),
        (F.col("mean_availability") < 120, "Occasional Hosts")]
    tiers = F.array(*[F.lit(t) for t in ("Budget Hosts", "Mid-Range Hosts", "Premium Hosts", "Luxury Hosts")])
    return F.coalesce(*[F.when(test, F.lit(name)) for test, name in rules],
                      F.element_at(tiers, F.least(F.col("price_rank"), F.lit(4)).cast("int")))


def segment_name():
    """SC44: ordered naming rules on cluster statistics; price-rank tier fallback."""
    r, rpm = F.col("mean_review_scores_rating"), F.col("mean_reviews_per_month")
    av, acc = F.col("mean_availability_365"), F.col("mean_accommodates")
    dist, ent, mn = F.col("mean_distance_km"), F.col("pct_entire_home"), F.col("median_minimum_nights")
    pr = F.col("price_rank")
    # Segment names and tiers, in rule order.
    tiers = F.array(*[F.lit(t) for t in ["Budget Rooms", "Economy Apartments", "Standard Apartments",
                                          "Premium Apartments", "Luxury Listings"]])
    return (F.when(r < 4.0, "New & Unreviewed Listings")
            .when(rpm > 2.5, F.when(ent >= 50, "High-Turnover City Lets").otherwise("High-Turnover Private Rooms"))
            .when(av < 80, "Part-Time City Apartments")
            .when((acc > 4.0) & (ent >= 90),
                  F.when(pr <= 4, "Spacious Family Homes").otherwise("Premium Spacious Apartments"))
            .when((dist > 9) & (ent < 50), "Outer City Budget Rooms")
            .when((av > 250) & (ent >= 70), "Well-Available City Apartments")
            .when((dist < 7) & (ent >= 65) & (av < 200), "Standard City Apartments")
            .when((mn > 6) & (ent >= 60), "Weekly-Stay Apartments")
            .otherwise(F.element_at(tiers, F.least(pr, F.lit(5)).cast("int"))))


# ------------------------------------------------------------------ splits
def hash_bucket(key: str, buckets: int, seed: int = 42):
    """Deterministic bucket of a long key (multiplicative hash), same on every engine. The key is
    taken modulo 2^31 first, so that no product leaves 64 bits."""
    return F.pmod(F.pmod(F.col(key), F.lit(2147483648)) * F.lit(2654435761) + F.lit(seed), F.lit(4294967296)) % buckets


def group_split(df: DataFrame, group: str = "host_id", test_pct: int = 20, seed: int = 42) -> DataFrame:
    """M9: whole groups (hosts) go to train or test; ~test_pct % of groups in test."""
    return df.withColumn("is_test", hash_bucket(group, 100, seed) < test_pct)


# ------------------------------------------------------------------ price models
#: Categories replaced by their mean target in the training rows; the others become one-hot.
TARGET_ENCODED = ("neighbourhood_cleansed",)


def preprocess_stages(numeric: Sequence[str], categorical: Sequence[str]):
    """Scaled numerics, one-hot and target-encoded categories (unknown ones kept), all
    fitted on the rows the pipeline is fitted on."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep") for c in categorical]
    hot = [c for c in categorical if c not in TARGET_ENCODED]
    coded = [c for c in categorical if c in TARGET_ENCODED]
    stages = idx + [VectorAssembler(inputCols=list(numeric), outputCol="__numeric", handleInvalid="keep"),
                    StandardScaler(inputCol="__numeric", outputCol="__scaled", withMean=True, withStd=True)]
    inputs = ["__scaled"]
    if hot:
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in hot], outputCols=[f"{c}__ohe" for c in hot],
                                    handleInvalid="keep"))
        inputs += [f"{c}__ohe" for c in hot]
    if coded:
        stages.append(TargetEncoder(inputCols=[f"{c}__idx" for c in coded], outputCols=[f"{c}__mean" for c in coded],
                                    labelCol="log_price", targetType="continuous", handleInvalid="keep", smoothing=1.0))
        inputs += [f"{c}__mean" for c in coded]
    return stages + [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


#: Depth of the trees: 256 leaves at most in the forest, 64 in boosting.
FOREST_DEPTH, BOOSTING_DEPTH = 8, 6


def _modes(train: DataFrame, cols: Sequence[str]) -> dict:
    row = train.agg(*[F.mode(c, deterministic=True).alias(c) for c in cols]).first().asDict()
    return {c: v for c, v in row.items() if v is not None}


def regressor(kind: str, n_train: int | None = None, y_std: float | None = None):
    if kind == "ridge":
        # sklearn Ridge(alpha) == MLlib L2 with regParam = alpha * std(y) / n (standardization off)
        reg = 10.0 * (y_std or 1.0) / max(n_train or 1, 1)
        return LinearRegression(featuresCol="features", labelCol="log_price", regParam=reg,
                                elasticNetParam=0.0, standardization=False, solver="normal")
    if kind == "random_forest":
        return RandomForestRegressor(featuresCol="features", labelCol="log_price", numTrees=300,
                                     maxDepth=FOREST_DEPTH, minInstancesPerNode=3, seed=42)
    if kind == "gradient_boosting":
        return GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=500, stepSize=0.05,
                            maxDepth=BOOSTING_DEPTH, minInstancesPerNode=20, subsamplingRate=0.8, seed=42)
    raise ValueError(kind)


def training_fill(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """TRAINING medians and modes by column, for a row's missing inputs (null: no value at all)."""
    med = {c: None if v is None else float(v) for c, v in zip(numeric, column_medians(train, numeric).first())}
    return {**_modes(train, categorical), **med}


#: Rows that a task holds in boosting, where there are more than a task a core needs.
BOOSTING_TASK_ROWS = 250_000


def dealt_for_boosting(train: DataFrame, rows: int) -> DataFrame:
    """The rows in a partition a core, or more if one would hold over ``BOOSTING_TASK_ROWS``.

    Boosting runs over 3000 jobs of a level of a tree each, and every one starts a task for each
    partition. Rows are dealt and ordered by their values, so samples are the same in a run again."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-rows // BOOSTING_TASK_ROWS))
    return train.repartition(parts, *train.columns).sortWithinPartitions(*train.columns)


def fit_price_model(train: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str]):
    """The fitted pipeline and the values that stand for missing inputs. Medians and modes of the
    imputed rows are those of the given ones, so they are found once. ``train`` is read in every stage
    of the pipeline, so it should be a written table."""
    fill = training_fill(train, numeric, categorical)
    tr = train.select(*[F.coalesce(F.col(c), F.lit(fill[c]).cast("double")).alias(c) if c in numeric else F.col(c)
                        for c in train.columns]).fillna({c: fill[c] for c in categorical if c in fill})
    stats = tr.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("log_price").alias("sd")).first()
    pipe = MLPipeline(stages=preprocess_stages(numeric, categorical)
                      + [regressor(kind, stats["n"], stats["sd"])])
    rows = dealt_for_boosting(tr, stats["n"]).cache() if kind == "gradient_boosting" else tr
    model = pipe.fit(rows)
    if rows is not tr:
        rows.unpersist()
    return model, fill


def score(model, df: DataFrame, fill: dict) -> DataFrame:
    """Impute with TRAINING medians and modes (no leakage), predict, back-transform with expm1."""
    filled = df.fillna({c: v for c, v in fill.items() if v is not None})
    return model.transform(filled).withColumn("predicted_price", F.expm1("prediction"))


def regression_metrics(pred: DataFrame, actual: str = "price_numeric",
                       predicted: str = "predicted_price") -> DataFrame:
    """AG45: MAE, RMSE, MAPE, R2 and % within 20 % in ONE aggregation."""
    y, p = F.col(actual), F.col(predicted)
    e = p - y
    return pred.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(e) / y) * 100).alias("mape"),
        (1 - F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
        (F.avg((F.abs(e) / y <= 0.2).cast("double")) * 100).alias("pct_within_20"))


def residual_table(pred: DataFrame, actual: str = "price_numeric") -> DataFrame:
    """Residual, absolute and percentage error with segment columns."""
    r = F.col("predicted_price") - F.col(actual)
    return pred.select("*", r.alias("residual"), F.abs(r).alias("abs_error"),
                       (F.abs(r) / F.col(actual) * 100).alias("pct_error"),
                       Bd.band_lt(F.col(actual), Bd.PRICE_BANDS).alias("price_band"))


def segment_errors(res: DataFrame, segment: str) -> DataFrame:
    """AG43/AG44: n, MAE, median abs error, median residual, % within 20 %, % over-predicted."""
    agg = res.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"), F.avg("abs_error").alias("mae"),
        (F.avg((F.col("pct_error") <= 20).cast("double")) * 100).alias("pct_within_20"),
        (F.avg((F.col("residual") > 0).cast("double")) * 100).alias("pct_over_predicted"))
    return with_quantiles(agg, res, [segment], {"median_abs_error": ("abs_error", 0.5), "median_residual": ("residual", 0.5)})


def baseline_medians(train: DataFrame, test: DataFrame) -> DataFrame:
    """AG57: global median; per room type; per neighbourhood x room type with fallback."""
    g = column_medians(train, ["price_numeric"]).toDF("__g").withColumn("__one", F.lit(1))
    rt = exact_quantiles(train, ["room_type"], {"__rt": ("price_numeric", 0.5)})
    nr = exact_quantiles(train, ["neighbourhood_cleansed", "room_type"], {"__nr": ("price_numeric", 0.5)})
    t = (test.withColumn("__one", F.lit(1)).join(F.broadcast(g), "__one")
         .join(rt, "room_type", "left").join(nr, ["neighbourhood_cleansed", "room_type"], "left"))
    preds = [("global_median", F.col("__g")), ("room_type_median", F.coalesce("__rt", "__g")),
             ("neighbourhood_room_type_median", F.coalesce("__nr", "__rt", "__g"))]
    out = None
    for name, p in preds:
        m = regression_metrics(t.withColumn("predicted_price", p)).withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def permutation_importance(model, test: DataFrame, features: Sequence[str], fill: dict, repeats: int = 10, seed: int = 42) -> DataFrame:
    """MAE increase when one feature column is permuted, ``repeats`` times.

    Per repeat the test rows get a seeded random order (range-partitioned
    ``ordered_index``); feature f of row at id-position p takes the value of
    the row at random position ((p + offset_f) mod n) + 1 -- a permutation.
    All features of a repeat are scored in ONE pass: a copy of each row per
    feature, with that single column replaced, by one join. What moves in a
    repeat are the replacing values and their places alone: the rows are dealt
    by place once. A repeat is one job that returns a row per feature, so no
    plan grows with the repeats; its files go before the next one.
    """
    spark = test.sparkSession
    base_mae = regression_metrics(score(model, test, fill)).select(F.col("mae").alias("base_mae")).withColumn("__one", F.lit(1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_id = ordered_index(test, [F.col("id")], rn_col="__pid").repartition(parts, "__pid").persist()
    whole = {f for f in features if isinstance(test.schema[f].dataType, LongType)}  # doubles don't hold them all
    rows = []
    for r in range(repeats):
        src = ordered_index(test.select("id", *features, F.rand(seed + r).alias("__r")),
                            [F.col("__r"), F.col("id")], rn_col="__rpos", total_col="__n")

        def moved(i, f):
            to = F.pmod(F.col("__rpos") - 1 - F.lit((i * 7919 + r * 104729) + 1), F.col("__n"))
            value, none = F.col(f), F.lit(None)
            return F.struct(F.when(to == 0, F.col("__n")).otherwise(to).alias("__pid"), F.lit(i).alias("__i"),
                            (value if f in whole else none).cast("bigint").alias("__long"),
                            (none if f in whole else value).cast("double").alias("__double"))
        values = src.select(F.explode(F.array(*[moved(i, f) for i, f in enumerate(features)])).alias("m")).select("m.*")
        copies = by_id.join(values, "__pid")
        at = {f: F.col("__i") == i for i, f in enumerate(features)}
        copies = copies.select(F.element_at(F.array(*map(F.lit, features)), F.col("__i") + 1).alias("feature"), *[
            F.when(at[c], F.col("__long" if c in whole else "__double").cast(test.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in features else F.col(c) for c in test.columns])
        e = F.abs(F.col("predicted_price") - F.col("price_numeric"))
        scored = score(model, copies, fill).groupBy("feature").agg(F.avg(e).alias("mae"))
        rows += [(m["feature"], r, m["mae"]) for m in scored.collect()]
        del src, values, copies, scored
        release(spark)
    by_id.unpersist()
    out = test.sparkSession.createDataFrame(rows, "feature string, repeat int, mae double")
    agg = out.groupBy("feature").agg(F.avg("mae").alias("permuted_mae"), F.stddev("mae").alias("std_mae"))
    return agg.withColumn("__one", F.lit(1)).join(F.broadcast(base_mae), "__one").select(
        "feature", (F.col("permuted_mae") - F.col("base_mae")).alias("mae_increase"), "std_mae")


def reliability_flags(pred: DataFrame) -> DataFrame:
    """Batch scoring warnings (prediction above 500; hotel rooms)."""
    w = F.array_compact(F.array(
        F.when(F.col("predicted_price") > 500, F.lit("prediction above 500: low reliability")),
        F.when(F.col("room_type") == "hotel_room", F.lit("hotel rooms are under-represented"))))
    return pred.withColumn("warnings", w)


def assign_clusters(model, stats: DataFrame, medians: DataFrame, df: DataFrame, cols: Sequence[str],
                    log_cols: Sequence[str] = ()) -> DataFrame:
    """M8: impute by the training medians, list the imputed fields, scale by the fitted scaler,
    predict with the fitted model."""
    imputed = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    j = null_safe_join(df.withColumn("imputed_fields", imputed), medians, [])
    filled = j.select(*[F.coalesce(F.col(c), F.col(f"__m_{c}")).alias(c) if c in cols else F.col(c)
                        for c in df.columns], "imputed_fields")
    vec = assemble(scaled(filled, stats, cols, log_cols), [f"z_{c}" for c in cols])
    return model.transform(vec).withColumnRenamed("prediction", "cluster")
