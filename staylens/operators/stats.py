"""Hypothesis tests and OLS as distributed sufficient statistics (H1-H9).

Spark reduces the data to a handful of numbers per test (counts, means,
variances, rank sums, tie sums, Gram matrices); tail probabilities come from
``staylens.functions.statmath`` applied to those numbers through pandas UDFs,
so every test stays a lazy DataFrame.

Ranks with ties use a value-count table: (value, count) rows are
range-sorted with running counts (``ordered_index``), the average rank of a
value is ``cum_before + (count + 1) / 2``, and per-group rank sums join the
group's counts per value back to it -- no single-partition window.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions import statmath as SM
from staylens.operators.ordered import ordered_index


# ------------------------------------------------------------------ UDFs (per-test rows only)
@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([SM.t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) and b > 0 else np.nan
                      for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def normal_p_value(z: pd.Series) -> pd.Series:
    return pd.Series([SM.two_sided_normal_p(a) if pd.notna(a) else np.nan for a in z])


@F.pandas_udf(T.DoubleType())
def chi2_p_value(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([SM.chi2_sf(a, b) if pd.notna(a) and pd.notna(b) and b > 0 else np.nan
                      for a, b in zip(x, k)])


@F.pandas_udf(T.DoubleType())
def t_quantile_975(df: pd.Series) -> pd.Series:
    return pd.Series([SM.t_ppf(0.975, b) if pd.notna(b) and b > 0 else np.nan for b in df])


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("__one", F.lit(1))


# ------------------------------------------------------------------ Welch t (H1, H2)
def welch_stats(df: DataFrame, value: str, group: Column, a_label: str = "a",
                b_label: str = "b") -> DataFrame:
    """Per-test row: n, means, variances, Welch t, Welch-Satterthwaite df, Cohen d,
    and the 95 % CI of the mean difference (H2)."""
    g = df.where(F.col(value).isNotNull() & group.isNotNull()).select(
        F.col(value).alias("x"), group.alias("g"))
    agg = g.agg(
        F.count(F.when(F.col("g"), F.col("x"))).alias("n1"),
        F.avg(F.when(F.col("g"), F.col("x"))).alias("m1"),
        F.var_samp(F.when(F.col("g"), F.col("x"))).alias("v1"),
        F.count(F.when(~F.col("g"), F.col("x"))).alias("n2"),
        F.avg(F.when(~F.col("g"), F.col("x"))).alias("m2"),
        F.var_samp(F.when(~F.col("g"), F.col("x"))).alias("v2"))
    se2 = F.try_divide("v1", "n1") + F.try_divide("v2", "n2")
    # without variance or with fewer than two values in a group the test is undefined: null
    t = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(se2))
    dof = F.try_divide(F.pow(se2, 2), F.try_divide(F.pow(F.try_divide("v1", "n1"), 2), F.col("n1") - 1)
                       + F.try_divide(F.pow(F.try_divide("v2", "n2"), 2), F.col("n2") - 1))
    d = F.try_divide(F.col("m1") - F.col("m2"), F.sqrt((F.col("v1") + F.col("v2")) / 2))
    return agg.select(F.lit(a_label).alias("group_a"), F.lit(b_label).alias("group_b"),
                      "n1", "n2", "m1", "m2", "v1", "v2", t.alias("statistic"), dof.alias("dof"),
                      d.alias("effect_size"), (F.col("m1") - F.col("m2")).alias("mean_diff"),
                      F.sqrt(se2).alias("se_diff"))


def welch_test(df: DataFrame, value: str, group: Column, a_label="a", b_label="b") -> DataFrame:
    s = welch_stats(df, value, group, a_label, b_label)
    tq = t_quantile_975(F.col("dof"))
    return s.select("*", t_p_value(F.col("statistic"), F.col("dof")).alias("p_value"),
                    (F.col("mean_diff") - tq * F.col("se_diff")).alias("ci_low"),
                    (F.col("mean_diff") + tq * F.col("se_diff")).alias("ci_high"))


# ------------------------------------------------------------------ ranks
def value_ranks(values: DataFrame, value: str = "v") -> DataFrame:
    """Average rank of each distinct value (ties share the mean rank) + tie size."""
    vc = values.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).cast("double").alias("t"))
    idx = ordered_index(vc, [F.col("v")], rn_col="__rn", value_col="t", cum_col="__cum")
    return idx.select("v", "t", (F.col("__cum") - F.col("t") + (F.col("t") + 1) / 2).alias("avg_rank"))


def rank_sums(df: DataFrame, value: str, group: Column) -> DataFrame:
    """Per group: n and rank sum over the pooled sample; plus pooled tie term."""
    base = df.where(F.col(value).isNotNull() & group.isNotNull()).select(
        F.col(value).alias("v"), group.alias("g"))
    ranks = value_ranks(base)
    per = base.groupBy("v", "g").agg(F.count(F.lit(1)).alias("c"))
    j = per.join(ranks, "v")
    return j.groupBy("g").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("avg_rank")).alias("rank_sum")), \
        ranks.agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie_term"),
                  F.sum("t").alias("N"))


def mann_whitney(df: DataFrame, value: str, group: Column) -> DataFrame:
    """H3: U of the ``True`` group, tie-corrected normal approximation with
    continuity correction, rank-biserial r = 2U/(n1 n2) - 1."""
    sums, ties = rank_sums(df, value, group)
    a = sums.where(F.col("g")).select(F.col("n").alias("n1"), F.col("rank_sum").alias("r1"))
    b = sums.where(~F.col("g")).select(F.col("n").alias("n2"))
    j = _one(a).join(_one(b), "__one").join(_one(ties), "__one")
    n1, n2, N = F.col("n1"), F.col("n2"), F.col("N")
    u = F.col("r1") - n1 * (n1 + 1) / 2
    mu = n1 * n2 / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((N + 1) - F.try_divide(F.col("tie_term"), N * (N - 1))))
    z = F.try_divide(F.abs(u - mu) - 0.5, sigma)
    return j.select("n1", "n2", u.alias("statistic"), z.alias("z"),
                    normal_p_value(z).alias("p_value"),
                    (F.try_divide(2 * u, n1 * n2) - 1).alias("effect_size"))


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """H4: tie-corrected H over the given groups, epsilon^2 effect size."""
    sums, ties = rank_sums(df, value, F.col(group))
    s = sums.agg(F.sum(F.pow(F.col("rank_sum"), 2) / F.col("n")).alias("s"),
                 F.count(F.lit(1)).alias("k"))
    j = _one(s).join(_one(ties), "__one")
    N = F.col("N")
    h0 = 12 / (N * (N + 1)) * F.col("s") - 3 * (N + 1)
    h = F.try_divide(h0, 1 - F.try_divide(F.col("tie_term"), F.pow(N, 3) - N))
    return j.select(N.cast("long").alias("n_total"), F.col("k").alias("groups"), h.alias("statistic"),
                    chi2_p_value(h, F.col("k") - 1).alias("p_value"),
                    F.try_divide(h - F.col("k") + 1, N - F.col("k")).alias("effect_size"))


def wilcoxon_signed_rank(pairs: DataFrame, diff: str = "diff") -> DataFrame:
    """H6: paired signed-rank test on non-zero differences (normal approx, tie-corrected),
    with Cohen d of the differences and the 95 % t-interval of the mean difference."""
    d = pairs.where(F.col(diff).isNotNull() & (F.col(diff) != 0)).select(F.col(diff).alias("d"))
    ranks = value_ranks(d.select(F.abs("d").alias("a")), "a")
    # tied differences are counted before the join: a value meets its rank once
    counts = d.groupBy("d").agg(F.count(F.lit(1)).alias("c"))
    j = counts.join(ranks, F.abs(F.col("d")) == F.col("v"))
    w = j.agg(F.sum(F.when(F.col("d") > 0, F.col("avg_rank") * F.col("c")).otherwise(0.0)).alias("w_plus"),
              F.coalesce(F.sum("c"), F.lit(0)).alias("n"))
    ties = ranks.agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie_term"))
    st = pairs.where(F.col(diff).isNotNull()).agg(F.avg(diff).alias("mean_diff"),
                                                  F.stddev_samp(diff).alias("sd_diff"),
                                                  F.count(F.lit(1)).alias("n_pairs"))
    x = _one(w).join(_one(ties), "__one").join(_one(st), "__one")
    n = F.col("n").cast("double")  # n * n * n leaves 64 bits from two million pairs on
    mu = n * (n + 1) / 4
    sigma = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("tie_term") / 48)
    z = F.try_divide(F.col("w_plus") - mu, sigma)
    tq = t_quantile_975(F.col("n_pairs") - 1)
    half = tq * F.col("sd_diff") / F.sqrt(F.col("n_pairs"))
    return x.select("n", "n_pairs", F.col("w_plus").alias("statistic"), z.alias("z"),
                    normal_p_value(z).alias("p_value"),
                    F.try_divide("mean_diff", "sd_diff").alias("effect_size"),
                    "mean_diff", (F.col("mean_diff") - half).alias("ci_low"),
                    (F.col("mean_diff") + half).alias("ci_high"))


# ------------------------------------------------------------------ OLS with HC3 (H8)
def design_matrix(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str],
                  levels: dict[str, list]) -> tuple[DataFrame, list[str]]:
    """Rows (y, x0..xp-1): intercept, numeric columns, treatment dummies (first level dropped)."""
    names = ["Intercept"] + list(numeric)
    xs = [F.lit(1.0)] + [F.col(c).cast("double") for c in numeric]
    for c in categorical:
        for lv in levels[c][1:]:
            names.append(f"C({c})[T.{lv}]")
            xs.append(F.when(F.col(c) == F.lit(lv), 1.0).otherwise(0.0))
    cols = [F.col(y).cast("double").alias("y")] + [x.alias(f"x{i}") for i, x in enumerate(xs)]
    keep = df.dropna(subset=[y, *numeric, *categorical])
    return keep.select(*cols), names


def _gram_partials(X: DataFrame, p: int, weights_inv: np.ndarray | None, beta: np.ndarray | None):
    """Per-task partial sums: X'X, X'y, y'y, n (pass 1) or HC3 meat + SSR (pass 2)."""
    size = p * p + p + 2

    def part(batches):
        acc = np.zeros(size)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            y = pdf["y"].to_numpy()
            x = pdf[[f"x{i}" for i in range(p)]].to_numpy()
            if weights_inv is None:
                acc[:p * p] += (x.T @ x).ravel()
                acc[p * p:p * p + p] += x.T @ y
                acc[-2] += y @ y
                acc[-1] += len(y)
            else:
                e = y - x @ beta
                h = np.einsum("ij,jk,ik->i", x, weights_inv, x)
                w = (e / (1.0 - h)) ** 2
                acc[:p * p] += (x.T @ (x * w[:, None])).ravel()
                acc[-2] += e @ e
                acc[-1] += len(y)
        yield pd.DataFrame({"k": np.arange(size, dtype=np.int32), "v": acc})

    return X.mapInPandas(part, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))


def ols_hc3(df: DataFrame, y: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """H8: OLS with treatment dummies and HC3 standard errors.

    Two passes over the data: (1) X'X, X'y by per-task partial sums; the
    p x p system is solved on the driver (p ~ 40); (2) residuals, leverages
    h = x'(X'X)^-1 x with the broadcast inverse, and the HC3 meat. Category
    levels are read from the data (bounded: one row per level).
    """
    spark = df.sparkSession
    levels = {c: sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().collect())
              for c in categorical}
    X, names = design_matrix(df, y, numeric, categorical, levels)
    p = len(names)
    g1 = {r["k"]: r["v"] for r in _gram_partials(X, p, None, None).collect()}
    v = np.array([g1[i] for i in range(p * p + p + 2)])
    xtx = v[:p * p].reshape(p, p)
    xty = v[p * p:p * p + p]
    yty, n = v[-2], v[-1]
    inv = np.linalg.pinv(xtx)
    beta = inv @ xty
    g2 = {r["k"]: r["v"] for r in _gram_partials(X, p, inv, beta).collect()}
    w = np.array([g2[i] for i in range(p * p + p + 2)])
    meat = w[:p * p].reshape(p, p)
    ssr = w[-2]
    cov = inv @ meat @ inv
    se = np.sqrt(np.diag(cov))
    ybar = xty[0] / n
    sst = yty - n * ybar * ybar
    r2 = 1 - ssr / sst
    dof = n - p
    adj = 1 - (1 - r2) * (n - 1) / dof
    rows = []
    tq = SM.t_ppf(0.975, dof)
    for i, name in enumerate(names):
        t = beta[i] / se[i] if se[i] > 0 else float("nan")
        pv = SM.t_two_sided_p(t, dof) if math.isfinite(t) else float("nan")
        rows.append((name, float(beta[i]), float(se[i]), float(t), float(pv),
                     float(beta[i] - tq * se[i]), float(beta[i] + tq * se[i]), bool(pv < 0.05),
                     float(r2), float(adj), int(n), int(p)))
    schema = ("term string, coefficient double, std_err double, t_stat double, p_value double, "
              "ci_low double, ci_high double, significant boolean, r2 double, adj_r2 double, "
              "n_obs long, n_params int")
    return spark.createDataFrame(rows, schema)
