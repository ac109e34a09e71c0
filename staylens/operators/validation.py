"""Declarative expectations evaluated in one tagged pass.

An expectation is a small dict. ``run_suites`` turns those of all suites into row measures and
keys of ``rulebook`` tables, so that all tables are read once and uniqueness shares one shuffle, and
gives result rows: expectation, column, success, observed value, element count, unexpected count
and percentage.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators import rulebook as R

def expect(kind: str, column: str | None = None, **kw) -> dict:
    return {"kind": kind, "column": column, **kw}


def _between(c: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _unexpected(e: dict) -> Column:
    x = F.col(e["column"])
    if e["kind"] == "not_null":
        return x.isNull().cast("int")
    if e["kind"] == "in_set":
        return R.failing(x.isin(list(e["values"])))
    if e["kind"] == "between":
        return R.failing(_between(x, e.get("min"), e.get("max")))
    raise ValueError(f"unknown expectation {e['kind']}")


def _static(e: dict, columns: set) -> tuple[bool, str] | None:
    """Success and observation of what the column names alone decide."""
    c = e["column"]
    if e["kind"] == "column_set":
        want = set(e["columns"])
        lost = sorted(want ^ columns if e.get("exact") else want - columns)
        return not lost, ",".join(lost) or "all present"
    if e["kind"] == "column_exists":
        return c in columns, "present" if c in columns else "missing"
    if c is not None and c not in columns:
        return False, "column missing"
    return None


def run_suites(suites: dict[str, tuple[DataFrame, Sequence[dict]]]) -> DataFrame:
    """One row per suite and expectation: success, observed, element and unexpected counts."""
    tables = []
    for suite, (df, expectations) in suites.items():
        live = [(i, e) for i, e in enumerate(expectations) if _static(e, set(df.columns)) is None]
        sums: dict[str, Column] = {}
        for i, e in live:
            if e["kind"] not in ("unique", "row_count_between"):
                sums[f"unexpected {i}"] = _unexpected(e)
            if e["kind"] not in ("not_null", "row_count_between"):
                sums[f"present {e['column']}"] = F.col(e["column"]).isNotNull().cast("int")
        keys = {f"{suite}.{e['column']}": [e["column"]] for _, e in live if e["kind"] == "unique"}
        tables.append(R.Table(suite, df, keys, sums))
    found, none = R.figures(tables), F.lit(None).cast("bigint")
    cells = []
    for suite, (df, expectations) in suites.items():
        for i, e in enumerate(expectations):
            c, kind = e["column"], e["kind"]
            fixed = _static(e, set(df.columns))
            rows, elements, unexpected, share = found.rows(suite), none, none, F.lit(None).cast("double")
            if fixed:
                ok, observed = F.lit(fixed[0]), F.lit(fixed[1])
            elif kind == "row_count_between":
                ok, observed, elements = _between(rows, e.get("min"), e.get("max")), rows.cast("string"), rows
                unexpected, share = F.lit(0).cast("bigint"), F.lit(0.0)
            else:
                elements = rows if kind == "not_null" else found.measure(suite, f"present {c}")
                unexpected = found.copies(suite, f"{suite}.{c}") if kind == "unique" else found.measure(suite, f"unexpected {i}")
                share = F.when(elements > 0, unexpected * 100.0 / elements).otherwise(0.0)
                # whole numbers of a thousandth, so that no engine's rounding decides
                allowed = 1000 - round(1000 * e.get("mostly", 1.0))
                ok, observed = 1000 * unexpected <= allowed * elements, unexpected.cast("string")
            cells.append(F.struct(F.lit(suite).alias("suite"), F.lit(i).alias("idx"), F.lit(kind).alias("expectation"),
                                  F.lit(c).cast("string").alias("column"), ok.alias("success"), observed.alias("observed"),
                                  elements.alias("element_count"), unexpected.cast("bigint").alias("unexpected_count"),
                                  share.alias("unexpected_pct")))
    return found.df.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def run_expectations(df: DataFrame, suite: str, expectations: Sequence[dict]) -> DataFrame:
    """V1-V7: evaluate one suite; one output row per expectation."""
    return run_suites({suite: (df, expectations)})


def suite_summary(results: DataFrame) -> DataFrame:
    """V8 / AG56: passed / failed counts per suite."""
    return results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"))


def orphan_count(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key has no dimension row (anti join), as a one-row count."""
    d = dim.select(F.col(dim_key).alias("__dk")).distinct()
    return fact.join(d, F.col(fact_key) == F.col("__dk"), "left_anti").agg(
        F.count(F.lit(1)).alias("orphans"))


def date_dimension_checks(dim_date: DataFrame, date: str = "date", key: str = "date_key") -> DataFrame:
    """Continuity (max - min + 1 = rows), unique keys, coverage bounds."""
    return dim_date.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"),
        F.min(date).alias("min_date"), F.max(date).alias("max_date"),
        (F.datediff(F.max(date), F.min(date)) + 1 == F.count(F.lit(1))).alias("is_continuous"))


# Rule-name fragments -> category, first match wins.
RULE_CATEGORIES = [
    ("unique", "uniqueness"),
    ("_not_null", "non_null"),
    ("referential", "referential"),
    ("_in_range|bounds", "range"),
    ("valid", "domain"),
    ("matches", "shape"),
    ("present", "shape"),
    ("positive", "range"),
    ("non_negative", "range"),
    ("monotonic", "structural"),
    ("zero_or_one", "domain"),
]


def rule_category(test_name: Column) -> Column:
    """Category label of a data-quality rule from its name."""
    expr = None
    for pattern, label in RULE_CATEGORIES:
        cond = test_name.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("other")
