"""Global order-dependent values without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)``, ``NTILE``, running sums and exact quantiles over a
whole table (or over a group that holds most of it) make Spark move every row into one
partition. Here the table is range partitioned and sorted once. Spark's own row ids give
each row its partition and its number there; running sums are windows within a partition.
Per-partition totals -- one row per partition, a proven bound -- give the offsets, which
are broadcast back. Everything stays in the JVM, so types keep their values (19-digit
integers next to nulls included).

The order must be total (include a unique key as the last sort column) so the result is
deterministic. The sorted rows are checkpointed in the shared ``spark.checkpoint.dir``
before the offsets are computed: offsets and rows then see one partitioning, never two
evaluations of the upstream plan. The number of partitions is the session's
``spark.sql.shuffle.partitions`` as adaptive execution coalesces it by size, unless given.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a partition in Spark's monotonically increasing ids.
_ROW_BITS = 33


def ordered_index(df: DataFrame, order: Sequence[Column | str], rn_col: str = "rn",
                  value_col: str | None = None, cum_col: str = "cum_value",
                  num_partitions: int | None = None, total_col: str | None = None,
                  total_value_col: str | None = None) -> DataFrame:
    """Add a 1-based global row number (and optional running sum of ``value_col``).

    ``total_col`` / ``total_value_col`` also attach the table's row count and
    value total (taken from the same per-partition totals, no extra pass). Integral
    and decimal values are summed exactly, others as doubles.
    """
    from staylens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    dealt = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    numbered = dealt.sortWithinPartitions(*order).withColumn(
        "__id", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright("__id", _ROW_BITS)
    aggs = [F.count(F.lit(1)).alias("__pn")]
    if value_col:
        kind = df.schema[value_col].dataType.typeName()
        exact = kind in ("byte", "short", "integer", "long", "decimal")
        zero = F.lit(0) if exact else F.lit(0.0)
        value = F.coalesce(F.col(value_col) if exact else F.col(value_col).cast("double"), zero)
        numbered = numbered.withColumn("__pid", pid).withColumn(
            "__lcum", F.sum(value).over(Window.partitionBy("__pid").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)))
        aggs.append(F.sum(value).alias("__ps"))
    else:
        numbered = numbered.withColumn("__pid", pid)
    totals = numbered.groupBy("__pid").agg(*aggs)
    # ``totals`` has one row per partition, so its windows are over a bounded table
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    offs = [F.coalesce(F.sum("__pn").over(before), F.lit(0)).alias("__off_n"), F.sum("__pn").over(every).alias("__tot_n")]
    if value_col:
        offs += [F.coalesce(F.sum("__ps").over(before), zero).alias("__off_s"), F.sum("__ps").over(every).alias("__tot_s")]
    out = numbered.join(F.broadcast(totals.select("__pid", *offs)), "__pid")
    local = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    cols = [F.col(c) for c in df.columns] + [(F.col("__off_n") + local).alias(rn_col)]
    if value_col:
        cols.append((F.col("__off_s") + F.col("__lcum")).alias(cum_col))
    if total_col:
        cols.append(F.col("__tot_n").alias(total_col))
    if total_value_col and value_col:
        cols.append(F.col("__tot_s").alias(total_value_col))
    return out.select(*cols)


def exact_quantiles(df: DataFrame, group: Sequence[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per group with exact, linearly interpolated quantiles of several columns.

    wanted: output name -> (column, probability). Values are counted per group first, the
    counts are ordered once over all groups and columns, and each quantile is read off by
    the rank where its value's run starts or ends. A group that holds every row is spread
    over all partitions like any other. Nulls are left out; no values give null.
    """
    cols = list(dict.fromkeys(c for c, _ in wanted.values()))
    keys = [f"__g{i}" for i in range(len(group))]
    cells = F.explode(F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols))))
    base = df.select(*(F.col(g).alias(k) for g, k in zip(group, keys)), cells.alias("x")).select(*keys, "x.c", "x.v")
    counts = base.where(F.col("v").isNotNull()).groupBy(*keys, "c", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = ordered_index(counts, [*keys, "c", "v"], rn_col="__rn", value_col="n", cum_col="cum")
    spans = ranked.groupBy(*keys, "c").agg(F.min(F.col("cum") - F.col("n")).alias("first"), F.sum("n").alias("total"))
    # a row per group and column; a plain join would deal and sort every counted value once more
    rows = null_safe_join(ranked, F.broadcast(spans), [*keys, "c"])
    start, end = F.col("cum") - F.col("n") - F.col("first"), F.col("cum") - F.col("first")
    aggs, outs = [], []
    for i, (name, (c, p)) in enumerate(wanted.items()):
        mine = F.col("c") == cols.index(c)
        at = F.lit(float(p)) * (F.col("total") - 1)
        aggs += [F.max(F.when(mine & (start <= F.floor(at)), F.col("v"))).alias(f"lo{i}"),
                 F.min(F.when(mine & (end > F.ceil(at)), F.col("v"))).alias(f"hi{i}"),
                 F.max(F.when(mine, at - F.floor(at))).alias(f"fr{i}")]
        outs.append(((1 - F.col(f"fr{i}")) * F.col(f"lo{i}") + F.col(f"fr{i}") * F.col(f"hi{i}")).alias(name))
    found = rows.groupBy(*keys).agg(*aggs)
    return found.select(*(F.col(k).alias(g) for g, k in zip(group, keys)), *outs)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; the left side's keys are kept."""
    if not keys:  # one-row sides
        one = right.withColumn("__one", F.lit(1))
        return left.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one", how).drop("__one")
    named = right.withColumnsRenamed({k: f"__r_{i}" for i, k in enumerate(keys)})
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__r_{i}")) for i, k in enumerate(keys)))
    return left.join(named, match, how).drop(*(f"__r_{i}" for i in range(len(keys))))


def with_quantiles(agg: DataFrame, df: DataFrame, group: Sequence[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """``agg`` (one row per group of ``df``) with the quantiles as further columns."""
    return null_safe_join(agg, exact_quantiles(df, group, wanted), group, "left")


def ntile_of(rn: Column, total: Column, buckets: int) -> Column:
    """Standard NTILE bucket of 1-based row ``rn`` among ``total`` rows.

    The first ``total % buckets`` buckets hold one extra row.
    """
    q = F.floor(total / buckets)
    r = total % buckets
    big = r * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((rn - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")


def with_ntile(df: DataFrame, order: Sequence[Column | str], buckets: int,
               out_col: str = "ntile") -> DataFrame:
    """NTILE(buckets) OVER (ORDER BY order) computed with ``ordered_index``."""
    idx = ordered_index(df, order, rn_col="__rn", total_col="__total")
    return idx.select(*df.columns, ntile_of(F.col("__rn"), F.col("__total"), buckets).alias(out_col))
