"""Rules over many tables in one tagged pass.

Keys of all tables become (domain, key, table). A domain is a set of keys that means the same in
several tables, such as listing keys. One grouped aggregation over (domain, key) counts each table's rows
per key; a second one, over the groups and the rows' measures, reads off what the rules ask: rows,
repeated keys, keys without a parent, measures. So all rules together take one shuffle by key, however
many tables and rules there are, and it carries keys and counts alone: measures are added up in
the tasks that read the rows. Rows of a key that holds a third of a table are added up before the shuffle.

Nulls: a key with a null part is no key. It is no repetition of another, and a reference with it has no
parent; ``repeated`` counts rows less distinct keys as SQL's COUNT(DISTINCT) does, so null keys
count there too. Measures ignore null conditions. Empty tables count 0 rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


@dataclass
class Table:
    """A table, its keys by domain, and what is added up (or the least or greatest) over its rows."""
    name: str
    df: DataFrame
    keys: dict[str, Sequence[str]] = field(default_factory=dict)
    sums: dict[str, Column] = field(default_factory=dict)
    least: dict[str, Column] = field(default_factory=dict)
    greatest: dict[str, Column] = field(default_factory=dict)


def failing(condition: Column) -> Column:
    """1 where the condition is known to be false."""
    return F.when(~condition, F.lit(1)).otherwise(F.lit(0))


def _measures(table: Table) -> list[tuple[str, Callable, Column]]:
    return [(f"{table.name}.{n}", how, c.cast("bigint")) for how, cells in (
        (F.sum, table.sums), (F.min, table.least), (F.max, table.greatest)) for n, c in cells.items()]


def _key_type(tables: Sequence[Table]) -> str:
    kinds = [t.df.schema[c].dataType for t in tables for cols in t.keys.values() for c in cols]
    return "bigint" if all(isinstance(k, IntegralType) for k in kinds) else "string"


def _keyed(table: Table, width: int, kind: str) -> DataFrame:
    """The keys of a table's rows, once for each of its domains."""
    none = F.lit(None).cast(kind)

    def key(domain, columns):
        parts = [F.col(c).cast(kind) for c in columns] + [none] * (width - len(columns))
        whole = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns), F.lit(bool(columns)))
        return F.struct(F.lit(domain).alias("domain"), *(p.alias(f"k{i}") for i, p in enumerate(parts)),
                        whole.alias("whole"))
    places = [key(d, c) for d, c in table.keys.items()]
    rows = table.df.select((F.explode(F.array(*places)) if len(places) > 1 else places[0]).alias("at"))
    return rows.select(F.lit(table.name).alias("table"), "at.*")


def _measured(table: Table, names: list[str], counts: Sequence[str]) -> DataFrame:
    """The measures of a table's rows."""
    own = {n: c for n, _, c in _measures(table)}
    none = F.lit(None).cast("bigint")
    return table.df.select(F.lit(table.name).alias("table"), F.lit(None).cast("string").alias("domain"), F.lit(None).cast("boolean").alias("whole"),
                           *(none.alias(c) for c in counts), *(own.get(n, none).alias(f"m{i}") for i, n in enumerate(names)))


class Figures:
    """The one-row result of ``figures``; its columns by meaning."""

    def __init__(self, df: DataFrame, tables: Sequence[Table]):
        self.df, self.tables = df, {t.name: t for t in tables}

    def rows(self, table: str) -> Column:
        return F.col(f"`rows {table}`")

    def measure(self, table: str, name: str) -> Column:
        return F.col(f"`{table}.{name}`")

    def repeated(self, table: str, domain: str) -> Column:
        return F.col(f"`repeated {table} {domain}`")

    def copies(self, table: str, domain: str) -> Column:
        return F.col(f"`copies {table} {domain}`")

    def orphans(self, child: str, parent: str, domain: str) -> Column:
        return F.col(f"`orphans {child} {parent} {domain}`")


def figures(tables: Sequence[Table]) -> Figures:
    """Of every table the rows and measures; per domain of it ``repeated`` (rows less distinct keys) and
    ``copies`` (rows whose whole key comes twice or more); per pair of tables of a domain ``orphans``."""
    names = [n for t in tables for n, _, _ in _measures(t)]
    how = [h for t in tables for _, h, _ in _measures(t)]
    width = max((len(c) for t in tables for c in t.keys.values()), default=0)
    kind = _key_type(tables)
    count = {t.name: f"n{i}" for i, t in enumerate(tables)}
    # keys alone are dealt by key; measures go with no key, so they are added up in the tasks
    rows = reduce(DataFrame.unionByName, (_measured(t, names, list(count.values())) for t in tables))
    if keyed := [_keyed(t, width, kind) for t in tables if t.keys]:
        per_key = reduce(DataFrame.unionByName, keyed).groupBy("domain", *(f"k{i}" for i in range(width)), "whole").agg(
            *(F.count_if(F.col("table") == n).alias(c) for n, c in count.items()))
        rows = rows.unionByName(per_key.select("domain", "whole", *count.values()), allowMissingColumns=True)

    def over(domain, value):
        return F.coalesce(F.sum(F.when(F.col("domain") == domain, value)), F.lit(0))
    out = [h(f"m{i}").alias(n) if h is not F.sum else F.coalesce(h(f"m{i}"), F.lit(0)).alias(n)
           for i, (n, h) in enumerate(zip(names, how))]
    for t in tables:
        n = F.col(count[t.name])
        out.append(F.count_if(F.col("table") == t.name).alias(f"rows {t.name}"))
        for d in t.keys:
            out += [over(d, n - F.when(F.col("whole") & (n > 0), 1).otherwise(0)).alias(f"repeated {t.name} {d}"),
                    over(d, F.when(F.col("whole") & (n > 1), n)).alias(f"copies {t.name} {d}")]
            for p in tables:
                if p.name != t.name and d in p.keys:
                    lost = ~F.col("whole") | (F.col(count[p.name]) == 0)
                    out.append(over(d, F.when(lost, n)).alias(f"orphans {t.name} {p.name} {d}"))
    return Figures(rows.agg(*out), tables)


def rule_rows(found: Figures, rules: dict[str, Column], name: str = "rule", value: str = "violations") -> DataFrame:
    """A row for each rule: its name and its figure."""
    cells = F.array(*(F.struct(F.lit(k).alias(name), v.cast("bigint").alias(value)) for k, v in rules.items()))
    return found.df.select(F.explode(cells).alias("r")).select(f"r.{name}", f"r.{value}")
