"""Rows whose key occurs more than once, every copy of it (W4), with one scan and one exchange.

Rows are dealt by a digest of their key; in the partition a digest's rows lie together, and the key itself
parts them, so equality is proved on the keys and only where digests are equal. Null keys are equal.

A key that holds a third of all rows would fill one partition. But a task that has seen a key twice knows
that the next row of that key is a copy: the first two rows of a key in a task go *home*, to the
partition of the digest, where they prove each other copies, and all later ones are marked and
spread evenly. So a key's home gets two rows a task at most. What a task remembers is bounded by
``REMEMBERED`` repeated keys; a key beyond that goes home, which is right as well.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from staylens.operators.ordered import null_safe_join

#: Repeated keys that a task remembers.
REMEMBERED = 4096
#: Repeated keys that are sent to all tasks; more are joined by key.
BROADCAST_KEYS = 100_000


def _same(batch: pa.RecordBatch, places: list[int], rows: np.ndarray, key: list) -> np.ndarray:
    """Which of the rows have this key; nulls are equal."""
    out = np.ones(len(rows), bool)
    for place, value in zip(places, key):
        column = batch.column(place).take(pa.array(rows))
        equal = pc.is_null(column) if not value.is_valid else pc.fill_null(pc.equal(column, value), False)
        out &= equal.to_numpy(zero_copy_only=False)
    return out


class Seen:
    """The keys that a task has seen twice, by digest."""

    def __init__(self, places: list[int], remembered: int = REMEMBERED):
        self.places, self.remembered, self.keys = places, remembered, {}

    def known_copies(self, batch: pa.RecordBatch, digests: np.ndarray) -> np.ndarray:
        """Rows that are copies of a key whose first two rows went home."""
        known = np.zeros(len(digests), bool)
        distinct, counts = np.unique(digests, return_counts=True)
        order = np.argsort(digests, kind="stable")
        ends = np.cumsum(counts)
        for k in np.flatnonzero((counts > 1) | np.isin(distinct, list(self.keys) or [0])).tolist():
            digest, rows = int(distinct[k]), np.sort(order[ends[k] - counts[k]:ends[k]])
            key, fresh = self.keys.get(digest), 0
            if key is None:
                if len(rows) < 2 or len(self.keys) >= self.remembered:
                    continue
                key, fresh = [batch.column(p)[int(rows[0])] for p in self.places], 2
            same = rows[_same(batch, self.places, rows, key)]
            if fresh and len(same) < 2:
                continue
            self.keys[digest] = key
            known[same[fresh:]] = True
        return known


def flag_listed_repeats(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """``flag_repeats`` for wide rows of narrow keys that seldom repeat: the keys alone are dealt and counted
    (a job when the plan is built), and the rows look theirs up among the repeated ones. Rows are not dealt,
    or once by the key if many keys repeat, and columns that nobody reads are never made."""
    from staylens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    repeated = counts.where(F.col("__n") > 1).checkpoint(eager=True)
    few = repeated.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    joined = null_safe_join(df, F.broadcast(repeated) if few else repeated, keys, "left")
    return joined.select(*df.columns, F.col("__n").isNotNull().alias(flag))


def flag_repeats(df: DataFrame, keys: Sequence[str], flag: str, remembered: int = REMEMBERED) -> DataFrame:
    """``df`` with boolean ``flag``: true on every row whose key occurs more than once."""
    digest, spread = F.xxhash64(*(F.col(k) for k in keys)), "__spread"
    names = df.columns
    places = [names.index(k) for k in keys]
    with_digest = df.withColumn("__digest", digest)

    def run(batches):
        seen, sent = Seen(places, remembered), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            known = seen.known_copies(batch, batch.column(len(names)).to_numpy(zero_copy_only=False))
            n = int(known.sum())
            out = np.zeros(batch.num_rows, np.int64)  # 0: home; others differ, so they are dealt evenly
            out[known] = np.arange(sent + 1, sent + n + 1)
            sent += n
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out)], names=[*names, spread])
    # the digest is found again after the exchange: eight random bytes a row don't pack
    schema = StructType([*df.schema.fields, StructField(spread, LongType())])
    dealt = with_digest.mapInArrow(run, schema).repartition(digest, spread)
    copies = F.count(F.lit(1)).over(Window.partitionBy(digest, spread, *keys))
    return dealt.select(*df.columns, ((F.col(spread) > 0) | (copies > 1)).alias(flag))
