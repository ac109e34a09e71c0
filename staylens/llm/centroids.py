"""Exact Lloyd clustering of integer vectors with heap-ordered bounds.

A vector's gap is the distance to its second nearest centroid less the one to its own. When
centroids move, its gap shrinks by at most the drift of its own centroid plus the greatest drift
of another, which is the same for all vectors of a cluster. So each cluster keeps a heap of gaps,
each offset by the cluster's drift up to the time of its entry: a round adds its drift to the
cluster's total, pops the heap down to that total, and scans only the popped vectors exactly.

Vectors lie in blocks of some thousand, a row each, in a table that is written once and bucketed by
block. A round reads the blocks next to their heaps (a second table of the same buckets, so the
join shuffles nothing), and writes the new heaps and, per block, what the vectors that changed
cluster add to and take from its sums. Only these sums, k x (components + 1) numbers after
aggregation, reach the driver; sums are exact integers, so the centroids do not depend on the
order of rows. A round's table cuts the lineage: a lost executor costs parts of one round.

Broadcast are k centroids and totals, of a size that the parameters bound.

Cases: vectors that are null, have another number of components, a null or non-finite one, or one
beyond 2^27 / scale (whose squared distances might not fit a long) are left out. With fewer
vectors than k each is a centroid; an empty table gives an empty result. Ties of distance go to the
smaller number, ties of the starting hash (repeated ids) to the smaller vector; a null id is
hashed as empty text. Repeated rows each count. An inertia that no long holds is null. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common

BLOCK_ROWS = 4096
#: Blocks of a bucket, beyond which there are more buckets.
BUCKET_BLOCKS = 256
#: Greatest component: 64 squared differences of twice as much fit a long.
LARGEST = 1 << 27
#: Up to here products and sums of 64 are exact in doubles.
_EXACT = 1 << 22


def usable(vector: Column, size: int, scale: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST / scale))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def blocks_of(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int, block_rows: int) -> DataFrame:
    """(block, n, ids, vectors): blocks of usable vectors as integers floor(scale * x); ``ids`` is an
    array, ``vectors`` holds little-endian integers of the narrowest type."""
    id_type = vectors.schema[id_col].dataType.simpleString()

    def run(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        made = 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                n = part.num_rows
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, size)
                whole = np.floor(x * scale)
                kind = np.min_scalar_type(-int(np.abs(whole).max()) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array([(task << 32) + made]), pa.array([n], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column(0)),
                    pa.array([whole.astype(kind).tobytes()], pa.binary())], names=["block", "n", "ids", "vectors"])
                made += 1
    chosen = vectors.where(usable(F.col(vector_col), size, scale)).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return chosen.mapInArrow(run, f"block bigint, n int, ids array<{id_type}>, vectors binary")


def unpacked(data: bytes, n: int, size: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (n * size)}").reshape(n, size)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances as 64-bit integers, a column per centroid."""
    if max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0))) <= _EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    wide = vectors.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(1) for c in centroids], 1)


def gaps(distances: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """Lower bounds of: second least distance less the least one."""
    rows = np.arange(len(distances))
    own = np.sqrt(distances[rows, nearest].astype(np.float64))
    others = distances.astype(np.float64)
    others[rows, nearest] = np.inf
    second = np.sqrt(others.min(1))
    return second - own - 1e-12 * (1 + own + np.where(np.isfinite(second), second, 0))


class Heaps:
    """A heap of (offset gap, place in the block) for each cluster of a block."""

    def __init__(self, k: int, data: bytes | None = None, sizes=()):
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        if data is not None:
            cells = np.frombuffer(data, _CELL)
            pairs = list(zip(cells["gap"].tolist(), cells["place"].tolist()))
            ends = np.cumsum([0, *sizes]).tolist()
            self.heaps = [pairs[a:b] for a, b in zip(ends, ends[1:])]

    def expired(self, totals: list[float]) -> tuple[list[int], list[int]]:
        """Places of the vectors whose gap may be used up, popped, and their clusters."""
        places, clusters = [], []
        for c, heap in enumerate(self.heaps):
            while heap and heap[0][0] <= totals[c]:
                places.append(heapq.heappop(heap)[1])
                clusters.append(c)
        return places, clusters

    def push(self, places, clusters, gap, totals: list[float]) -> None:
        fresh: dict[int, list] = {}
        for place, c, g in zip(places, clusters.tolist(), gap.tolist()):
            fresh.setdefault(c, []).append((g + totals[c], place))
        for c, pairs in fresh.items():
            heap = self.heaps[c]
            if len(pairs) > len(heap):
                heap.extend(pairs)
                heapq.heapify(heap)
            else:
                for pair in pairs:
                    heapq.heappush(heap, pair)

    def data(self) -> tuple[bytes, list[int]]:
        cells = np.array([pair for heap in self.heaps for pair in heap], _CELL)
        return cells.tobytes(), [len(heap) for heap in self.heaps]

    def clusters(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int64)
        for c, heap in enumerate(self.heaps):
            out[[place for _, place in heap]] = c
        return out


_CELL = np.dtype([("gap", "<f8"), ("place", "<i4")])
_STATE = "block bigint, heap binary, sizes array<int>, changed array<bigint>, scanned int"


def _changes(vectors: np.ndarray, before: np.ndarray | None, after: np.ndarray, k: int) -> np.ndarray:
    """Per cluster the number and sums of the vectors that came, less those that went."""
    moved = np.ones(len(after), bool) if before is None else before != after
    size = vectors.shape[1]
    out = np.zeros((k, size + 1), np.int64)
    rows = np.concatenate([np.ones((int(moved.sum()), 1), np.int64), vectors[moved].astype(np.int64)], 1)
    np.add.at(out, after[moved], rows)
    if before is not None:
        np.subtract.at(out, before[moved], rows)
    return out


def assigned(blocks: DataFrame, centroids: np.ndarray, totals: list[float], size: int) -> DataFrame:
    """The heaps after a round: blocks with their last heaps (null in the first round) against the
    centroids. ``changed`` is what a block adds to the clusters' counts and sums."""
    k = len(centroids)

    def run(batches):
        for batch in batches:
            for block, n, data, heap, sizes in zip(*(batch.column(i).to_pylist() for i in range(5))):
                vectors = unpacked(data, n, size)
                heaps = Heaps(k, heap, sizes or ())
                places, before = (range(n), None) if heap is None else heaps.expired(totals)
                scan = vectors[list(places)]
                distances = squared_distances(scan, centroids)
                after = distances.argmin(1) if len(scan) else np.empty(0, np.int64)
                if len(scan):
                    heaps.push(places, after, gaps(distances, after), totals)
                changed = _changes(scan, None if before is None else np.array(before, np.int64), after, k)
                out, sizes = heaps.data()
                yield pa.RecordBatch.from_arrays([
                    pa.array([block]), pa.array([out], pa.binary()), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([changed.ravel().tolist()], pa.list_(pa.int64())), pa.array([len(scan)], pa.int32())],
                    names=["block", "heap", "sizes", "changed", "scanned"])
    return blocks.select("block", "n", "vectors", "heap", "sizes").mapInArrow(run, _STATE)


def members(blocks: DataFrame, centroids: np.ndarray, size: int, id_type: str) -> DataFrame:
    """(id, cluster, distance) of every vector of blocks with their last heaps."""
    def run(batches):
        for batch in batches:
            for i, (n, data, heap, sizes) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 5)))):
                vectors = unpacked(data, n, size)
                cluster = Heaps(len(centroids), heap, sizes).clusters(n)
                distance = np.empty(n, np.int64)
                for c in np.unique(cluster).tolist():
                    distance[cluster == c] = squared_distances(vectors[cluster == c], centroids[c:c + 1])[:, 0]
                yield pa.RecordBatch.from_arrays([
                    batch.column(5).slice(i, 1).flatten(), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    names=["id", "cluster", "distance"])
    return blocks.select("block", "n", "vectors", "heap", "sizes", "ids").mapInArrow(
        run, f"id {id_type}, cluster int, distance bigint")


class Buckets:
    """Tables bucketed by block in the shared folder; their names live as long as the clustering."""

    def __init__(self, spark: SparkSession, n: int):
        self.spark, self.n, self.names = spark, n, []
        self.folder = f"{common.ensure_checkpoint_dir(spark).rstrip('/')}/centroids-{uuid.uuid4().hex}"

    def save(self, df: DataFrame) -> DataFrame:
        name = f"centroids_{uuid.uuid4().hex}"
        df.write.bucketBy(self.n, "block").option("path", f"{self.folder}/{name}").option(
            "compression", "zstd").saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self) -> None:
        """Forget the names; files stay for the plans that read them."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def starts(blocks: DataFrame, k: int, size: int, seed: str) -> np.ndarray:
    """The k vectors of least sha256 of ``seed`` and id. A block hands on its k least."""
    def run(batches):
        for batch in batches:
            for ids, n, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes = [hashlib.sha256(f"{seed}{'' if i is None else i}".encode()).hexdigest() for i in ids]
                least = heapq.nsmallest(k, zip(hashes, unpacked(data, n, size).tolist()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([h for h, _ in least]), pa.array([v for _, v in least], pa.list_(pa.int64()))],
                    names=["hash", "vector"])
    rows = blocks.select("ids", "n", "vectors").mapInArrow(run, "hash string, vector array<bigint>")
    got = rows.orderBy("hash", "vector").limit(k).collect()
    return np.array([r["vector"] for r in got], np.int64).reshape(len(got), size)


def _sums(state: DataFrame) -> dict[int, int]:
    cells = state.select(F.posexplode("changed").alias("place", "by")).groupBy("place").agg(
        F.sum(F.col("by").cast("decimal(19,0)")).alias("by"))
    return {r["place"]: int(r["by"]) for r in cells.collect()}


class Clustering:
    """Final centroids, the members' table (id, cluster, distance), and how many vectors each
    round scanned."""

    def __init__(self, centroids: np.ndarray, members: DataFrame, scanned: list[int]):
        self.centroids, self.members, self.scanned = centroids, members, scanned


def cluster(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            size: int = 64, scale: int = 1024, k: int = 8, rounds: int = 10, seed: str = "3:",
            block_rows: int = BLOCK_ROWS) -> Clustering:
    """Lloyd's rounds on floor(scale * x); then a last assignment to the final centroids."""
    id_type = vectors.schema[id_col].dataType.simpleString()
    plain = common.written(spark, blocks_of(vectors, id_col, vector_col, size, scale, block_rows), "centroids-blocks")
    n_blocks = plain.count()
    if not n_blocks:
        return Clustering(np.empty((0, size), np.int64),
                          spark.createDataFrame([], f"id {id_type}, cluster int, distance bigint"), [])
    buckets = Buckets(spark, max(min(n_blocks, 2 * spark.sparkContext.defaultParallelism), -(-n_blocks // BUCKET_BLOCKS)))
    blocks = buckets.save(plain)
    centroids = starts(blocks, k, size, seed)
    k = len(centroids)
    totals, sums, scanned, state = [0.0] * k, [[0] * (size + 1) for _ in range(k)], [], None

    def beside(state: DataFrame | None) -> DataFrame:
        if state is None:
            return blocks.withColumns({"heap": F.lit(None).cast("binary"), "sizes": F.lit(None).cast("array<int>")})
        # heaps are small beside the vectors and of the same buckets: hashed, neither side is shuffled or sorted
        return blocks.join(state.select("block", "heap", "sizes").hint("shuffle_hash"), "block")
    try:
        for turn in range(rounds + 1):
            state = buckets.save(assigned(beside(state), centroids, totals, size).repartition(buckets.n, "block"))
            scanned.append(state.agg(F.sum("scanned")).first()[0])
            if turn == rounds:
                break
            for place, by in _sums(state).items():
                sums[place // (size + 1)][place % (size + 1)] += by
            moved = np.array([[x // s[0] for x in s[1:]] if s[0] else c.tolist() for s, c in zip(sums, centroids)], np.int64)
            drift = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(1)) * (1 + 1e-12)
            for c in range(k):
                totals[c] += float(drift[c] + max(np.delete(drift, c), default=0.0))
            centroids = moved
        found = common.written(spark, members(beside(state), centroids, size, id_type), "centroids-members")
    finally:
        buckets.drop()
    return Clustering(centroids, found, scanned)


def with_inertia(spark: SparkSession, found: Clustering) -> DataFrame:
    """The members with their cluster's and the whole inertia, and their centroid as an array."""
    sums = found.members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(19,0)")).alias("s")).collect()
    by = {r["cluster"]: Decimal(r["s"]) for r in sums}
    whole = sum(by.values())

    def long(x):
        return int(x) if x < 1 << 63 else None
    rows = [(c, long(by[c]), long(whole), [int(x) for x in found.centroids[c]]) for c in sorted(by)]
    per = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return found.members.join(F.broadcast(per), "cluster")  # one row per cluster, k at most
