"""Self-join of documents by the Jaccard coefficient of their word n-grams, and its classes.

A document's set holds the hashes of its distinct ``WORDS``-word shingles; documents with
equal sets form one class from the start. Exactly the classes linked with another
(100 * intersection >= ``PERCENT`` * union) come together:

1. Prefix count. If two sets link, they share at least k of their tokens of lowest hash (the
   prefix of n - ceil(0.8 n) + k; ``SLACK`` sets k). Tokens are dealt once by token; a class
   whose prefix holds too few tokens of other classes links with nothing and is done.
2. Stars. Of the other classes, those with an equal min-hash are compared with the most central of them
   (``STARS`` min-hashes), which joins large families by a number of comparisons that is
   linear in their members.
3. Token-group matrix. Only tokens that stand in two families joined so far can make a
   further link, so a class needs ceil(0.8 n) of them. Those classes are partitioned by
   min-hash into chunks of similar ones. A class meets the chunks that share one of its
   rarest tokens, and a task holds two chunks at most: the matrix has the token union of
   each group of ``GROUP`` members, a query's overlap with it bounds that with any member,
   and only groups whose bound reaches ceil(0.8 n) are opened and compared. A task hands on
   as many links as join families, no more.
4. Links. Every link lies inside a component. Its classes are cut, in order of size, into
   chunks of a bounded weight in tokens; two chunks meet in a task if their sizes allow a
   link, by the same matrix. A task hands on a count per class (``join_classes``) or the links
   themselves (``class_links``); copies are counted, not paired.

Nothing is capped: a hot token meets chunks, not documents. A component of T tokens is sent
T / ``CHUNK_TOKENS`` times to find its links. Tokens have 48 bits and classes 64, so a false
link among 10^9 different sets has a chance of about 3 %.

Cases: a null or empty text, or one of white space, has an empty set and is its own class;
fewer words than ``WORDS`` make one shingle; repeated rows and repeated ids each give a row;
null ids never name a class unless all its ids are null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common
from staylens.llm.components import components
from staylens.operators.ordered import ordered_index

WORDS = 5
PERCENT = 80
#: k is n // SLACK, 1 at least: longer prefixes cost rows and spare comparisons.
SLACK = 10
STARS = 3
GROUP = 32
#: Classes of a chunk. A task holds the sets of two.
CHUNK = 256
#: Tokens of a chunk of a component (beyond, by one set at most), where a set weighs ``LEAST_WEIGHT`` or more.
CHUNK_TOKENS = 1 << 17
LEAST_WEIGHT = 64
#: Tables of a few numbers a class are broadcast up to this many rows, else shuffled.
BROADCAST_ROWS = 300_000
_CACHE = 200_000
_MASK = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted arrays of shingle hashes; each distinct word of a task is hashed once."""

    def __init__(self, words: int = WORDS):
        self.words, self.hashes = words, {}

    def of(self, text: str | None) -> np.ndarray:
        import xxhash
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII rules, both
        if not found:
            return np.empty(0, np.int64)
        known = self.hashes
        if len(known) > _CACHE:
            known.clear()
        for w in set(found).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        size = min(self.words, len(h))
        n = len(h) - size + 1
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = _mix(out + h[k:k + n])
        return np.unique(out & _MASK).astype(np.int64)


def least_overlap(n, percent: int = PERCENT):
    """Tokens of a set of n that a linked set shares, at least; for numbers and columns."""
    whole = n * percent + 99
    return (whole / 100).cast("bigint") if isinstance(n, Column) else whole // 100


def _extra(n: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), (n / SLACK).cast("bigint"))


def sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, key, n, cls, tokens) of every row: the text's hash, size, class and sorted
    shingle hashes. Copies that a task meets again have null tokens, so that copies of one
    text are few rows later on."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)

    def run(batches):
        import xxhash
        shingles, met = Shingles(words), {None}
        for batch in common.blocks(batches, "text"):
            found = [shingles.of(t) for t in common.texts_of(batch, "text")]
            sizes = np.array([len(x) for x in found], np.int64)
            cls = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if len(x) else None for x in found]
            fresh = np.zeros(len(cls), bool)
            for i, c in enumerate(cls):
                fresh[i] = c not in met
                met.add(c)
            offsets = np.concatenate([[0], np.cumsum(np.where(fresh, sizes, 0))]).astype(np.int32)
            kept = [x for x, f in zip(found, fresh) if f] or [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes), pa.array(cls, pa.int64()), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(np.concatenate(kept)), mask=pa.array(~fresh))],
                names=["doc_id", "key", "n", "cls", "tokens"])
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key")).mapInArrow(
        run, f"doc_id {id_type}, key bigint, n bigint, cls bigint, tokens array<bigint>")


def shared_tokens(rows: DataFrame) -> DataFrame:
    """(cls, shared): of the rows (token, label, cls) of each class, the number of distinct
    tokens that also stand under another label.

    One shuffle by token. A task reads its rows in order and keeps the last one, so a token
    in a third of all rows needs no memory; it hands on one sum per class and batch."""
    def run(batches):
        last = (None, None, False)  # token, label, whether the token is known to be shared
        seen = None
        held = np.empty(0, np.int64)  # classes of the last token while it has a single label
        for batch in batches:
            token, label, cls = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fresh = (np.diff(token, prepend=token[0]) != 0) | (np.diff(cls, prepend=cls[0]) != 0)
            fresh[0] = (token[0], cls[0]) != seen
            seen = (token[-1], cls[-1])
            if not fresh.any():
                continue
            token, label, cls = token[fresh], label[fresh], cls[fresh]
            start = np.flatnonzero(np.diff(token, prepend=token[0] - 1))
            run_of = np.cumsum(np.diff(token, prepend=token[0] - 1) != 0) - 1
            mixed = np.minimum.reduceat(label, start) != np.maximum.reduceat(label, start)
            out = []
            if last[0] == token[0]:
                mixed[0] |= last[2] or label[0] != last[1]
                if mixed[0] and len(held):
                    out.append(held)
                    held = held[:0]
            else:
                held = held[:0]
            hit = mixed[run_of]
            out.append(cls[hit])
            if not mixed[-1]:
                tail = cls[start[-1]:]
                held = np.unique(np.concatenate([held, tail])) if len(start) == 1 else np.unique(tail)
            else:
                held = held[:0]
            last = (token[-1], label[-1], bool(mixed[-1]))
            values, counts = np.unique(np.concatenate(out), return_counts=True)
            if len(values):
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["cls", "n"])
    dealt = rows.select("token", "label", "cls").repartition("token").sortWithinPartitions("token", "label", "cls")
    return dealt.mapInArrow(run, "cls bigint, n bigint").groupBy("cls").agg(F.sum("n").alias("shared"))


def _small(table: DataFrame) -> DataFrame:
    """A written table, to be broadcast if it is known to be small."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def linked(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Whether two token arrays link."""
    both = F.size(F.array_intersect(a, b)).cast("bigint")
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def compared(pairs: DataFrame, rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the distinct pairs (a, b) of classes whose sets link."""
    left = rows.select(F.col("cls").alias("a"), F.col("tokens").alias("x"), F.col("n").alias("nx"))
    right = rows.select(F.col("cls").alias("b"), F.col("tokens").alias("y"), F.col("n").alias("ny"))
    sized = (F.col("nx") * percent <= F.col("ny") * 100) & (F.col("ny") * percent <= F.col("nx") * 100)
    return pairs.where("a != b").distinct().join(left, "a").join(right, "b").where(sized).where(
        linked(F.col("x"), F.col("y"), percent)).select("a", "b")


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """Links of classes with the most central class of an equal min-hash: the one that shares
    most of its tokens, as the text that others were edited from does."""
    hashes = [F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(j)))) for j in range(STARS)]
    keys = rows.select("cls", "central", F.posexplode(F.array(*hashes)).alias("j", "h"))
    hubs = keys.groupBy("j", "h").agg(F.max_by("cls", F.struct("central", "cls")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    return compared(keys.join(hubs, ["j", "h"]).select(F.col("cls").alias("a"), F.col("hub").alias("b")), rows, percent)


def _groups(left: DataFrame) -> DataFrame:
    """``left`` with ``h``, a min-hash, and ``chunk``: ``CHUNK`` classes that follow each other in
    the order of h, so similar ones mostly share a chunk."""
    hashed = left.withColumn("h", F.array_min(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(STARS)))))
    places = ordered_index(hashed.select("cls", "h"), ["h", "cls"], rn_col="place")
    chunks = places.select("cls", F.floor((F.col("place") - 1) / CHUNK).alias("chunk"))
    return hashed.join(chunks, "cls")


def _lists(column: pa.ChunkedArray, rows: np.ndarray) -> list[np.ndarray]:
    got = column.combine_chunks()
    ends, values = got.offsets.to_numpy(), got.values.to_numpy(zero_copy_only=False)
    return [values[ends[i]:ends[i + 1]] for i in rows]


def _incidence(lists: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Rows by words: 1 where a list holds a word (lists and words sorted)."""
    out = np.zeros((len(lists), len(words)), np.float32)
    for i, x in enumerate(lists):
        x = x[np.searchsorted(x, words[0]):np.searchsorted(x, words[-1], "right")]
        at = np.searchsorted(words, x)
        out[i, at[words[at] == x]] = 1
    return out


def block_links(queries: list[np.ndarray], members: list[np.ndarray], need: np.ndarray, slab: int = 8192):
    """Yields (query rows, member rows, overlaps) of the groups that a query opens.

    The matrix holds a row of token incidences for each group's union. A query's overlap with
    it bounds that with any member, so the members of a group are looked at for those
    queries alone whose bound reaches their need."""
    words = np.intersect1d(np.unique(np.concatenate(queries)), np.unique(np.concatenate(members)))
    if not len(words):
        return
    slabs = [words[i:i + slab] for i in range(0, len(words), slab)]
    starts = np.arange(0, len(members), GROUP)
    bound = np.zeros((len(queries), len(starts)))  # a slab's counts are exact in 32 bits, their sums in 64
    for w in slabs:
        union = np.maximum.reduceat(_incidence(members, w), starts, axis=0)
        bound += _incidence(queries, w) @ union.T
    for g, start in enumerate(starts):
        rows = np.flatnonzero(bound[:, g] >= need)
        if not len(rows):
            continue
        group = members[start:start + GROUP]
        both = np.zeros((len(rows), len(group)))
        for w in slabs:
            both += _incidence([queries[i] for i in rows], w) @ _incidence(group, w).T
        yield rows, start + np.arange(len(group)), both


def _forest(a: np.ndarray, b: np.ndarray, family: dict) -> list[int]:
    """Places of those links that join families not yet joined; family: the family of a class."""
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x
    out = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(family[x]), find(family[y])
        if x != y:
            root[x] = y
            out.append(i)
    return out


def _matrix_links(spark: SparkSession, rows: DataFrame, percent: int) -> DataFrame:
    """Links between classes of different families, as many as join them: a task gives a
    forest, not all pairs. rows: (cls, n, tokens, family)."""
    tokens = rows.select("cls", "n", "family", F.explode("tokens").alias("token"))
    crossing = shared_tokens(tokens.select("token", F.col("family").alias("label"), "cls"))
    crossing = common.written(spark, crossing, "crossing")
    left = rows.join(_small(crossing), "cls").where(F.col("shared") >= least_overlap(F.col("n"), percent)).drop("shared")
    left = common.written(spark, _groups(common.written(spark, left, "crossing-classes")), "tgm-classes")
    cells = left.select("cls", "family", F.explode("tokens").alias("token"))
    rare = cells.groupBy("token").agg(F.count("*").alias("df"), F.min("family").alias("lo"), F.max("family").alias("hi")).where(
        "lo != hi").select("token", "df")
    need = least_overlap(F.col("n"), percent)
    own = cells.join(rare, "token").groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"))
    prefix = F.slice("own", F.lit(1), (F.size("own") - need + 1).cast("int"))
    queries = left.select("cls", "n", "family", "h", "chunk").join(own, "cls").where(F.size("own") >= need).select(
        "cls", "n", "family", "h", "chunk", F.transform(prefix, lambda x: x["token"]).alias("prefix"),
        F.array_sort(F.transform("own", lambda x: x["token"])).alias("own"))
    queries = common.written(spark, queries, "tgm-queries")
    rarest = queries.select("cls", "chunk", F.explode("prefix").alias("token"))
    matrix = rarest.select("token", F.col("chunk").alias("other")).distinct()
    meets = rarest.join(matrix, "token").select("cls", "chunk", "other").distinct()
    sides = meets.join(queries.select("cls", "n", "family", "h", "own"), "cls").withColumn(
        "lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("h", "ascending"), ("cls", "ascending")])
        cls, n, family, chunk = (block.column(c).to_numpy() for c in ("cls", "n", "family", "chunk"))
        first = np.flatnonzero(chunk == block.column("lo")[0].as_py())
        second = np.flatnonzero(chunk == block.column("hi")[0].as_py())
        a, b = [], []
        if len(first) and len(second):
            least = least_overlap(n[first], percent)
            for q, m, both in block_links(_lists(block.column("own"), first), _lists(block.column("own"), second), least):
                q, m = first[q], second[m]
                hit = 100 * both >= percent * (n[q][:, None] + n[m][None, :] - both)
                i, j = np.nonzero(hit & (family[q][:, None] != family[m][None, :]))
                a.append(cls[q[i]])
                b.append(cls[m[j]])
        a, b = np.concatenate(a or [cls[:0]]), np.concatenate(b or [cls[:0]])
        kept = _forest(a, b, dict(zip(cls.tolist(), family.tolist())))
        return pa.table({"a": a[kept], "b": b[kept]})
    return sides.groupBy("lo", "hi").applyInArrow(run, "a bigint, b bigint")


def _family_chunks(rows: DataFrame) -> DataFrame:
    """``rows`` (cls, n, family, ..) with ``chunk``: classes that follow each other in the order of
    family and size, up to a weight of ``CHUNK_TOKENS``."""
    weighed = rows.select("family", "n", "cls", F.greatest("n", F.lit(LEAST_WEIGHT)).alias("weight"))
    placed = ordered_index(weighed, ["family", "n", "cls"], value_col="weight", cum_col="until")
    chunks = placed.select("cls", F.floor((F.col("until") - F.col("weight")) / CHUNK_TOKENS).alias("chunk"))
    return rows.join(chunks, "cls")


def family_links(spark: SparkSession, rows: DataFrame, percent: int = PERCENT, pairs: bool = False) -> DataFrame:
    """All links of the classes ``rows`` (cls, n, tokens, copies, family), a family being closed
    under links. Per class and task (cls, classes, copies): the linked classes and their copies;
    or with ``pairs`` each link once, as (a, b, shared)."""
    rows = common.written(spark, _family_chunks(rows), "family-chunks")
    spans = rows.groupBy("family", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    later = spans.select("family", F.col("chunk").alias("hi"), F.col("least").alias("least_hi"))
    # the sizes of a family ascend, so the later chunk's least decides
    meets = spans.withColumnRenamed("chunk", "lo").join(later, "family").where(
        (F.col("lo") <= F.col("hi")) & (F.col("least_hi") * percent <= F.col("most") * 100)).select("family", "lo", "hi")
    sides = meets.select("*", F.col("lo").alias("chunk")).unionByName(
        meets.where("lo != hi").select("*", F.col("hi").alias("chunk")))
    dealt = rows.join(sides, ["family", "chunk"]).select("cls", "n", "copies", "tokens", "family", "chunk", "lo", "hi")
    schema = "a bigint, b bigint, shared bigint" if pairs else "cls bigint, classes bigint, copies bigint"

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by([("family", "ascending"), ("n", "ascending"), ("cls", "ascending")])
        cls, n, copies, chunk = (block.column(c).to_numpy() for c in ("cls", "n", "copies", "chunk"))
        lo, hi = block.column("lo")[0].as_py(), block.column("hi")[0].as_py()
        first, second = np.flatnonzero(chunk == lo), np.flatnonzero(chunk == hi)
        classes, weight = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
        found = []
        for q, m, both in block_links(_lists(block.column("tokens"), first), _lists(block.column("tokens"), second),
                                      least_overlap(n[first], percent)):
            q, m = first[q], second[m]
            hit = 100 * both >= percent * (n[q][:, None] + n[m][None, :] - both)
            if lo == hi:
                hit &= q[:, None] < m[None, :]
            if pairs:
                i, j = np.nonzero(hit)
                found.append((cls[q[i]], cls[m[j]], both[i, j].astype(np.int64)))
                continue
            classes[q] += hit.sum(axis=1)
            classes[m] += hit.sum(axis=0)
            weight[q] += hit @ copies[m]
            weight[m] += copies[q] @ hit
        if pairs:
            parts = [np.concatenate(x) for x in zip(*found)] or [cls[:0]] * 3
            return pa.table(dict(zip(["a", "b", "shared"], parts)))
        some = classes > 0
        return pa.table({"cls": cls[some], "classes": classes[some], "copies": weight[some]})
    return dealt.groupBy("lo", "hi").applyInArrow(run, schema)


def _labelled(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
    """(doc_id, key, n, cls) of every row, (cls, rep, root) of every class: its smallest id and the
    smallest class it reaches, and (cls, n, tokens) of those that may have links."""
    n = F.col("n")
    prefix = F.slice("tokens", F.lit(1), F.least(n, n - least_overlap(n, percent) + _extra(n)).cast("int"))
    every = common.written(spark, sets(docs, id_col, text_col, words).withColumn("tokens", prefix), "shingle-prefixes")
    full = every.where(F.col("cls").isNotNull())
    near = shared_tokens(full.where(F.col("tokens").isNotNull()).select(
        F.explode("tokens").alias("token"), F.col("cls").alias("label"), "cls"))
    classes = common.written(spark, full.groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min("key").alias("key")).join(near, "cls", "left"), "classes")
    maybe = common.written(spark, classes.where(F.col("shared") >= _extra(least_overlap(n, percent))).select(
        "key", "cls", (F.col("shared") / n).alias("central")), "maybe-linked")
    # the whole sets of one text of each class that is left
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    rows = sets(texts.join(_small(maybe.select("key")), "key", "left_semi"), "doc_id", "text", words).where(F.col("tokens").isNotNull())
    rows = rows.select("cls", "n", "tokens").dropDuplicates(["cls"]).join(_small(maybe.select("cls", "central")), "cls")
    rows = common.written(spark, rows, "whole-sets")
    links = common.written(spark, _stars(rows, percent), "star-links")
    family = components(spark, links).select(F.col("node").alias("cls"), F.col("root").alias("family"))
    grouped = rows.drop("central").join(_small(family), "cls", "left").withColumn("family", F.coalesce("family", "cls"))
    more = common.written(spark, _matrix_links(spark, grouped, percent), "matrix-links")
    root = components(spark, links.unionByName(more)).withColumnRenamed("node", "cls")
    named = classes.join(root, "cls", "left").select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    return every.select("doc_id", "key", "n", "cls"), named, rows.select("cls", "n", "tokens")


def _families(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
    """(doc_id, n, cls) of every row, (cls, rep, component_id) of every class, and (cls, n, tokens,
    copies, family) of the classes that link with another."""
    every, named, sets_of = _labelled(spark, docs, id_col, text_col, words, percent)
    ids = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("members"))
    by_class = common.written(spark, named.join(ids, "root"), "class-components")
    joined = _small(by_class.where("members > 1").select("cls", F.col("root").alias("family")))
    copies = every.join(joined.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.count("*").alias("copies"))
    rows = sets_of.join(joined, "cls").join(copies, "cls")
    return every.select("doc_id", "n", "cls"), by_class.select("cls", "rep", "component_id"), rows


def join_classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, n_class_links) of every row of ``docs``.

    n_links: other rows linked with this one, those of an equal set included; n_class_links:
    different sets linked with its set. Both are 0 without words."""
    every, by_class, rows = _families(spark, docs, id_col, text_col, words, percent)
    found = family_links(spark, rows, percent).groupBy("cls").agg(F.sum("classes").alias("classes"), F.sum("copies").alias("near"))
    every = every.where(F.col("cls").isNotNull()), every.where(F.col("cls").isNull())
    equal = every[0].groupBy("cls").agg(F.count("*").alias("equal"))
    sums = by_class.join(equal, "cls").join(found, "cls", "left").select(
        "cls", "component_id", (F.coalesce("near", F.lit(0)) + F.col("equal") - 1).alias("n_links"),
        F.coalesce("classes", F.lit(0)).cast("bigint").alias("n_class_links"))
    none = F.lit(0).cast("bigint")
    return every[0].join(sums, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "n_class_links").unionByName(
        every[1].select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                        none.alias("n_links"), none.alias("n_class_links")))


def class_links(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b, shared, n_a, n_b): every link between different sets once, each named by the smallest
    id of its rows, with the shingles they share and have. Rows of one set are one class; a
    class whose ids are all null has a null name."""
    _, by_class, rows = _families(spark, docs, id_col, text_col, words, percent)
    named = by_class.join(rows.select("cls", "n"), "cls").select("cls", "rep", "n")
    ends = [named.select(F.col("cls").alias(c), F.col("rep").alias(f"rep_{c}"), F.col("n").alias(f"n_{c}")) for c in "ab"]
    both = family_links(spark, rows, percent, pairs=True).join(ends[0], "a").join(ends[1], "b")
    ordered = F.col("rep_a") <= F.col("rep_b")
    pick = lambda x, y: F.when(ordered, F.col(x)).otherwise(F.col(y))
    return both.select(pick("rep_a", "rep_b").alias("a"), pick("rep_b", "rep_a").alias("b"), "shared",
                       pick("n_a", "n_b").alias("n_a"), pick("n_b", "n_a").alias("n_b"))


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (null ids last; of equal
    ids, the smallest hash of the text). Rows without words link with nothing and stay."""
    every, named, _ = _labelled(spark, docs, id_col, text_col, words, percent)
    rows = every.where(F.col("cls").isNotNull()).join(named.select("cls", "root"), "cls")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("r")).select(
        F.col("r.doc_id").alias("keep_id"), F.col("r.key").alias("keep_key"))
    first = common.written(spark, first, "kept")
    names = docs.columns
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(id_col).alias("keep_id"),
                      F.xxhash64(text_col).alias("keep_key"), F.coalesce(F.col(text_col).rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False)).alias("worded"))
    chosen = row.where("worded").join(
        first.withColumnsRenamed({"keep_id": "i", "keep_key": "k"}),
        F.col("keep_id").eqNullSafe(F.col("i")) & (F.col("keep_key") == F.col("k")), "left_semi").dropDuplicates(["keep_id", "keep_key"])
    back = [F.col("row")[c].alias(c) for c in names]
    return chosen.select(*back).unionByName(row.where("not worded").select(*back))
