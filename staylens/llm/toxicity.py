"""Toxicity scores by nearest labelled examples.

Examples are a sample of labelled rows with a documented bound: the ``EXAMPLES`` rows of
lowest id hash (texts over ``EXAMPLE_CHARS`` characters are passed by). All other work
covers every row and every word.

Terms are the lower-case words. A text is its TF-IDF vector over all its words at unit length:
(1 + ln tf) (ln((N + 1) / (df + 1)) + 1), df being counted over the N examples (0 for a word
that no example has, which still counts in the length). Words that tell the labels apart weigh
more: times 1 + ratio / ``WEIGHING``, the log-likelihood ratio over contexts, where a word
counts once per word before it and label, so that copies of one text tell nothing, and which
is 0 under ``CONTEXTS`` contexts. No word has no weight.

The examples' vectors lie in blocks of similar examples: the ``FREQUENT`` most frequent terms
as a matrix with each term's highest weight per block, all others as postings. The postings of
a query's terms are summed exactly for every example; with the highest weights they bound
every block, and blocks are opened from the highest bound on, ``ROUND`` at a time, unless none
can beat the ``NEIGHBOURS``-th best cosine: so the nearest examples are exact. Each votes with
its cosine; the vote share is mapped to a score by isotonic regression over the examples
themselves, each scored without itself. A text without any word of an example gets the rate
among the examples without words.

The index goes to the tasks as a broadcast, bounded by the sample. The pass over documents is
narrow; ``QUERIES`` texts are searched side by side.

Cases: null and empty texts have no terms; without labelled rows every score is 0; equal
cosines go by the example's place, which follows the id; repeated documents each give a row; repeated
labels of one id count as toxic if one is; a null id keeps its row and is never an example;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from staylens.llm import common

EXAMPLES = 4000
EXAMPLE_CHARS = 100_000
TELLING = 30.0
CONTEXTS = 5
#: Of 3, 10, 30, 100 and 1e9 (none) the one of lowest ``fold_loss`` over the learning rows of sf0.1.
WEIGHING = 10.0
FOLDS = 3
NEIGHBOURS = 24
BLOCK = 64
ROUND = 8
FREQUENT = 512
QUERIES = 256
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def plain(word: str) -> str:
    return _EDGES.sub("", word.lower())


def ratios(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Per word the log-likelihood ratio of its contexts by label; 0 if it has few."""
    seen: tuple[set, set] = (set(), set())
    for text, y in zip(texts, labels):
        words = [w for w in map(plain, text.split()) if w]
        seen[int(y)].update(zip(words, ["", *words]))
    counts: dict[str, list[int]] = {}
    for y in (0, 1):
        for w, _ in seen[y]:
            counts.setdefault(w, [0, 0])[y] += 1
    totals = np.array([len(seen[0]), len(seen[1])], float)
    words = sorted(counts)
    found = np.array([counts[w] for w in words], float).reshape(-1, 2)
    every = found.sum(axis=1)
    if not totals.all():
        return dict.fromkeys(words, 0.0)
    want = every[:, None] * totals / totals.sum()
    rest, other = totals - found, totals - want
    cells = found * np.log(np.maximum(found, 1e-9) / want) + rest * np.log(np.maximum(rest, 1e-9) / other)
    return dict(zip(words, np.where(every < CONTEXTS, 0.0, np.maximum(2 * cells.sum(axis=1), 0.0)).tolist()))


def telling_terms(texts: list[str], labels: np.ndarray) -> list[str]:
    """Words whose contexts tell the labels apart."""
    return [w for w, ratio in ratios(texts, labels).items() if ratio >= TELLING]


@dataclass
class Index:
    """Block-max index of unit vectors: frequent terms dense, the others as postings."""
    terms: dict[str, int]  # frequent ones first
    factors: np.ndarray  # of every term; a last one for words that no example has
    weights: np.ndarray  # (examples, frequent terms), in block order
    ids: list
    labels: np.ndarray
    none_rate: float  # of label 1 among examples without terms
    prior: float
    highest: np.ndarray = field(default=None)  # (frequent terms, blocks)
    starts: np.ndarray = field(default=None)  # postings of each other term: from, to
    places: np.ndarray = field(default=None)
    values: np.ndarray = field(default=None)
    votes: np.ndarray = field(default=None)  # steps of the calibration
    rates: np.ndarray = field(default=None)

    def queries(self, rows: np.ndarray, numbers: np.ndarray, tf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of n texts, given as (text, term, tf) with any number from len(terms) on for words
        that no example has: weights of the frequent terms, and cosines by the other terms."""
        known, width, size = len(self.terms), self.weights.shape[1], len(self.weights)
        value = (1 + np.log(tf)) * self.factors[np.minimum(numbers, known)]
        value = value / np.sqrt(np.bincount(rows, value ** 2, n))[rows]
        dense = np.zeros((n, width))
        at = numbers < width
        dense[rows[at], numbers[at]] = value[at]
        at = (numbers >= width) & (numbers < known)
        begin, end = self.starts[numbers[at] - width], self.starts[numbers[at] - width + 1]
        posting, lengths = common.ragged(begin, end - begin), end - begin
        rest = np.bincount(np.repeat(rows[at], lengths) * size + self.places[posting],
                           self.values[posting] * np.repeat(value[at], lengths), n * size)
        return dense, rest.astype(float, copy=False).reshape(n, size)  # no postings count as integers

    def nearest_all(self, dense: np.ndarray, rest: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the places and cosines of the k nearest examples with a positive cosine, best first."""
        n, size = rest.shape
        found = np.full((n, size), -1.0)
        edges = np.arange(0, size, BLOCK)
        bounds = dense @ self.highest + np.maximum.reduceat(rest, edges, axis=1)
        top = np.zeros((n, k))
        # cosines are no lower than their parts
        least = np.maximum(np.partition(rest, size - k, axis=1)[:, size - k], 0) if size >= k else np.zeros(n)
        order = np.argsort(-bounds.max(axis=0), kind="stable")
        for r in range(0, len(order), ROUND):
            some = np.sort(order[r:r + ROUND])
            best = bounds[:, some].max(axis=1)
            # a little room for rounding, as a bound is summed in another order
            rows = np.flatnonzero((best > 0) & (best >= least - 1e-9))
            if not len(rows):
                continue
            cols = np.concatenate([np.arange(b * BLOCK, min((b + 1) * BLOCK, size)) for b in some])
            cosines = dense[rows] @ self.weights[cols].T + rest[np.ix_(rows, cols)]
            found[np.ix_(rows, cols)] = cosines
            top[rows] = np.partition(np.concatenate([top[rows], cosines], axis=1), -k, axis=1)[:, -k:]
            least[rows] = np.maximum(least[rows], top[rows].min(axis=1))
        out = []
        for row, low in zip(found, least):
            at = np.flatnonzero((row > 0) & (row >= low - 1e-9))
            at = at[np.lexsort((at, -np.round(row[at], 12)))[:k]]
            out.append((at, row[at]))
        return out

    def nearest(self, query: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples of a vector over the frequent terms."""
        return self.nearest_all(query[None], np.zeros((1, len(self.weights))), k)[0]

    def vote(self, best: np.ndarray, cosines: np.ndarray) -> float:
        """Share of label 1 in the votes, drawn a little to the prior."""
        return float((cosines @ self.labels[best] + self.prior) / (cosines.sum() + 1)) if len(best) else self.none_rate

    def score(self, best: np.ndarray, cosines: np.ndarray) -> float:
        return float(np.interp(self.vote(best, cosines), self.votes, self.rates))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of least squares through (x, y), one more of each label in the ends."""
    order = np.argsort(x, kind="stable")
    x, y = np.concatenate([[0.0], x[order], [1.0]]), np.concatenate([[0.0], y[order], [1.0]])
    pools: list[list[float]] = []  # sum, weight, first x, last x
    for a, b in zip(x, y):
        pools.append([b, 1.0, a, a])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            s, w, _, last = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w
            pools[-1][3] = last
    xs = [v for p in pools for v in (p[2], p[3])]
    ys = [p[0] / p[1] for p in pools for _ in range(2)]
    return np.array(xs), np.array(ys)


def build(ids: list, texts: list[str], labels: list[int], frequent: int = FREQUENT, weighing: float = WEIGHING) -> Index | None:
    y = np.array(labels, np.float64)
    if not len(y):
        return None
    ratio = ratios(texts, y)
    words = [[w for w in map(plain, text.split()) if w] for text in texts]
    df: dict[str, int] = dict.fromkeys(ratio, 0)
    for row in words:
        for w in set(row):
            df[w] += 1
    terms = {w: i for i, w in enumerate(sorted(df, key=lambda w: (-df[w], w)))}
    factors = np.array([(np.log((len(y) + 1) / (df[w] + 1)) + 1) * (1 + ratio[w] / weighing) for w in terms] + [np.log(len(y) + 1) + 1])
    prior = float(y.mean())
    without = [y[i] for i, row in enumerate(words) if not row]
    rate = (sum(without) + prior) / (len(without) + 1)
    some = [i for i, row in enumerate(words) if row]
    if not some:
        return Index({}, factors, np.empty((0, 0)), [], np.empty(0), rate, prior)
    rows, heaviest = [], []
    for i in some:
        numbers, tf = np.unique(np.fromiter(map(terms.__getitem__, words[i]), np.int64), return_counts=True)
        value = (1 + np.log(tf)) * factors[numbers]
        rows.append((numbers, tf, value / np.linalg.norm(value)))
        first = numbers[np.argsort(-value, kind="stable")[:3]]
        heaviest.append(np.pad(first, (0, 3 - len(first)), constant_values=len(terms)))
    # similar examples share a block: ordered by their heaviest terms
    order = np.lexsort(np.array(heaviest).T[::-1])
    rows = [rows[i] for i in order]
    place = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    number, tf, value = (np.concatenate([r[c] for r in rows]) for c in range(3))
    width = min(frequent, len(terms))
    out = Index(terms, factors, np.zeros((len(rows), width)), [ids[some[i]] for i in order], y[some][order], rate, prior)
    at = number < width
    out.weights[place[at], number[at]] = value[at]
    out.highest = np.maximum.reduceat(out.weights, np.arange(0, len(rows), BLOCK), axis=0).T
    at = np.flatnonzero(~at)
    at = at[np.argsort(number[at], kind="stable")]
    out.starts = np.searchsorted(number[at], np.arange(width, len(terms) + 1))
    out.places, out.values = place[at].astype(np.int32), value[at]
    votes = []
    for a in range(0, len(rows), QUERIES):
        b = min(a + QUERIES, len(rows))
        part = (place >= a) & (place < b)
        dense, rest = out.queries(place[part] - a, number[part], tf[part], b - a)
        rest[np.arange(b - a), np.arange(a, b)] = -np.inf  # itself
        votes += [out.vote(*found) for found in out.nearest_all(dense, rest)]
    out.votes, out.rates = isotonic(np.array(votes), out.labels)
    return out


def fold_loss(ids: list, texts: list[str], labels: list[int], weighing: float = WEIGHING, folds: int = FOLDS) -> float:
    """Mean log loss of labelled rows, each scored by an index of the other folds' rows. A
    weighing is chosen by it among the rows to learn from, so that held-out ones choose nothing."""
    fold = np.array([zlib.crc32(str(i).encode()) // 5 % folds for i in ids])
    losses = []
    for f in range(folds):
        rest, own = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
        index = build([ids[i] for i in rest], [texts[i] for i in rest], [labels[i] for i in rest], weighing=weighing)
        for i in own:
            words: dict[str, int] = {}
            for w in map(plain, texts[i].split()):
                if w:
                    words[w] = words.get(w, 0) + 1
            numbers = np.array([index.terms.get(w, len(index.terms)) for w in words] if index else [], np.int64)
            score = index.none_rate if index else 0.0
            if index and (numbers < len(index.terms)).any():
                tf = np.fromiter(words.values(), np.int64, len(words))
                score = index.score(*index.nearest_all(*index.queries(np.zeros(len(words), np.int64), numbers, tf, 1))[0])
            score = min(max(score, 1e-3), 1 - 1e-3)
            losses.append(-math.log(score if labels[i] else 1 - score))
    return sum(losses) / max(1, len(losses))


def examples(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             learn: Column | None = None, most: int = EXAMPLES) -> tuple[list, list[str], list[int]]:
    """Ids, texts and labels of the sample. learn: a condition on the labels' id column."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows if learn is None else rows.where(learn)
    chosen = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y")).orderBy(
        F.xxhash64(F.col("id").cast("string")), "id").limit(most)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(
        F.col("t").isNotNull() & (F.length("t") <= EXAMPLE_CHARS))
    got = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("t").alias("t"), F.max("y").alias("y")).collect()
    got.sort(key=lambda r: r["id"])
    return [r["id"] for r in got], [r["t"] for r in got], [int(r["y"] > 0) for r in got]


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", learn: Column | None = None) -> DataFrame:
    """(doc_id, score, n_terms, evidence) of every row; evidence holds up to three nearest
    examples as (example_id, label, cosine)."""
    shared = spark.sparkContext.broadcast(build(*examples(docs, labels, id_col, text_col, label_col, learn)))
    id_type = docs.schema[id_col].dataType
    example = pa.struct([("example_id", to_arrow_type(labels.schema[id_col].dataType)), ("label", pa.int32()), ("cosine", pa.float64())])

    def run(batches):
        index = shared.value
        for batch in common.blocks(batches, "text"):
            n = batch.num_rows
            score, count, evidence = np.full(n, index.none_rate if index else 0.0), np.zeros(n, np.int64), [[]] * n
            if index and index.terms:
                known = len(index.terms)
                chunks, at, offsets = common.coded(pc.utf8_split_whitespace(pc.fill_null(batch.column(1), "")))
                new: dict[str, int] = {"": -1}
                get = index.terms.get
                number = np.fromiter((get(w, -2) if get(w, -2) >= 0 else new.setdefault(w, known + len(new)) for w in map(plain, chunks)),
                                     np.int64, len(chunks))[at]
                row = np.repeat(np.arange(n), np.diff(offsets))[number >= 0]
                width = known + len(new) + 1
                pairs, tf = np.unique(row * width + number[number >= 0], return_counts=True)
                row, number = pairs // width, pairs % width
                count = np.bincount(row, tf * (number < known), n).astype(np.int64)
                ask = np.flatnonzero(count)
                for a in range(0, len(ask), QUERIES):
                    part = ask[a:a + QUERIES]
                    here = common.ragged(np.searchsorted(row, part), np.searchsorted(row, part, "right") - np.searchsorted(row, part))
                    found = index.nearest_all(*index.queries(np.searchsorted(part, row[here]), number[here], tf[here], len(part)))
                    for i, (best, cosines) in zip(part, found):
                        score[i] = index.score(best, cosines)
                        evidence[i] = [{"example_id": index.ids[j], "label": int(index.labels[j]), "cosine": float(c)}
                                       for j, c in zip(best[:3], cosines[:3])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(count), pa.array(evidence, pa.list_(example))],
                names=["doc_id", "score", "n_terms", "evidence"])
    fields = f"example_id {labels.schema[id_col].dataType.simpleString()}, label int, cosine double"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type.simpleString()}, score double, n_terms bigint, evidence array<struct<{fields}>>".replace(
            "example_id ", "example_id: ").replace("label int", "label: int").replace("cosine double", "cosine: double"))
