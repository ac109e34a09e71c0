"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Words of the benchmark are counted over the whole corpus.
2. A seed is the shortest n-gram of an item (``SHORTEST`` to ``LONGEST`` words) that chance
   would bring at most ``EXPECTED`` times into the corpus, were its words independent. So an
   n-gram of frequent words grows until it is rare, and a passage that leaked into many
   documents keeps its seeds, since not its own frequency counts. Where nothing is rare at the
   longest, it grows on up to the whole item; an item that chance alone brings is no evidence.
3. Seeds join every document's words to items; around each hit the passage that the whole
   item could cover is aligned with the item. The score is the best local alignment over
   the best possible, 2 a match, -1 a change, a gap or an extra word. From ``SCORE`` on, but
   at least ``LEAST`` words' worth of matches, or from ``RUN`` words' worth on, the document
   holds the item.

The benchmark goes to the tasks in parts of at most ``PART_BYTES`` of text (one pass over the
documents each), so its size is bounded, not assumed. Documents are one narrow pass: no
shuffle of texts, no pairs beyond seed hits, and equal passages of a task are aligned once.

Words of both sides are runs between white space (all of Unicode's), lower case, without other
characters than letters and digits. Cases: null or empty texts and items match nothing, as do
items of fewer than ``LEAST`` words or of frequent words only ("yes", "the end of the");
repeated rows each give their rows; repeated items are items; null ids are kept; a document
with an item twice gives the best passage, the first on a tie; empty tables give an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from staylens.llm import common

SHORTEST, LONGEST = 3, 8
EXPECTED = 0.5
SCORE = 0.5
RUN = 20
LEAST = 5
MATCH, MISS = 2, -1
PART_BYTES = 16 << 20
_NO_WORD = re.compile(r"[\W_]+")


def plain(word: str) -> str:
    return _NO_WORD.sub("", word.lower())


def item_words(text: str | None) -> list[str]:
    return [w for w in map(plain, (text or "").encode("utf-8", "surrogatepass").decode("utf-8", "replace").split()) if w]


class Numbers:
    """Numbers of benchmark words in texts, 0 for other words. A chunk between ASCII white space may
    hold several words, between other white space, or none."""

    def __init__(self, vocabulary: dict[str, int]):
        self.vocabulary = vocabulary

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words one text after another, and the offsets of the texts."""
        chunks, at, offsets = common.coded(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
        get, numbers, lengths = self.vocabulary.get, [], np.empty(len(chunks), np.int64)
        for i, chunk in enumerate(chunks):
            if chunk.isalnum() and chunk.isascii():
                numbers.append(get(chunk.lower(), 0))
                lengths[i] = 1
                continue
            words = [w for w in map(plain, chunk.split()) if w]
            numbers += [get(w, 0) for w in words]
            lengths[i] = len(words)
        found = np.array(numbers, np.int64)[common.ragged((np.cumsum(lengths) - lengths)[at], lengths[at])]
        return found, np.concatenate([[0], np.cumsum(lengths[at])])[offsets]


@dataclass
class Seeds:
    """Seeds by length: sorted hashes, and with each its item's place and its word offset."""
    items: list[np.ndarray]  # word numbers
    ids: list
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def _hashes(numbers: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(numbers) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = (out ^ numbers[k:k + len(out)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def seeds(ids: list, items: list[list[str]], vocabulary: dict[str, int], counts: np.ndarray, total: int) -> Seeds:
    """The seeds of each item. counts: of each benchmark word in the corpus; total: all words."""
    numbers = [np.array([vocabulary[w] for w in words], np.int64) for words in items]
    rate = np.log(np.maximum(counts, 1) / max(total, 1))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for k, item in enumerate(numbers):
        if len(item) < LEAST:
            continue
        chance = np.concatenate([[0.0], np.cumsum(rate[item])])
        limit, some = math.log(EXPECTED) - math.log(max(total, 1)), False

        def rare(i, n):
            return chance[i + n] - chance[i] <= limit
        for longest in (LONGEST, len(item)):
            for i in range(len(item) - SHORTEST + 1):
                n = next((n for n in range(SHORTEST, min(longest, len(item) - i) + 1) if rare(i, n)), 0)
                if n:
                    found.setdefault(n, []).append((k, i, n))
                    some = True
            if some:
                break
    by_length = {}
    for n, rows in found.items():
        h = np.array([_hashes(numbers[k][i:i + n], n)[0] for k, i, _ in rows], np.uint64)
        order = np.argsort(h, kind="stable")
        by_length[n] = (h[order], np.array([r[0] for r in rows])[order], np.array([r[1] for r in rows])[order])
    return Seeds(numbers, list(ids), by_length)


def seed_hits(s: Seeds, numbers: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all hits within a text: the text, the item, and where its first word would stand."""
    texts, places, firsts = [], [], []
    for n, (hashes, item, offset) in s.by_length.items():
        if len(numbers) < n:
            continue
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        at = np.flatnonzero(known[n:] - known[:-n] == n)  # all n are benchmark words
        if not len(at):
            continue
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + n <= offsets[text + 1]
        at, text = at[inside], text[inside]
        h = _hashes(numbers, n)[at]
        low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        hit = np.flatnonzero(high > low)
        k = common.ragged(low[hit], (high - low)[hit])
        texts.append(np.repeat(text[hit], (high - low)[hit]))
        places.append(item[k])
        firsts.append(np.repeat(at[hit], (high - low)[hit]) - offset[k])
    if not places:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(texts), np.concatenate(places), np.concatenate(firsts)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment: its score and its end in the passage (exclusive)."""
    width = len(passage)
    row = np.zeros(width + 1, np.int64)
    slope = -MISS * np.arange(width + 1)
    best, end = 0, 0
    for w in item:
        new = np.zeros(width + 1, np.int64)
        new[1:] = np.maximum(row[:-1] + np.where(passage == w, MATCH, MISS), row[1:] + MISS)
        # a gap along the row: the best of all cells to the left, less its length
        new = np.maximum(np.maximum.accumulate(np.maximum(new, 0) + slope) - slope, 0)
        row = new
        k = int(np.argmax(row))
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def passages(firsts: np.ndarray, length: int, words: int) -> list[tuple[int, int]]:
    """The stretches of a text that an item of ``length`` words could cover, merged."""
    slack = length // 2 + 2
    out: list[tuple[int, int]] = []
    for f in np.sort(firsts).tolist():
        a, b = max(0, f - slack), min(words, f + length + slack)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _holds(score: int, length: int) -> bool:
    return score >= MATCH * min(max(SCORE * length, LEAST), RUN)


class Finder:
    """The items that the texts of a block hold; equal passages are aligned once."""

    def __init__(self, seeds_: Seeds, vocabulary: dict[str, int]):
        self.seeds, self.numbers, self.known = seeds_, Numbers(vocabulary), {}

    def _aligned(self, k: int, passage: np.ndarray) -> tuple[int, int, int]:
        key = (k, passage.tobytes())
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            item = self.seeds.items[k]
            score, end = align(item, passage)
            # the best alignment that ends there starts where the reversed one ends
            start = end - align(item[::-1], passage[:end][::-1])[1] if score else 0
            self.known[key] = score, start, end
        return self.known[key]

    def find(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """(text, item, score, first word, end word) of all texts that hold an item."""
        numbers, offsets = self.numbers.of(texts)
        rows = []
        for d, k, firsts in _grouped(*seed_hits(self.seeds, numbers, offsets)):
            a, b = offsets[d], offsets[d + 1]
            length = len(self.seeds.items[k])
            got = [(*self._aligned(k, numbers[a + x:a + y]), x) for x, y in passages(firsts - a, length, int(b - a))]
            score, start, end, x = max(got, key=lambda g: (g[0], -g[3]))
            if _holds(score, length):
                rows.append((d, k, score / (MATCH * length), x + start, x + end))
        return rows


def _found(docs: DataFrame, shared, id_type: str, item_type: DataType) -> DataFrame:
    def run(batches):
        finder = Finder(*shared.value)
        for batch in common.blocks(batches, "text"):
            rows = finder.find(batch.column(1))
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array([finder.seeds.ids[r[1]] for r in rows], items),
                 *(pa.array([r[i] for r in rows], t) for i, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64())))],
                names=["doc_id", "item_id", "score", "word_start", "word_end"])
    items = to_arrow_type(item_type)
    return docs.mapInArrow(run, f"doc_id {id_type}, item_id {item_type.simpleString()}, score double, "
                                "word_start bigint, word_end bigint")


def _grouped(doc: np.ndarray, places: np.ndarray, firsts: np.ndarray):
    """(text, item, firsts) of the hits of each text and item."""
    order = np.lexsort((firsts, places, doc))
    doc, places, firsts = doc[order], places[order], firsts[order]
    cuts = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(places, prepend=-1) != 0))
    for a, b in zip(cuts, np.append(cuts[1:], len(doc))):
        yield int(doc[a]), int(places[a]), firsts[a:b]


def word_counts(docs: DataFrame, shared) -> tuple[np.ndarray, int]:
    """Corpus counts of the words of one benchmark part by number, and of all words."""
    def run(batches):
        _, vocabulary = shared.value
        numbers_of = Numbers(vocabulary)
        counts = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in common.blocks(batches, "text"):
            counts += np.bincount(numbers_of.of(batch.column(batch.schema.get_field_index("text")))[0], minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["number", "n"])
    rows = docs.mapInArrow(run, "number bigint, n bigint").groupBy("number").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["number"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["number"]] = r["n"]
    return counts, int(counts.sum())


def _parts(spark: SparkSession, texts: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, part_bytes: int):
    """The seeds and vocabulary of each part of the benchmark, as broadcasts."""
    bench = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // part_bytes) or 1
    for part in range(parts):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        items = [item_words(r["text"]) for r in rows]
        vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for x in items for w in x))}
        counts, total = word_counts(texts, spark.sparkContext.broadcast((None, vocabulary)))
        counts = np.pad(counts, (0, max(0, len(vocabulary) + 1 - len(counts))))
        yield spark.sparkContext.broadcast((seeds([r["item_id"] for r in rows], items, vocabulary, counts, total), vocabulary))


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, item_id, score, word_start, word_end) of the documents that hold an item; the
    last two are the passage in words of the document."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType
    found = [_found(texts, shared, id_type, item_type) for shared in _parts(
        spark, texts, benchmark, item_col, item_text_col, part_bytes)]
    return reduce(DataFrame.unionByName, found)


def remove(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item, all columns kept; no join, as a row
    is judged where it is read."""
    place, out = docs.columns.index(text_col), docs
    for shared in _parts(spark, docs.select(F.col(text_col).alias("text")), benchmark, item_col, item_text_col, part_bytes):
        def run(batches, shared=shared):
            finder = Finder(*shared.value)
            for batch in common.released(batches):
                dirty = np.zeros(batch.num_rows, bool)
                for part, start in common.placed_blocks(batch, place, 4 << 20):
                    for r in finder.find(part.column(place)):
                        dirty[start + r[0]] = True
                yield batch.filter(pa.array(~dirty))
        out = out.mapInArrow(run, docs.schema)
    return out
