"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period p, at least 4 p long, that no neighbouring
word extends keeping period p. The words of a block of documents lie one document after
another, each followed by a mark of its own, so that nothing equal reaches over an end.

*Large periods.* At each dyadic scale t a synchronising set is chosen by hashes: every
position has the hash of its next t words, and a position is chosen if the least hash of the
t + 1 positions from it on stands at the first or the last of them. The choice depends on the
next 2 t words only, so equal contexts are chosen alike, and every stretch of t positions has
a chosen one unless all its t-word windows are highly periodic (period at most t / 4), which are
left out of the choice. A run of period p in [t, 2 t) is 4 t long at least, so it holds a
chosen position whose context of 2 t words comes again p words later, and not before. Each
chosen position and the next one of equal context thus propose a period.

*Small periods.* Highly periodic regions are what the sets omit: periods below the first scale are
detected apart, by comparing all words with those p places on; at a higher scale the regions
follow from the runs of the lower ones.

Every proposal is then proved and extended word by word, so hashes only propose. Work is
about linear in the words for each scale, and scales end at a quarter of the longest text.

Cases: a null or empty text has no words and no run; its collapsed text is empty. Repeated
rows each give a row; a null id keeps its row; an empty table gives an empty result; a very
long text makes a block of its own; other columns are not read. Runs are listed by start, then
period, so there are no ties.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm import common

#: A run holds its period at least so many times.
TIMES = 4
#: The first scale of synchronising sets; periods below it are compared directly.
FIRST_SCALE = 8
BLOCK_BYTES = 4 << 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit words each (multiplications wrap around)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _joined(h: np.ndarray, by: int) -> np.ndarray:
    """The hash of twice as many words: of each position's and of the one ``by`` words on."""
    return _mixed(h, np.concatenate([h[by:], np.zeros(min(by, len(h)), np.uint64)]))


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i : i + width] for every i (cut at the end), by prefix and suffix minima."""
    n = -(-len(x) // width) * width
    padded = np.full(n + width, _NONE)
    padded[:len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:len(x)], ahead[width - 1:width - 1 + len(x)])


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words equal those ``period`` places on, with that last period."""
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        unequal = np.flatnonzero(words[low:start] != words[low + period:start + period])
        if len(unequal):
            start = low + int(unequal[-1]) + 1
            break
        start, step = low, step * 2
    end, step = at, 64
    while end + period < len(words):
        high = min(len(words) - period, end + step)
        unequal = np.flatnonzero(words[end:high] != words[end + period:high + period])
        if len(unequal):
            end += int(unequal[0])
            break
        end, step = high, step * 2
    return start, end + period


class Runs:
    """The runs found so far, each stretch once: its smallest period comes first."""

    def __init__(self):
        self.found: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        if end - start >= TIMES * period:
            self.found.setdefault((start, end), period)

    def highly_periodic(self, n: int, scale: int) -> np.ndarray:
        """Positions whose next ``scale`` words have a period of at most scale / TIMES."""
        step = np.zeros(n + 1, np.int32)
        for (start, end), period in self.found.items():
            if TIMES * period <= scale <= end - start:
                step[start] += 1
                step[end - scale + 1] -= 1
        return np.cumsum(step[:n]) > 0


def _small_periods(words: np.ndarray, runs: Runs) -> None:
    for p in range(1, min(FIRST_SCALE, len(words))):
        equal = np.zeros(len(words) - p + 2, np.int8)
        equal[1:-1] = words[p:] == words[:-p]
        step = np.diff(equal)
        starts, ends = np.flatnonzero(step > 0), np.flatnonzero(step < 0)
        long = ends - starts >= (TIMES - 1) * p
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            runs.add(start, end + p, p)


def _proposals(h: np.ndarray, scale: int, omitted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the synchronising set of a scale and the distance to the next one of equal
    context, where that is a period of the scale; ordered by period and position."""
    ids = np.where(omitted, _NONE, h)
    least = _window_min(ids, scale + 1)
    last = np.concatenate([ids[scale:], np.full(min(scale, len(ids)), _NONE)])
    chosen = np.flatnonzero((least != _NONE) & ((least == ids) | (least == last)))
    beyond = np.minimum(chosen + scale, len(h) - 1)
    context = _mixed(h[chosen], h[beyond])
    order = np.argsort(context, kind="stable")
    same = context[order[1:]] == context[order[:-1]]
    at = chosen[order[:-1][same]]
    period = chosen[order[1:][same]] - at
    fits = (period >= scale) & (period < 2 * scale)
    at, period = at[fits], period[fits]
    order = np.lexsort((at, period))
    return at[order], period[order]


def find_runs(words: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs of a block, by start and period. ``words`` are numbers
    of words, at every place in ``ends`` (of each document) a number that comes nowhere else."""
    runs = Runs()
    _small_periods(words, runs)
    lengths = np.diff(ends, prepend=-1) - 1
    at_all, scale = np.arange(len(words)), 1
    h = _mixed(words.astype(np.uint64), np.uint64(0x94D049BB133111EB))
    longest = int(lengths.max(initial=0))
    while scale < FIRST_SCALE and TIMES * FIRST_SCALE <= longest:
        h, scale = _joined(h, scale), scale * 2
    place = at_all  # where the documents that are long enough for the scale stand in the block
    of_doc = np.repeat(np.arange(len(ends)), lengths + 1)
    while scale >= FIRST_SCALE and TIMES * scale <= longest:
        long = lengths[of_doc[place]] >= TIMES * scale
        place, h = place[long], h[long]
        omitted = runs.highly_periodic(len(words), scale)[place]
        found, last = {}, (0, 0, 0)
        for i, period in zip(*(x.tolist() for x in _proposals(h, scale, omitted))):
            i = int(place[i])
            if not (last[2] == period and last[0] <= i < last[1] - period):
                last = (*_extended(words, i, period), period)
                if last[1] - period > i:
                    found[last] = None
        for run in found:
            runs.add(*run)
        h, scale = _joined(h, scale), scale * 2
    return sorted((start, end, period) for (start, end), period in runs.found.items())


def _block_runs(words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, end, period) over the words of documents given one after another."""
    n = np.diff(offsets)
    ends = np.cumsum(n + 1) - 1
    laid = np.empty(len(words) + len(n), np.int64)
    laid[ends] = int(words.max(initial=0)) + 1 + np.arange(len(n))
    inside = np.ones(len(laid), bool)
    inside[ends] = False
    laid[inside] = words
    found = find_runs(laid, ends)
    doc = np.searchsorted(ends, [r[0] for r in found])
    first = ends - n
    return [(d, s - first[d], e - first[d], p) for d, (s, e, p) in zip(doc.tolist(), found)]


def word_lists(texts: pa.Array) -> pa.ListArray:
    """The words (parted by ASCII white space) of each text, null as empty."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    keep = pc.not_equal(parts.flatten(), "")
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    offsets = upto[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts.flatten().filter(keep))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: the runs of at least ``least`` words as structs of
    start (number of the first word), length and period, and the text without the words that
    any run repeats after its first period, its words joined by one space."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in common.blocks(batches, "text", BLOCK_BYTES):
            lists = word_lists(batch.column(1))
            items = lists.values.dictionary_encode()
            words = items.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
            found = [r for r in _block_runs(words, offsets) if r[2] - r[1] >= least]
            dropped = np.zeros(len(words) + 1, np.int32)
            for d, start, end, period in found:
                dropped[offsets[d] + start + period] += 1
                dropped[offsets[d] + end] -= 1
            keep = np.cumsum(dropped[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(keep)])
            kept = pa.ListArray.from_arrays(pa.array(upto[offsets], pa.int32()), lists.values.filter(pa.array(keep)))
            counts = np.bincount([r[0] for r in found], minlength=batch.num_rows)
            spans = np.array([(s, e - s, p) for _, s, e, p in found], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(spans[:, i]) for i in range(3)], names=["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), structs)
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, pc.binary_join(kept, " ")],
                                             names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def longest_run(runs: Column) -> Column:
    """Of runs listed by start and period the longest, null if there is none; the first of ties."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"),
                                             (-best["period"]).alias("period")))


def with_periodic_tail(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every text of words; where crc32 h of the id as text has h % 10 = 0, the words
    from a = g % n on repeat the first 1 + floor((n - a) / (3 + g % 8)) of them, g = floor(h / 10)."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def tailed(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.element_at(words, a + (i - a) % p + 1))
        return F.when(n > 0, F.concat(F.slice(words, F.lit(1), a), tail)).otherwise(words)
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # an array of one, so that the words are made once and not for each of their uses
    tail = F.transform(F.array(words), lambda w: F.array_join(tailed(w), " "))[0]
    return docs.withColumn(text_col, F.when(h % 10 == 0, tail).otherwise(F.col(text_col)))
