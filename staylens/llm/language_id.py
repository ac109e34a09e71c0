"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text recognises every substring of that text.
A text is parsed greedily into the longest phrases that an automaton knows; a phrase costs
log2 of the automaton's text length (it points to a place there). The language whose
phrases cost the fewest bits per character wins.

Texts are folded first: lower case, each run of other characters than letters is one space,
letters outside the automata's alphabet are one rare symbol. The folded texts of a block are
parsed side by side in segments of ``SEGMENT`` characters, all of them, so a step of every
segment is one lookup in a dense transition table.

The labelled text is a sample with a documented bound: the rows of a language are dealt into
``SAMPLE_CELLS`` cells by a hash of doc_id, and the least hash of each cell is chosen (a partial
aggregate, so no task sees a language's rows together). Of each chosen text a passage of at most
``PASSAGE`` characters is read, at a place that the hash gives, and of the folded passages so
many are learned as ``SAMPLE_CHARS`` characters hold, the last one cut. So every labelled
language with letters is learned, also one of long texts only. All other work covers every row and
every character.

Cases: a null text or one without a letter is ``und`` with score 0, as is every text if no
row is labelled; equal costs go to the first language by name; repeated rows each give a
row; a null doc_id keeps its row (it counts as empty text for the split); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common

SAMPLE_CELLS = 300
PASSAGE = 2_000
SAMPLE_CHARS = 24_000
SEGMENT = 256
#: Letters kept as symbols of their own; the others share one.
ALPHABET = 120
UNDETERMINED = "und"
#: How sharply costs turn into a score.
SHARPNESS = 12.0

_OTHERS = re.compile(r"[\W\d_]+")


def fold(text: str) -> str:
    out = _OTHERS.sub(" ", text.lower()).strip()
    if out and not out.replace(" ", "").isalpha():  # figures such as \u00bd and \u2167 are word characters
        out = " ".join("".join(c if c.isalpha() else " " for c in out).split())
    return out


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton; state 0 is the root."""
    step: list[dict[str, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        cur = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return step


@dataclass
class Model:
    languages: list[str]
    symbols: str
    tables: list[np.ndarray]  # (states * symbols) next state, 0 if there is none
    bits: list[float]  # cost of a phrase

    @property
    def width(self) -> int:
        return len(self.symbols) + 2

    def codes(self) -> np.ndarray:
        """Symbol numbers by code point; 1 is the shared one, 0 the padding."""
        out = np.ones(0x110000, np.uint8)
        for i, c in enumerate(self.symbols):
            out[ord(c)] = i + 2
        return out


def train(texts: dict[str, list[str]], chars: int = SAMPLE_CHARS, alphabet: int = ALPHABET) -> Model:
    """A model of folded texts by language."""
    kept = {}
    for lang in sorted(texts):
        out, size = [], 0
        for t in map(fold, texts[lang]):
            if t and size < chars:
                out.append(t[:chars - size])
                size += len(t) + 1
        if out:
            kept[lang] = " ".join(out)
    counts: dict[str, int] = {}
    for t in kept.values():
        for c in set(t):
            counts[c] = counts.get(c, 0) + t.count(c)
    symbols = "".join(sorted(sorted(counts, key=lambda c: (-counts[c], c))[:alphabet]))
    model = Model(list(kept), symbols, [], [])
    width, number = model.width, {c: i + 2 for i, c in enumerate(symbols)}
    for t in kept.values():
        step = automaton("".join(c if c in number else "\1" for c in t))
        # a last state without transitions: the phrase of a symbol that the text lacks
        table = np.zeros((len(step) + 1, width), np.int32)
        for s, to in enumerate(step):
            for c, n in to.items():
                table[s, number.get(c, 1)] = n
        model.tables.append(table.ravel() * width)  # a state's first cell
        model.bits.append(float(np.log2(len(t) + 2)))
    return model


def phrases(table: np.ndarray, grid: np.ndarray, dead: int) -> np.ndarray:
    """Phrases of each segment. grid: a row of symbols for each place, 0 beyond an end.

    Segments stand by length, longest first, so those still running are a prefix."""
    count = np.zeros(grid.shape[1], np.int32)
    state = np.zeros(grid.shape[1], np.int32)
    running = np.count_nonzero(grid, axis=1)
    for place, (row, n) in enumerate(zip(grid, running)):
        if not n:
            break
        c = row[:n].astype(np.int32)
        to = table[state[:n] + c]
        ended = np.flatnonzero(to == 0)
        if len(ended):
            count[ended] += place > 0  # nothing ends at the first place
            first = table[c[ended]]  # the phrase that starts here
            to[ended] = np.where(first, first, dead)
        state[:n] = to
    return count + (running[0] > np.arange(grid.shape[1])) if len(grid) else count


def costs(model: Model, codes: np.ndarray, texts: list[str], segment: int = SEGMENT) -> np.ndarray:
    """Bits per character of each folded, non-empty text for each language."""
    points = codes[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // segment)
    row = np.repeat(np.arange(len(texts)), n)
    within = common.ragged(np.zeros(len(n), np.int64), n) * segment
    start = (np.cumsum(sizes) - sizes)[row] + within
    length = np.minimum(sizes[row] - within, segment)
    order = np.argsort(-length, kind="stable")
    row, start, length = row[order], start[order], length[order]
    places = np.arange(segment)[:, None]
    grid = np.where(places < length, np.append(points, 0)[np.minimum(start + places, len(points))], 0).astype(np.uint8)
    out = np.empty((len(texts), len(model.tables)))
    for k, table in enumerate(model.tables):
        out[:, k] = np.bincount(row, phrases(table, grid, len(table) - model.width), len(texts)) * model.bits[k] / sizes
    return out


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           cells: int = SAMPLE_CELLS, passage: int = PASSAGE, learn: Column | None = None) -> dict[str, list[str]]:
    """Per language passages of the rows with the least hash of each cell; ``cells`` passages of
    ``passage`` characters at most. Texts are read for the chosen rows only."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows if learn is None else rows.where(learn)
    rows = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col).cast("string")).alias("h"),
                       F.col(text_col).alias("text"))
    first = rows.groupBy("lang", F.pmod("h", F.lit(cells))).agg(F.min("h").alias("h")).select("lang", "h")
    place = F.pmod(F.xxhash64(F.col("h")), F.greatest(F.length("text") - passage + 1, F.lit(1))).cast("int")
    # a repeated id brings more rows than were chosen; the least passage stands for them, so the bound holds
    chosen = rows.join(F.broadcast(first), ["lang", "h"], "left_semi").select(
        "lang", "h", F.substring("text", place + 1, F.lit(passage)).alias("text"))
    out: dict[str, list[str]] = {}
    for r in chosen.groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("h", "lang").collect():
        out.setdefault(r["lang"], []).append(r["text"])
    return out


class Reader:
    """Languages, scores and bits per character of the texts of a block."""

    def __init__(self, model: Model):
        self.model, self.codes = model, model.codes()

    def read(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        m = self.model
        folded = [fold(t or "") for t in texts.to_pylist()]
        some = [i for i, t in enumerate(folded) if t and m.tables]
        lang, score, best = [UNDETERMINED] * len(folded), np.zeros(len(folded)), np.full(len(folded), np.nan)
        if some:
            bits = costs(m, self.codes, [folded[i] for i in some])
            at = np.argmin(bits, axis=1)
            low = bits[np.arange(len(some)), at]
            weight = np.exp(-SHARPNESS * (bits / low[:, None] - 1))
            for i, k in zip(some, at):
                lang[i] = m.languages[k]
            score[some], best[some] = 1 / weight.sum(axis=1), low
        return lang, score, best


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", learn: Column | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_char) of every row.

    learn: which rows may be learned from (all labelled ones by default)."""
    shared = spark.sparkContext.broadcast(train(sample(docs, id_col, text_col, lang_col, learn=learn)))

    def run(batches):
        reader = Reader(shared.value)
        for batch in common.blocks(batches, "text", 1 << 20):
            lang, score, best = reader.read(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(best, from_pandas=True)],
                names=["doc_id", "lang_pred", "score", "bits_per_char"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double, bits_per_char double")


def accept(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """``docs`` with the language found in ``lang_col``, without the rows whose language is not
    determined or whose score is under ``least``; all other columns are kept."""
    shared = spark.sparkContext.broadcast(train(sample(docs, id_col, text_col, lang_col)))
    place, lang_place = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        reader = Reader(shared.value)
        for batch in common.released(batches):
            for part, _ in common.placed_blocks(batch, place, 1 << 20):
                lang, score, _ = reader.read(part.column(place))
                kept = pa.array([x != UNDETERMINED and s >= least for x, s in zip(lang, score)], pa.bool_())
                found = pa.array(lang, pa.string()).cast(part.schema.field(lang_place).type)
                yield part.set_column(lang_place, part.schema.field(lang_place), found).filter(kept)
    return docs.mapInArrow(run, docs.schema)
