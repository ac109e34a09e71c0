"""Packing of token sequences by best-fit decreasing.

Texts become token ids plus an end id. A text longer than a window is first cut into full
windows, which are sequences of their own, and a rest. The rests are dealt into shares of
about the session's advisory partition size (the REBALANCE hint, so their number follows
the data and a share is bounded), and each share is packed by best-fit decreasing: a
segment tree over remaining capacities finds the tightest open window.

Cases: a null text counts as empty, so it holds the end id alone; repeated rows are packed
each; a null doc_id keeps its row; an empty table gives an empty result; ties of length go
by id, start and ids; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import common

TOKENIZER = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
#: Distinct words, and ids, that a worker remembers; beyond, it starts anew.
CACHE, CACHE_IDS = 300_000, 4_000_000
_BITS = 40  # sequence numbers of a share


class WordIds:
    """Ids of texts whose tokenizer drops white space: a text is the concatenation of its
    white-space separated chunks. A chunk is a plain word and its trailing marks, or else encoded
    as it is. Each distinct word or chunk of a worker is encoded once; only proven plain words are
    among ``words``, as the library makes one pre-token of other characters and the marks after them."""

    def __init__(self, tokenizer: str):
        self.t = common.load_tokenizer(tokenizer)
        self.bytes = common.byte_letters()
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {"": 0}
        self.chunks: dict[str, int] = {}
        self.runs = common.Runs()

    def _encoded(self, text: str) -> int:
        got = self.chunks.get(text)
        if got is None:
            got = self.chunks[text] = self.runs.add(self.t.encode(text, add_special_tokens=False).ids)
        return got

    def _word(self, word: str) -> int | None:
        """The run of a plain word, None if it isn't one."""
        if not word.isalpha() or max(word) > _LAST or _DOTTED in word:
            return None
        low = word.lower()
        spelled = low if low.isascii() else "".join(map(self.bytes.__getitem__, low.encode()))
        got = self.words[word] = self.runs.add([x.id for x in self.t.model.tokenize(spelled)])
        return got

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and the number of ids of each text."""
        if len(self.words) + len(self.chunks) > CACHE or len(self.runs.pool) > CACHE_IDS:
            self.clear()
        known = self.words
        chunks, at, offsets = common.coded(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
        runs = np.zeros((len(chunks), 2), np.int64)  # of the word and of its marks
        for i, chunk in enumerate(chunks):
            word = chunk.rstrip(_MARKS)
            got = known.get(word)
            if got is None:
                got = self._word(word)
            if got is None:
                runs[i, 0] = self._encoded(chunk)
            else:
                runs[i, 0] = got
                if len(word) < len(chunk):
                    runs[i, 1] = self._encoded(chunk[len(word):])
        ids, lengths = self.runs.take(runs[at].ravel())
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids.astype(np.uint32), np.diff(upto[2 * offsets])


#: Marks that make one pre-token when they follow a word.
_MARKS = ".,;:!?)"
#: Letters up to here are composed, and lower case letter by letter; but for the dotted I.
_LAST, _DOTTED = "\u024f", "\u0130"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): every text's ids and the end id, cut into
    full windows and a rest. ``ids`` holds little-endian unsigned 32-bit ids."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words = common.per_worker(WordIds, tokenizer)
        for batch in common.blocks(batches, "text", 4 << 20):
            flat, counts = words.of(batch.column(1))
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            n = -(-counts // window)
            row = np.repeat(np.arange(len(counts)), n)
            start = common.ragged(np.zeros(len(n), np.int64), n) * window
            length = np.minimum(counts[row] - start, window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length),
                 pa.array(counts[row]), common.binary_runs(flat, length)],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, start bigint, length bigint, doc_tokens bigint, ids binary")


class CapacityTree:
    """Segment tree over capacities 0..size whose leaves count open windows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """The smallest capacity of at least ``need`` that has an open window, or -1."""
        i, count = need + self.leaves, self.count
        if count[i]:
            return need
        while i > 1:
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length, in the order given (longest first)."""
    tree, open_at = CapacityTree(window), [[] for _ in range(window + 1)]
    number, offset, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for k, n in enumerate(lengths.tolist()):
        room = tree.tightest(n)
        if room < 0:
            at, room, made = made, window, made + 1
        else:
            at = open_at[room].pop()
            tree.add(room, -1)
        number[k], offset[k] = at, window - room
        if room > n:
            open_at[room - n].append(at)
            tree.add(room - n, 1)
    return number, offset


def pack(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``parts`` (doc_id, start, length, ... fixed-size columns) with sequence_id and offset.

    Any column of ``parts`` is carried; drop long ones first, as every row is shuffled. Columns of
    ``parts`` that have these names already are left out."""
    parts = parts.drop("sequence_id", "offset")

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        share = pa.Table.from_batches(got)
        order = [(c, "descending" if c == "length" else "ascending")
                 for c in ("length", *(c for c in share.column_names if c != "length"))]
        share = share.sort_by(order)
        number, offset = best_fit(share.column("length").to_numpy(), window)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        yield from share.append_column("sequence_id", pa.array(number + (task << _BITS))).append_column(
            "offset", pa.array(offset)).to_batches(max_chunksize=65536)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return parts.hint("rebalance").mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint")
