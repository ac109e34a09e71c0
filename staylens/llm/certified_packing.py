"""Best-fit packing whose sequence counts are certified by dual-feasible functions.

Texts become token ids and an end id. Only a text longer than a sequence is cut, into whole
sequences, the first piece taking what is left over. Pieces are dealt into shares of about the
session's advisory partition size (the REBALANCE hint, so that their number follows the data and
a share is bounded), and each share is packed by best-fit decreasing.

A dual-feasible function f maps lengths to [0, 1] so that no set of pieces that fits one sequence
has a sum above 1; the sum over all pieces of a share, rounded up, then bounds its number of
sequences from below. The bound used is the greatest over the threshold functions (long pieces
count whole, short ones nothing) and the staircase functions floor((k + 1) x) / k. A share whose
count meets its bound is certified: no packing of it is better, and it has less than a sequence of
room, which the rounding of shares costs.

Shares with a gap exchange documents: the pieces of their sequences that are not full are dealt anew,
with those of the emptiest sequences of the other shares, and packed by best-fit decreasing again.
A round that saves no sequence is undone and ends the exchange; else it goes on until the whole
meets the whole's bound, at most ``ROUNDS`` times.

Cases: a null or empty text holds the end id alone; repeated rows are packed each; a null doc_id
keeps its row; an empty table gives an empty result; ties of length go by id, piece and digest;
other columns are not read. A very long text is encoded whole and gives as many pieces as it needs.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common
from staylens.llm.packing import best_fit

TOKENIZER = "byte_bpe_50k.json"
WINDOW = 2048
END_ID = 0
#: Exchanges of documents at most.
ROUNDS = 4
#: Staircase functions have up to so many steps.
STEPS = 24
BLOCK_BYTES = 4 << 20
_ROUND_BITS, _SHARE_BITS = 56, 32


#: The pattern by which byte-level pre-tokenizers of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters, figures and marks whose kind is the same in all Unicode tables since long.
_SETTLED = re.compile("[\x00-\u0220\u0391-\u03a1\u03a3-\u03c9\u0400-\u045f\u05d0-\u05ea\u0621-\u063a\u0905-\u0939\u0e01-\u0e30"
                      "\u2010-\u2027\u2030-\u203a\u20ac\u3001-\u3003\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e]*")
#: Merging a stretch of one kind takes the rank encoder the square of its length; one of twice
#: ``_STRETCH`` characters fills a part of so many, where no space meets a non-space.
_STRETCH, _EDGE = 500, re.compile(r"\S\s|\s\S")


def overlong(text: str) -> bool:
    return not all(_EDGE.search(text, i, i + _STRETCH) for i in range(0, len(text) - _STRETCH + 1, _STRETCH))


def rank_encoder(t):
    """The vocabulary of a byte-level tokenizer as a rank encoder, which is several times faster, or None
    if its merges are not in the order of its ids or it does more than byte-level splitting."""
    spec = json.loads(t.to_str())
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges") or ()]
    plain = (model["type"] == "BPE" and not spec["normalizer"] and split.get("type") == "ByteLevel"
             and not split.get("add_prefix_space") and split.get("use_regex", True) and not model.get("dropout")
             and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
             and all(model["vocab"].get(x) == 256 + i for i, x in enumerate(joined)))
    if not plain:
        return None
    import tiktoken
    byte = {letter: b for b, letter in common.byte_letters().items()}
    ranks = {bytes(byte[c] for c in x): model["vocab"][x] for x in [*byte, *joined]}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteIds:
    """Ids of texts as the tokenizers library gives them. Texts of settled characters, without special
    strings and overlong words, take the rank encoder, which gives the same ids."""

    def __init__(self, tokenizer: str):
        self.t = common.load_tokenizer(tokenizer)
        self.specials = [v.content for v in self.t.get_added_tokens_decoder().values()]
        self.ranks = rank_encoder(self.t)

    def _ids(self, text: str) -> np.ndarray:
        if (self.ranks is None or any(s in text for s in self.specials) or overlong(text)
                or not _SETTLED.fullmatch(text)):
            return np.array(self.t.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranks.encode_to_numpy(text)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one text after another, and the number of ids of each text."""
        ids = [self._ids(x or "") for x in texts.to_pylist()]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
           window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids): every text's ids and the end id; a longer one is cut into
    pieces of a whole window, but for the first. ``ids`` holds little-endian unsigned 32-bit ids."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        words = common.per_worker(ByteIds, tokenizer)
        for batch in common.blocks(batches, "text", BLOCK_BYTES):
            flat, counts = words.of(batch.column(1))
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            n = -(-counts // window)
            row = np.repeat(np.arange(len(counts)), n)
            piece = common.ragged(np.zeros(len(n), np.int64), n)
            first = counts - (n - 1) * window
            start = np.where(piece == 0, 0, first[row] + (piece - 1) * window)
            length = np.where(piece == 0, first[row], window)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 common.binary_runs(flat, length)], names=["doc_id", "piece", "start", "length", "ids"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary")


def bound(counts: np.ndarray, window: int = WINDOW, met: int | None = None) -> int:
    """A lower bound of the number of sequences that hold ``counts[x]`` pieces of each length x; no
    better one is sought once it is ``met``.

    Every threshold function is followed by every staircase function; sums are whole numbers,
    of units of 1 / (k * window), so that rounding up is exact."""
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return 0
    number = counts[lengths].astype(np.int64)
    best = -(-int((number * lengths).sum()) // window)
    # a threshold function changes only where a length drops out or its complement rises
    marks = np.unique(np.concatenate([[1], lengths[2 * lengths <= window], window - lengths[2 * lengths > window] + 1]))
    for mark in marks[(marks >= 1) & (2 * marks <= window + 1)].tolist():
        if met is not None and best >= met:
            break
        kept = np.where(lengths > window - mark, window, np.where(lengths >= mark, lengths, 0))
        best = max(best, -(-int((number * kept).sum()) // window))
        for k in range(1, STEPS + 1):
            steps = (k + 1) * kept
            units = np.where(steps % window == 0, k * kept, steps // window * window)
            best = max(best, -(-int((number * units).sum()) // (k * window)))
    return best


def emptiest(room: np.ndarray) -> np.ndarray:
    """The sequences of most room that hold nine tenths of all room together."""
    order = np.argsort(-room, kind="stable")
    before = np.cumsum(room[order]) - room[order]
    out = np.zeros(len(room), bool)
    out[order] = (before < 0.9 * room.sum()) & (room[order] > 0)
    return out


def packed(parts: DataFrame, turn: int, window: int = WINDOW) -> DataFrame:
    """``parts`` dealt into shares and packed: sequence_id, offset, and whether the piece goes into
    the next exchange (``open``). ``gap`` is the share's count less its bound."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        share = pa.Table.from_batches(got)
        order = [(c, "descending" if c == "length" else "ascending")
                 for c in ("length", *(c for c in share.column_names if c != "length"))]
        share = share.sort_by(order)
        lengths = share.column("length").to_numpy()
        number, offset = best_fit(lengths, window)
        made = int(number.max()) + 1
        gap = made - bound(np.bincount(lengths, minlength=window + 1), window, made)
        filled = np.bincount(number, lengths, made)
        going = filled < window if gap else emptiest(window - filled)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        out = share.append_column("sequence_id", pa.array(number + (turn << _ROUND_BITS) + (task << _SHARE_BITS)))
        out = out.append_column("offset", pa.array(offset)).append_column("open", pa.array(going[number]))
        yield from out.append_column("gap", pa.array(np.full(len(lengths), gap))).to_batches(max_chunksize=65536)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return parts.hint("rebalance").mapInArrow(run, f"{fields}, sequence_id bigint, offset bigint, open boolean, gap bigint")


def _sequences(rows: DataFrame) -> int:
    return rows.where("offset = 0").count()


def whole_bound(parts: DataFrame, window: int = WINDOW) -> int:
    """The lower bound over all pieces, from their number by length (at most ``window`` rows)."""
    counts = np.zeros(window + 1, np.int64)
    for r in parts.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return bound(counts, window)


def pack(spark: SparkSession, parts: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``parts`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset. Each round is a
    written table, and a round's rows are those that the last one left open."""
    names = parts.columns
    parts = common.written(spark, parts, "certified-pieces")
    least = whole_bound(parts, window)
    now = common.written(spark, packed(parts, 0, window), "certified-0")
    total, done, open_rows = _sequences(now), now.where("not open"), now.where("open")
    for turn in range(1, rounds + 1):
        before = _sequences(open_rows)
        if total <= least or before < 2:
            break
        now = common.written(spark, packed(open_rows.select(*names), turn, window), f"certified-{turn}")
        after = _sequences(now)
        if after >= before:
            break
        total += after - before
        done, open_rows = done.unionByName(now.where("not open")), now.where("open")
    return done.unionByName(open_rows).select(*names, "sequence_id", "offset")
