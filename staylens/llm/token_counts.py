"""Token counts without token ids.

Every text is cut into the pre-tokens of the tokenizer. The frequencies of a block of
documents become postings, one row per (pre-token, block), which are dealt and sorted by
pre-token. So all rows of a pre-token follow each other in one task: its pieces are counted
once in the corpus, when its first row comes, and joined to all its frequencies there (a
merge join whose other side, the vocabulary, never needs a shuffle of its own). A task
hands on one row of sums per block, and these are added up block by block. No id sequence is ever made.

A pre-token in a third of all documents has one posting row per block, so no key is hot:
the rows of a block are merged before the shuffle.

Cases: a null text counts as empty (0 bytes, 0 tokens); a null doc_id keeps its row;
repeated rows each give a row; an empty table gives an empty result; other columns of
the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from staylens.llm import common

TOKENIZER = "byte_bpe_50k.json"
BLOCK_BYTES = 16 << 20
#: A worker's cache of chunks and pre-tokens is emptied beyond this many entries.
CACHE = 400_000
_BITS = 20  # of a block's row numbers and of a task's block numbers
_ROWS = 1 << 16  # of a block, at most: a cell's row number has 16 bits
_MOST = (1 << 16) - 1  # of a cell's frequency; a higher one takes several cells


class PreTokens:
    """Numbers for pre-tokens. A pre-token never goes on over a boundary between a non-space
    and a single space that precedes a non-space, so a text whose space-separated chunks
    have no white space at their edges is the concatenation of these chunks' pre-tokens.
    Each distinct chunk of a worker is cut once."""

    def __init__(self, tokenizer: str):
        self.t = common.load_tokenizer(tokenizer)
        self.specials = sorted((v.content for v in self.t.get_added_tokens_decoder().values()),
                               key=len, reverse=True)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.chunks: dict[str, int] = {}
        self.runs = common.Runs()

    def _number(self, name: str) -> int:
        k = self.number.get(name)
        if k is None:
            k = self.number[name] = len(self.names)
            self.names.append(name)
        return k

    def _plain(self, text: str) -> list[int]:
        return [self._number(s) for s, _ in self.t.pre_tokenizer.pre_tokenize_str(text)]

    def whole(self, text: str) -> list[int]:
        """Pre-tokens of a text that may hold special strings; those are pre-tokens too."""
        parts = [text] if text else []
        for special in self.specials:
            parts = [y for x in parts for y in self._cut(x, special)]
        return [k for x in parts for k in ([self._number("\0" + x)] if x in self.specials else self._plain(x))]

    def _cut(self, text: str, special: str) -> list[str]:
        if text in self.specials:
            return [text]
        bits = [y for x in text.split(special) for y in (special, x)][1:]
        return [x for x in bits if x]

    def _chunk(self, chunk: str) -> int:
        """The run of a chunk with its space, or -1 if its text has to be cut as a whole."""
        got = self.chunks.get(chunk)
        if got is None:
            body = chunk.removeprefix(" ")
            odd = not body or body[0].isspace() or body[-1].isspace() or any(s in body for s in self.specials)
            got = self.chunks[chunk] = -1 if odd else self.runs.add(self._plain(chunk))
        return got

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All pre-tokens of the texts as (text's place, number), in no order."""
        if len(self.chunks) > CACHE or len(self.names) > CACHE:
            self.clear()
        texts = pc.fill_null(texts, "")
        chunks, at, offsets = common.coded(pc.split_pattern(texts, " "))
        runs = np.fromiter((self._chunk(" " + c) for c in chunks), np.int64, len(chunks))[at]
        starts = offsets[:-1]
        runs[starts] = [self._chunk(chunks[k]) for k in at[starts]]
        odd = np.flatnonzero(np.minimum.reduceat(runs, starts) < 0)
        place = np.repeat(np.arange(len(texts)), np.diff(offsets))
        plain = ~np.isin(place, odd) if len(odd) else slice(None)
        numbers, lengths = self.runs.take(runs[plain])
        cut = [self.whole(texts[int(i)].as_py()) for i in odd]
        return (np.concatenate([np.repeat(place[plain], lengths), np.repeat(odd, [len(x) for x in cut])]),
                np.concatenate([numbers, np.array([k for x in cut for k in x], np.int64)]))


def pieces(tokenizer, pretoken: str) -> int:
    """Number of ids of one pre-token; the mark of a special string counts as one."""
    if pretoken.startswith("\0"):
        return 1
    return len(tokenizer.model.tokenize(pretoken))


def postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             tokenizer: str = TOKENIZER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block of documents: one row per pre-token with ``cells`` (16 bits of row number, 16
    of frequency), and one row with an empty pre-token that holds the block's ids and bytes
    as an Arrow stream."""
    def run(batches):
        names = common.per_worker(PreTokens, tokenizer)
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        for b, batch in enumerate(x.slice(i, _ROWS) for x in common.blocks(batches, "text", block_bytes)
                                  for i in range(0, x.num_rows, _ROWS)):
            texts = batch.column(1)
            key = (task << 2 * _BITS) + (b << _BITS)
            place, number = names.of(texts)
            flat = number * _ROWS + place
            pairs, counts = np.unique(flat, return_counts=True)
            if len(counts) and counts.max() > _MOST:
                n = -(-counts // _MOST)
                left = counts.repeat(n) - common.ragged(np.zeros(len(n), np.int64), n) * _MOST
                pairs, counts = pairs.repeat(n), np.minimum(left, _MOST)
            token = pairs // _ROWS
            firsts = np.flatnonzero(np.diff(token, prepend=-1))
            runs = np.diff(np.append(firsts, len(token)))
            cells = (((pairs % _ROWS) << 16) | counts).astype("<u4")
            rows = len(firsts)
            yield pa.RecordBatch.from_arrays([
                pa.array([names.names[i] for i in token[firsts]], pa.string()),
                pa.array(np.full(rows, key), pa.int64()), common.binary_runs(cells, runs)], names=_POSTINGS)
            head = pa.RecordBatch.from_arrays(
                [batch.column(0), pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())], names=["doc_id", "n_bytes"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, head.schema) as out:
                out.write_batch(head)
            yield pa.RecordBatch.from_arrays([
                pa.array([""]), pa.array([key], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=_POSTINGS)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "pretoken string, block bigint, cells binary")


_POSTINGS = ["pretoken", "block", "cells"]


def joined_counts(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(block, docs, sums, head) of postings sorted by pre-token within their partitions: a
    row per block holds the pieces of its documents that a task has joined (row numbers and
    sums), or the block's head."""
    def run(batches):
        t = common.load_tokenizer(tokenizer)
        keys, sums, last, last_n = np.empty(0, np.int64), np.empty(0, np.int64), "", 0
        for batch in batches:
            heads = int(pc.sum(pc.equal(batch.column(0), "")).as_py() or 0)  # they come first
            if heads:
                none = pa.array([b""] * heads, pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(1)[:heads], none, none, batch.column(2)[:heads]], names=_PARTS)
            batch = batch.slice(heads)
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            names = coded.dictionary.to_pylist()
            counts = [last_n if s == last else pieces(t, s) for s in names]
            last, last_n = names[-1], counts[-1]
            cells, runs = common.run_values(batch.column(2), "<u4")
            n = np.array(counts, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
            at = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), runs) + (cells >> 16).astype(np.int64)
            keys, sums = _merged(np.concatenate([keys, at]), np.concatenate(
                [sums, (cells & _MOST).astype(np.int64) * np.repeat(n, runs)]))
            if len(keys) > 1_000_000:
                yield _parts(keys, sums)
                keys, sums = keys[:0], sums[:0]
        if len(keys):
            yield _parts(keys, sums)
    return rows.mapInArrow(run, "block bigint, docs binary, sums binary, head binary")


_PARTS = ["block", "docs", "sums", "head"]


def _merged(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(keys, return_inverse=True)
    return u, np.bincount(at, values, len(u)).astype(np.int64)


def _parts(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    block = keys >> _BITS << _BITS
    firsts = np.flatnonzero(np.diff(block, prepend=-1))
    runs = np.diff(np.append(firsts, len(keys)))
    return pa.RecordBatch.from_arrays([
        pa.array(block[firsts]), common.binary_runs((keys - block).astype("<u2"), runs),
        common.binary_runs(sums.astype("<i8"), runs), pa.nulls(len(firsts), pa.binary())], names=_PARTS)


def documents_of(parts: DataFrame, id_type: DataType) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of parts sorted by block within their partitions, the head of
    a block first. A task adds up one block at a time."""
    def run(batches):
        head, total, out = None, None, ["doc_id", "n_bytes", "n_tokens"]

        def finished():
            return pa.RecordBatch.from_arrays([*head.columns, pa.array(total)], names=out)
        for batch in batches:
            for docs, sums, stream in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if stream is not None:
                    if head is not None:
                        yield finished()
                    head = pa.ipc.open_stream(stream).read_next_batch()
                    total = np.zeros(head.num_rows, np.int64)
                else:
                    total[np.frombuffer(docs, "<u2")] += np.frombuffer(sums, "<i8")  # a part has a document once
        if head is not None:
            yield finished()
    return parts.mapInArrow(run, f"doc_id {id_type.simpleString()}, n_bytes bigint, n_tokens bigint")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``."""
    rows = postings(docs, id_col, text_col, tokenizer).repartition("pretoken").sortWithinPartitions("pretoken")
    parts = joined_counts(rows, tokenizer).repartition("block").sortWithinPartitions("block", F.col("head").isNull())
    return documents_of(parts, docs.schema[id_col].dataType)


def with_limit(counts: DataFrame, limit: int = 1024) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
