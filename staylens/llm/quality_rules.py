"""Quality rules by compression bands.

The zstandard ratio (bytes / compressed bytes) of a whole text and of its fixed chunks has
to lie in a band. The band depends on the length, since short texts compress less. A ratio
above the band means repetition, one below means incompressible junk. Base counts of words,
symbols, repeated lines and repeated 5-word windows are taken on the way and fail first.

Chunks have the largest of the sizes of ``chunks`` that goes into the text twice, with limits
of that size; the last chunk is the text's last bytes of that size, so it may overlap the one
before and every byte is judged. Under twice the smallest size the whole is the only chunk. Under
64 bytes the compressor stores what it can't shorten, so there is a limit on repetition only.

One narrow pass over the rows, no shuffle; a task holds a few MB of text at a time.

Cases: a null or empty text has no words and fails the base; ties and repeated rows are
independent rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm import common

_SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Bands:
    """(bytes from, lowest ratio, highest ratio) in ascending order; the last row whose bytes are
    reached holds. ``whole`` is for texts; ``chunks`` for chunks of just so many bytes, of which at
    most the share ``bad_chunks`` of a text's may lie outside."""
    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 0.9), (16, 0.0, 1.0), (32, 0.0, 1.25), (64, 0.6, 2.6), (128, 0.9, 3.0), (256, 1.1, 3.5),
        (512, 1.2, 4.0), (1024, 1.35, 4.5), (2048, 1.4, 5.0), (8192, 1.4, 6.0))
    chunks: tuple[tuple[int, float, float], ...] = (
        (128, 0.95, 3.0), (256, 1.08, 3.5), (512, 1.2, 4.0), (1024, 1.3, 4.5), (2048, 1.35, 5.0))
    bad_chunks: float = 0.25
    level: int = 3


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    width = len(number)
    if width ** window < 1 << 62:
        keys = ids[:n].copy()
        for k in range(1, window):
            keys = keys * width + ids[k:k + n]
    else:  # number the windows of growing length anew, so that no key overflows
        keys = ids
        for k in range(1, window):
            keys = np.unique(keys[:len(ids) - k] * width + ids[k:], return_inverse=True)[1]
    _, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[at] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()  # splits at exactly x20 and x09 to x0d
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    dup = 0
    if "\n" in text:
        lines = [x for x in text.split("\n") if x.strip(_SPACES)]
        dup = len(lines) - len(set(lines))
    return len(words), chars, symbols, dup, repeat_words(words)


def band_verdict(data: bytes, compress, bands: Bands) -> tuple[float, int, int, bool]:
    """Ratio of the whole, chunks, chunks out of their band, and the verdict."""
    if not data:
        return 0.0, 0, 0, False
    ratio = len(data) / len(compress(data))
    _, low, high = [b for b in bands.whole if len(data) >= b[0]][-1]
    bad, starts = 0, []
    for size, chunk_low, chunk_high in [b for b in bands.chunks if len(data) >= 2 * b[0]][-1:]:
        starts = [*range(0, len(data) - size, size), len(data) - size]
        for i in starts:
            bad += not chunk_low <= size / len(compress(data[i:i + size])) <= chunk_high
    return ratio, len(starts), bad, low <= ratio <= high and bad <= bands.bad_chunks * len(starts)


_INTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            bands: Bands = Bands()) -> DataFrame:
    """Base counts, compression ratio, chunks outside their band and the two verdicts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import zstandard
        compress = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in common.blocks(batches, "text"):
            texts = common.texts_of(batch, "text")
            base = np.array([base_counts(t) for t in texts], np.int64)
            ratios = [band_verdict(t.encode("utf-8", "surrogatepass"), compress, bands) for t in texts]
            failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
            ok = np.array([r[3] for r in ratios], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(base[:, k]) for k in range(5)), pa.array(failed),
                 pa.array(ok & ~failed), pa.array([r[0] for r in ratios], pa.float64()),
                 *(pa.array([r[k] for r in ratios], pa.int64()) for k in (1, 2))],
                names=["doc_id", *_INTS, "base_failed", "kept", "ratio", "n_chunks", "n_bad_chunks"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in _INTS) +
        ", base_failed boolean, kept boolean, ratio double, n_chunks bigint, n_bad_chunks bigint")
