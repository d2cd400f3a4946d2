"""Quality rules by compression bands.

A document passes when it fails none of the base rules (too few words, too
much of it repeated) and its zstandard ratios lie in the bands of its length:
the ratio of the whole text, and the ratios of its chunks, which hold every
byte: fixed ones and the rest after them. A low ratio is repetitive text, a
high one is incompressible (random characters, encoded data).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import PrimeHash, Words, chunks, id_and_text, mix

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
SCHEMA = ("id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "ratio double, chunk_low double, chunk_high double, base_failed boolean, kept boolean")


@dataclass(frozen=True)
class Bands:
    """``whole``: (bytes at least, lowest, highest ratio of the whole text),
    by length, rising. Short texts compress badly whatever they hold (the
    frame alone is a dozen bytes), so their upper limits are wide. Below 128
    bytes no text reaches the upper limit (at 64 bytes noise and prose both
    have ratios up to 1.14), so only the lowest ratio and the base rules judge.
    ``chunk``: size of the fixed chunks; ``chunk_limits``: lowest and highest
    ratio of one. What is left after the last full chunk (all of a shorter
    text) is a chunk too, whose limits are the wider ones of ``chunk_limits``
    and of ``whole`` at its own length. ``bad_share``: rejected when chunks
    outside hold more than this share of the bytes."""
    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 99.0), (64, 0.35, 1.30), (128, 0.34, 1.02), (256, 0.32, 0.86), (512, 0.30, 0.76),
        (1024, 0.28, 0.69), (2048, 0.26, 0.65), (4096, 0.24, 0.63), (16384, 0.20, 0.62))
    chunk: int = 4096
    chunk_limits: tuple[float, float] = (0.20, 0.66)
    bad_share: float = 0.25
    min_words: int = 10
    max_repeat_percent: int = 20


def _repeated_words(words: Words, size: int = 5) -> np.ndarray:
    """Per text: words inside a window of ``size`` words that occurs twice or
    more in the same text."""
    n = len(words.start)
    out = np.zeros(len(words.counts), dtype=np.int64)
    if n < size:
        return out
    h = words.hashes(PrimeHash)  # one hash decides: modulo a prime, so that no word pattern defeats it
    same = words.doc[size - 1:] == words.doc[: n - size + 1]
    at = np.flatnonzero(same)
    window = words.doc[at].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(size):
        window = mix(window + h[at + k])
    order = np.sort(window)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    hit = at[twice[place] == window]
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.doc[covered], minlength=len(words.counts))


def _measure(bands: Bands, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=bands.level).compress
    starts = np.array([b[0] for b in bands.whole])

    def of_length(size: int) -> tuple[int, float, float]:
        return bands.whole[int(np.searchsorted(starts, size, side="right")) - 1]

    def outside(size: int, part: float) -> bool:
        least, most = bands.chunk_limits
        if size < bands.chunk:
            _, low, high = of_length(size)
            least, most = min(least, low), max(most, high)
        return not least <= part <= most

    for batch, texts in chunks(batches):
        words = Words(texts)
        begins = words.buf & 0xC0 != 0x80  # a code point starts here
        inside = np.cumsum(np.concatenate([[0], begins]))
        chars = inside[words.end] - inside[words.start]
        n_words = words.counts
        word_chars = np.bincount(words.doc, weights=chars, minlength=len(texts)).astype(np.int64)
        repeats = _repeated_words(words)
        symbols, lines, ratio, low, high, fits = [], [], [], [], [], []
        for text in texts:
            symbols.append(len(_SYMBOLS.findall(text)))
            with_word = [x for x in text.split(b"\n") if x.strip()]
            lines.append(len(with_word) - len(set(with_word)))
            size = len(text)
            r = len(pack(text)) / size if size else None
            # a text of one chunk or less is its own chunk
            pieces = [text[i:i + bands.chunk] for i in range(0, size, bands.chunk)]
            parts = [len(pack(x)) / len(x) for x in pieces] if size > bands.chunk else [r] * len(pieces)
            ratio.append(r)
            low.append(min(parts, default=None))
            high.append(max(parts, default=None))
            _, least, most = of_length(size)
            bad = sum(len(x) for x, p in zip(pieces, parts) if outside(len(x), p))
            fits.append(r is None or (least <= r <= most and bad <= bands.bad_share * size))
        failed = (n_words < bands.min_words) | (100 * repeats > bands.max_repeat_percent * n_words)
        kept = ~failed & np.array(fits, dtype=bool)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(word_chars, pa.int64()),
             pa.array(symbols, pa.int64()), pa.array(lines, pa.int64()), pa.array(repeats, pa.int64()),
             pa.array(ratio, pa.float64()), pa.array(low, pa.float64()), pa.array(high, pa.float64()),
             pa.array(failed), pa.array(kept)],
            names=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   "ratio", "chunk_low", "chunk_high", "base_failed", "kept"])


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  bands: Bands = Bands()) -> DataFrame:
    """One row per input row: its counts, compression ratios and verdict.

    One pass, no shuffle. Null text counts as empty: no words, so it fails the
    base rules. A null id stays null; repeated rows are judged one by one; an
    empty table gives an empty result. Memory follows the longest single text.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(lambda it: _measure(bands, it), SCHEMA)


def keep_quality(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. Only the text
    goes to Python and one flag comes back, so no join is needed and repeated
    or null ids do not matter."""
    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for data in columns:
            rows = pa.RecordBatch.from_arrays([pa.nulls(len(data), pa.int64()), data], names=["id", "data"])
            flags = [x.column(10) for x in _measure(bands, iter([rows]))]
            yield pa.concat_arrays(flags) if flags else pa.array([], pa.bool_())

    # typing is by the hints, which must be names of this module
    judge.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    passes = F.arrow_udf(judge, "boolean")
    text = docs[docs.columns.index(text_col)]
    return docs.filter(passes(F.coalesce(text, F.lit("")).cast("binary")))
