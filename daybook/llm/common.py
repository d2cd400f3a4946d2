"""Helpers shared by the training-data operators: reading tables, the shared
scratch folder, cutting Arrow batches to a byte budget, and vectorised word
boundaries and hashes over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path

#: Text bytes handled by one round of array operations (a longer single text
#: is handled alone).
CHUNK_BYTES = 512 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs neither
    recompute it nor depend on the executor that made it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id`` (long) and ``data`` (UTF-8 bytes; null text = empty).
    Other columns are dropped here, so their names never clash."""
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))


def chunks(batches: Iterator[pa.RecordBatch], column_name: str = "data",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts hold about ``limit`` bytes, each with
    its texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(column_name))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):  # only the texts of a slice are copied
            before = int(ends[at] - sizes[at])
            end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, end - at), column.slice(at, end - at).to_pylist()
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective) over uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the polynomial base (or of its inverse)
    modulo 2**64."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), _BASE if kind == "base" else _INVERSE, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 16 * CHUNK_BYTES:
            _powers[kind] = have
    return have[:n]


class PrefixHash:
    """Prefix polynomial hashes of an array of symbols; ``of(s, e)`` gives
    hashes of the slices ``[s, e)`` that depend on their content alone."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * powers("base", n), out=self.sums[1:], dtype=np.uint64)
        self.inverse = powers("inverse", n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + length)


_PRIME = (1 << 31) - 1
_PRIME_BASES = (0x2545F491, 0x5851F42D)


def _prime_powers(base: int, kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo the prime."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        have = np.ones(1, dtype=np.uint64)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), _PRIME)) % np.uint64(_PRIME)])
        if n <= 16 * CHUNK_BYTES:
            _powers[kind] = have
    return have[:n]


class PrimeHash:
    """As ``PrefixHash``, independent of it: two polynomials modulo a prime of
    31 bits, over different bits of the symbols."""

    def __init__(self, symbols: np.ndarray):
        n, prime, bits = len(symbols), np.uint64(_PRIME), np.uint64(31)
        self.parts = []
        for k, base in enumerate(_PRIME_BASES):
            x = (symbols >> np.uint64(31 * k) & prime) * _prime_powers(base, f"prime {k}", n)
            sums = np.zeros(n + 1, dtype=np.uint64)  # exact: terms are below 2**32
            np.cumsum((x & prime) + (x >> bits), out=sums[1:], dtype=np.uint64)
            self.parts.append((sums, _prime_powers(pow(base, -1, _PRIME), f"prime inverse {k}", n + 1)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        prime = np.uint64(_PRIME)
        low, high = ((sums[end] - sums[start]) % prime * inverse[start] % prime for sums, inverse in self.parts)
        return mix((low | high << np.uint64(31)) + mix((end - start).astype(np.uint64)))


#: White space of the contracts' word pattern.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


class Words:
    """The words of several texts as arrays: ``start`` and ``end`` (places in
    ``buf``, the texts joined by one space), ``doc`` (index of the text),
    ``first`` (index of each text's first word, with the total at the end)
    and ``offset`` (where each text starts in ``buf``)."""

    def __init__(self, texts: list[bytes]):
        self.joined = b" ".join(texts) + b" "
        self.buf = np.frombuffer(self.joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.offset = np.concatenate([[0], np.cumsum(lengths + 1)])
        space = SPACE[self.buf]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(~before & space)
        self.first = np.searchsorted(self.start, self.offset)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, kind: type[PrefixHash | PrimeHash] = PrefixHash) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        return kind(_BYTE_VALUES[self.buf]).of(self.start, self.end)


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[buf]
