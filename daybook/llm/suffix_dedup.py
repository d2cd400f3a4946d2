"""Substring dedup over bytes by grouping on anchors and content hashes.

Every window of ``size`` bytes chooses a place inside it, its anchor, by its
content alone (the 32-byte gram of least hash). Windows of one anchor are a
group, and Spark's grouping by the names of groups, blocks and windows
(``windows.py``) decides which repeat. A suffix sort checks the names inside
one round of texts and produces no row: stretches that share a name are
mergesorted (binary search through prefix polynomial hashes finds the common
extension, the byte after it decides) and equal neighbours are compared byte
by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import PrefixHash, PrimeHash, byte_values, chunks, mix
from daybook.llm.windows import LAST, Scan, Units, covered, mark, no_groups, repeated_windows

WINDOW, GRAM, BLOCK = 200, 32, 16


class Suffixes:
    """Comparison of suffixes of ``buf``, each up to its own end. ``head`` holds
    the next eight bytes of every place as a number, which orders most pairs."""

    def __init__(self, buf: np.ndarray, hashed: PrefixHash):
        self.buf, self.hashed = buf, hashed
        long = np.concatenate([buf, np.zeros(8, dtype=np.uint8)])
        self.head = np.zeros(len(buf), dtype=np.uint64)
        for k in range(8):
            self.head = self.head << np.uint64(8) | long[k:k + len(buf)]

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of places ``a`` and ``b``, at most
        ``most``."""
        out = most.copy()
        # most pairs that come here agree as far as they go
        at = np.flatnonzero(self.hashed.of(a, a + most) != self.hashed.of(b, b + most))
        a, b = a[at], b[at]
        low, high = np.zeros(len(at), dtype=np.int64), most[at] - 1  # the answer lies in [low, high]
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashed.of(a, a + mid) == self.hashed.of(b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        out[at] = low
        return out

    def before(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, ties: bool) -> np.ndarray:
        """Whether the suffix at ``a`` sorts before that at ``b``; equal ones
        give ``ties``."""
        x, y = self.head[a], self.head[b]
        out = x < y
        # equal heads, and suffixes that end inside them, need their common extension
        at = np.flatnonzero((x == y) | (np.minimum(a_end - a, b_end - b) < 8))
        if not len(at):
            return out
        a, b, a_end, b_end = a[at], b[at], a_end[at], b_end[at]
        most = np.minimum(a_end - a, b_end - b)
        n = self.common(a, b, most)
        inside = n < most
        last = len(self.buf) - 1
        x = self.buf[np.minimum(a + n, last)]
        y = self.buf[np.minimum(b + n, last)]
        la, lb = a_end - a, b_end - b
        out[at] = np.where(inside, x < y, np.where(la != lb, la < lb, ties))
        return out

    def sort(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Indexes of the suffixes ``[start, end)`` in sorted order, by
        mergesort. All merges of one level go together: each element's place
        in the other run is found by binary search."""
        n = len(start)
        order = np.arange(n)
        width = 1
        while width < n:
            at = np.arange(n)
            run = at // width
            other = run ^ 1
            lo = np.minimum(other * width, n)
            top = np.minimum(lo + width, n)
            first = lo.copy()
            hi = top.copy()
            left = (run & 1) == 0  # of equal elements those of the left run come first
            while (lo < hi).any():
                open_ = np.flatnonzero(lo < hi)
                mid = (lo[open_] + hi[open_]) // 2
                mine, theirs = order[at[open_]], order[mid]
                # a left element goes after the other run's smaller ones, a right one after equal ones too
                is_left = left[open_]
                x, y = np.where(is_left, theirs, mine), np.where(is_left, mine, theirs)
                goes = self.before(start[x], end[x], start[y], end[y], False) == is_left
                lo[open_] = np.where(goes, mid + 1, lo[open_])
                hi[open_] = np.where(goes, hi[open_], mid)
            place = (run // 2) * 2 * width + (at - run * width) + (lo - first)
            merged = np.empty_like(order)
            merged[place] = order
            order, width = merged, width * 2
        return order


def _verify(buf: np.ndarray, hashed: PrefixHash, start: np.ndarray, end: np.ndarray, name: np.ndarray) -> None:
    """Stretches that share a name must be the same bytes: those that repeat a
    name are suffix-sorted and neighbours are compared byte by byte. A
    collision of two 64-bit names ends the job rather than a wrong result."""
    order = np.argsort(name, kind="stable")
    twin = name[order[1:]] == name[order[:-1]]
    repeated = np.zeros(len(name), dtype=bool)
    repeated[order[1:][twin]] = True
    repeated[order[:-1][twin]] = True
    at = np.flatnonzero(repeated)
    if not len(at):
        return
    at = at[Suffixes(buf, hashed).sort(start[at], end[at])]
    a, b = at[:-1], at[1:]
    same = np.flatnonzero(name[a] == name[b])
    if len(np.unique(name[at])) != len(at) - len(same):
        raise ValueError("stretches of one name are not neighbours in suffix order: a hash collision")
    for x, y in zip(a[same].tolist(), b[same].tolist()):
        if not np.array_equal(buf[start[x]:end[x]], buf[start[y]:end[y]]):
            raise ValueError("different stretches share a name: a hash collision")


def scan_bytes(texts: list[bytes], size: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> Scan:
    """The groups of all windows of ``size`` bytes of the texts; positions are
    places in the texts joined by one byte."""
    buf = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    offset = np.concatenate([[0], np.cumsum(lengths + 1)])
    n = len(buf)
    if not len(texts) or lengths.max() < size:
        return Scan(no_groups(), lambda a, b: a.view(np.uint64), lambda a, b: a.view(np.uint64), size, block)
    hashed = PrefixHash(byte_values(buf))
    # the least drawn rank of a gram in the window; the first of equal ones
    bits = max(24, int(n).bit_length())
    places = np.arange(n - gram + 1)
    low = mix(hashed.of(places, places + gram)) >> np.uint64(bits) << np.uint64(bits) | places.astype(np.uint64)
    span, step = size - gram + 1, 1
    while 2 * step <= span:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    rest = span - step
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    anchor = (low & np.uint64((1 << bits) - 1)).astype(np.int64)  # of the window at each place
    doc = np.repeat(np.arange(len(texts)), lengths + 1)
    m = len(anchor)
    whole = np.arange(m) + size <= (offset[1:] - 1)[doc[:m]]
    new = np.ones(m, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    ends = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True))
    chosen = anchor[first]
    groups = Units(doc[first], first, ends, chosen, hashed.of(chosen, chosen + gram), np.zeros(0, dtype=np.uint64))
    out = Scan(groups, hashed.of, PrimeHash(byte_values(buf)).of, size, min(block, size))
    groups.s = out.name(groups)
    out.verify = lambda: _verify(buf, hashed, first, ends + size, groups.s)
    return out


def _cut(size: int, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        offset = np.concatenate([[0], np.cumsum(lengths + 1)])
        gone = covered(*repeated_windows(batch, texts, lambda t: scan_bytes(t, size)), size, int(offset[-1]))
        turn = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        # a window never crosses a text's end, so runs lie inside texts
        begin, end = turn[::2], turn[1::2]
        owner = np.searchsorted(offset, begin, side="right") - 1
        spans = np.bincount(owner, minlength=len(texts))
        removed = np.bincount(owner, weights=end - begin, minlength=len(texts)).astype(np.int64)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        kept = []
        for i, text in enumerate(texts):
            if not spans[i]:
                kept.append(text)
                continue
            own = slice(bounds[i], bounds[i + 1])
            a, b = (begin[own] - offset[i]).tolist(), (end[own] - offset[i]).tolist()
            kept.append(b"".join(text[x:y] for x, y in zip([0, *b], [*a, len(text)])))
        others = [batch.column(batch.schema.get_field_index(x)) for x in names]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(kept, pa.binary())], names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Remove every byte covered by a string of ``size`` bytes that also
    starts anywhere else in the corpus, the same document included. Returns
    ``id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    Null texts are empty. Null ids are kept; each row is a document, so a row
    that repeats loses everything that is long enough. An empty table gives an
    empty result. What remains need not be valid UTF-8, so it is binary.
    """
    number = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(number, F.lit(LAST)).alias("doc"), text.alias("data"), number.alias("id"))
    scan = scan_bytes if size == WINDOW else lambda t: scan_bytes(t, size, min(GRAM, size))
    return mark(rows, scan, earlier=False).mapInArrow(
        lambda it: _cut(size, ["id"], it), "id long, n_bytes long, n_removed long, n_spans long, kept binary")
