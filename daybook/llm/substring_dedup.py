"""Substring dedup by recompression.

Words get names from their content. A round of recompression names maximal
runs of one symbol, then pairs of neighbours whose drawn sides fit (left,
right). Names are made of the names they replace, so they are the same in
every document and task without a dictionary. Equal stretches of text get
equal symbols except near their ends: how near is known exactly, because each
symbol carries the range of words that decided it. A window's anchor is the
symbol of least drawn rank among those decided inside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import PrefixHash, PrimeHash, Words, chunks, mix
from daybook.llm.windows import LAST, RangeMin, Scan, Units, covered, mark, no_groups, repeated_windows

WINDOW, ROUNDS, BLOCK = 50, 4, 8


class Symbols:
    """Symbols of several texts after some rounds: ``name``; ``lo`` and ``hi``:
    the range of words that decided it (one beyond the text at its ends)."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, first: np.ndarray):
        n = len(words)
        self.name, self.doc = words, doc
        self.start = np.arange(n)
        self.lo, self.hi = np.arange(n), np.arange(1, n + 1)
        self.edge_lo, self.edge_hi = first[:-1] - 1, first[1:] + 1

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """``lo`` of the symbol before and ``hi`` of the one after."""
        same = self.doc[1:] == self.doc[:-1]
        before, after = self.edge_lo[self.doc], self.edge_hi[self.doc]
        before[1:] = np.where(same, self.lo[:-1], before[1:])
        after[:-1] = np.where(same, self.hi[1:], after[:-1])
        return before, after

    def _keep(self, head: np.ndarray, name: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        self.name, self.lo, self.hi = name, lo, hi
        self.doc, self.start = self.doc[head], self.start[head]

    def runs(self) -> None:
        """Name every maximal run of one symbol."""
        n = len(self.name)
        before, after = self._neighbours()
        head = np.ones(n, dtype=bool)
        head[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        at = np.flatnonzero(head)
        last = np.append(at[1:], n) - 1
        length = (last - at + 1).astype(np.uint64)
        name = np.where(length > 1, mix(self.name[at] + length * np.uint64(0xA0761D6478BD642F)), self.name[at])
        self._keep(at, name, before[at], after[last])

    def pairs(self, salt: int) -> None:
        """Name every pair of a left and a right symbol."""
        n = len(self.name)
        before, after = self._neighbours()
        right = (mix(self.name + np.uint64(salt)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(n, dtype=bool)  # with the next one
        joins[:-1] = ~right[:-1] & right[1:] & (self.doc[:-1] == self.doc[1:])
        tail = np.zeros(n, dtype=bool)
        tail[1:] = joins[:-1]
        at = np.flatnonzero(~tail)
        second = np.minimum(at + 1, n - 1)
        paired = joins[at]
        name = np.where(paired, mix(self.name[at] * np.uint64(0xE7037ED1A0B428DB) + mix(self.name[second] + np.uint64(salt))),
                        self.name[at])
        # a left one alone depends on the next symbol, a right one on the one before
        lo = np.where(~paired & right[at], before[at], self.lo[at])
        hi = np.where(paired, self.hi[second], np.where(right[at], self.hi[at], after[at]))
        self._keep(at, name, lo, hi)


def scan_words(texts: list[bytes], size: int = WINDOW, rounds: int = ROUNDS, block: int = BLOCK) -> Scan:
    """The groups of all windows of ``size`` words of the texts; positions are
    word numbers over all texts."""
    words = Words(texts)
    names = words.hashes()
    n = len(names)
    starts = np.flatnonzero(words.doc[size - 1:] == words.doc[:n - size + 1]) if n >= size else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return Scan(no_groups(), lambda a, b: a.view(np.uint64), lambda a, b: a.view(np.uint64), size, block)
    hashed = PrefixHash(names)
    symbols = Symbols(names, words.doc, words.first)
    for k in range(rounds):
        symbols.runs()
        symbols.pairs(0x589965CC75374CC3 + k)
    lo = np.searchsorted(symbols.lo, starts, side="left")
    hi = np.searchsorted(symbols.hi, starts + size, side="right")
    has = lo < hi
    anchor = np.full(len(starts), -1, dtype=np.int64)
    if has.any():
        anchor[has] = RangeMin(mix(symbols.name), size).of(lo[has], hi[has])
    # windows without such a symbol (inside long runs) are groups of their own
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    chosen = anchor[at]
    lone = chosen < 0
    known = np.where(lone, 0, chosen)
    a, b = np.where(lone, first, symbols.lo[known]), np.where(lone, first + size, symbols.hi[known])
    out = Scan(Units(words.doc[first], first, last, a, hashed.of(a, b), np.zeros(0, dtype=np.uint64)), hashed.of,
               PrimeHash(words.hashes(PrimeHash)).of, size, min(block, size))
    out.groups.s = out.name(out.groups)
    return out


def _cut(size: int, names: list[str], joined: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text: its words joined by one space, or the text
    without the removed words and the white space after them."""
    for batch, texts in chunks(batches):
        words = Words(texts)
        gone = covered(*repeated_windows(batch, texts, lambda t: scan_words(t, size)), size, len(words.start))
        removed = np.bincount(words.doc[gone], minlength=len(texts))
        left = []
        for i, text in enumerate(texts):
            lo, hi = words.first[i], words.first[i + 1]
            if joined:
                own = text.split()
                left.append(b" ".join(w for w, g in zip(own, gone[lo:hi].tolist()) if not g) if removed[i] else b" ".join(own))
            elif removed[i]:
                turn = np.flatnonzero(np.diff(gone[lo:hi].astype(np.int8), prepend=0))
                places = (words.start[lo:hi] - words.offset[i])[turn].tolist()
                bounds = [0, *places, len(text)]
                left.append(b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
            else:
                left.append(text)
        others = [batch.column(batch.schema.get_field_index(n)) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*others, pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.binary())],
            names=[*names, "n_words", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW,
                   joined: bool = True, others: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``size`` words that also
    occurs in a document with a smaller id; windows are judged on the input.

    Returns ``id, n_words, n_removed, kept`` (binary): the kept words joined by
    one space or, not ``joined``, the text without the removed words, its white
    space as it was. With ``others`` the columns of ``docs`` instead of ``id``,
    prefixed ``c0, c1, ...`` in their order, but for the text, of which only
    whether it is not null is carried: each text travels once.

    Null texts have no words. Null ids come after all others; rows of the
    same id don't see each other, and each row is judged. An empty table gives
    an empty result.
    """
    names = docs.columns
    at = names.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    number = plain[f"c{names.index(id_col)}"].cast("long")
    text = plain[f"c{at}"]
    if others:
        carried = [text.isNotNull().alias(c) if c == f"c{at}" else plain[c] for c in plain.columns]
    else:
        carried = [number.alias("id")]
    rows = plain.select(F.coalesce(number, F.lit(LAST)).alias("doc"), F.coalesce(text, F.lit("")).cast("binary").alias("data"), *carried)
    kept = rows.columns[2:]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema.fields)
    marked = mark(rows, scan_words if size == WINDOW else lambda t: scan_words(t, size), earlier=True)
    return marked.mapInArrow(lambda it: _cut(size, kept, joined, it), f"{kinds}, n_words long, n_removed long, kept binary")


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with the repeats taken out of the text; a column ``n_chars``
    gets the new length. Rows without repeats stay as they are (a null text
    too); no row is dropped."""
    names = docs.columns
    out = remove_repeats(docs, id_col, text_col, size, joined=False, others=True)
    at = names.index(text_col)
    cols = []
    for i, name in enumerate(names):
        col = F.col(f"c{i}")
        if i == at:
            col = F.when(col, F.col("kept").cast("string"))
        elif name == "n_chars" and docs.schema[name].dataType.simpleString() in ("bigint", "int"):
            col = F.when(F.col("n_removed") > 0, F.char_length(F.col("kept").cast("string"))).otherwise(col).cast(docs.schema[name].dataType)
        cols.append(col.alias(name))
    return out.select(*cols)
