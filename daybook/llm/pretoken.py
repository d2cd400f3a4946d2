"""Splitting texts into pre-token pieces with array operations, and encoding
them through a bounded table of pieces already seen.

The pattern is that of the public byte-level BPE tokenizers
(``public_tokenizers.PATTERN``): contractions, then runs of letters, digits
or other characters with one leading space, then white space. Every piece is
encoded by itself, so the ids of a piece can be reused wherever it occurs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex

from daybook.llm.common import PrefixHash, PrimeHash, mix

OTHER, LETTER, NUMBER, BLANK, EDGE = range(5)
_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    """Class of every code point; the one past the last marks a text's edge."""
    global _classes
    if _classes is None:
        points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
        every = "".join(points)
        table = np.zeros(0x110001, dtype=np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
            for m in regex.finditer(pattern, every):
                at = np.fromiter(map(ord, m.group()), dtype=np.int64)
                table[at] = kind
        table[0x110000] = EDGE
        _classes = table
    return _classes


class Pieces:
    """The pieces of several texts: ``start``/``end`` (places in ``points``,
    the texts' code points with an edge mark after each), ``first`` (index of
    each text's first piece, total at the end), ``key`` and ``check`` (64-bit
    hashes independent of each other)."""

    def __init__(self, texts: list[str]):
        edge = np.uint32(0x110000)
        parts: list[np.ndarray] = []
        mark = np.array([edge], dtype=np.uint32)
        for t in texts:
            parts += [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), mark]
        self.points = p = np.concatenate([mark, *parts]) if parts else mark
        n = len(p)
        kind = _class_table()[p]
        new = np.empty(n, dtype=bool)  # a run of one class starts here
        new[0], new[1:] = True, kind[1:] != kind[:-1]
        space = p == 0x20
        blank = kind == BLANK
        start = new & (kind != EDGE)
        # the last blank of a run before something else stands alone or joins it
        followed = np.zeros(n, dtype=bool)
        followed[:-1] = blank[:-1] & (kind[1:] != BLANK) & (kind[1:] != EDGE)
        start |= followed
        joined = np.zeros(n, dtype=bool)  # takes the space before it
        joined[1:] = followed[:-1] & space[:-1]
        start &= ~joined
        self._contractions(p, kind, new, joined, start)
        at = np.flatnonzero(start | (kind == EDGE))
        real = kind[at] != EDGE
        self.start = at[real]
        self.end = np.append(at[1:], n)[real]
        edges = np.flatnonzero(kind == EDGE)
        self.first = np.searchsorted(self.start, edges)
        self.key = self.check = np.zeros(0, dtype=np.uint64)
        if n > 1:
            drawn = mix(p.astype(np.uint64) + np.uint64(1))
            self.key = PrefixHash(drawn).of(self.start, self.end)
            self.check = PrimeHash(drawn).of(self.start, self.end)

    @staticmethod
    def _contractions(p, kind, new, joined, start) -> None:
        """An apostrophe that begins a piece and is followed by one of the
        endings makes a piece with it; the letters left begin another."""
        at = np.flatnonzero((p == 0x27) & new & ~joined)
        at = at[at + 1 < len(p)]
        if not len(at):
            return
        after = p[at + 1]
        second = p[np.minimum(at + 2, len(p) - 1)]
        one = np.isin(after, [ord(c) for c in "stmd"])
        two = np.zeros(len(at), dtype=bool)
        for pair in ("re", "ve", "ll"):
            two |= (after == ord(pair[0])) & (second == ord(pair[1]))
        size = np.where(one, 1, np.where(two, 2, 0))
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        rest = at + size + 1
        inner = rest < len(p)
        rest = rest[inner]
        start[rest[kind[rest] == LETTER]] = True

    def text(self, i: int) -> str:
        return self.points[self.start[i]:self.end[i]].tobytes().decode("utf-32-le", "surrogatepass")


class PieceTable:
    """Ids of pieces seen before, by key and check, in two-place buckets of a
    table of fixed size; with more pieces than that the oldest entries of a
    bucket are encoded again when they come back. ``encode`` turns a list of
    pieces into their ids."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], bits: int = 21, ids: int = 8 << 20):
        self.encode = encode
        self.mask = np.uint64((1 << bits) - 1)
        self.limit = ids
        self.clear()

    def clear(self) -> None:
        size = int(self.mask) + 1
        self.keys = np.zeros((2, size), dtype=np.uint64)
        self.checks = np.zeros((2, size), dtype=np.uint64)
        self.place = np.zeros((2, size), dtype=np.int32)
        self.count = np.zeros((2, size), dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def _add(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode(texts)
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        total = int(count.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), dtype=np.uint32)])
        place = self.used + np.concatenate([[0], np.cumsum(count)])[:-1]
        self.flat[self.used:self.used + total] = np.fromiter((i for x in found for i in x), np.uint32, total)
        self.used += total
        return place, count

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each has."""
        if self.used > self.limit:
            self.clear()
        pieces = Pieces(texts)
        key = pieces.key
        n = len(key)
        if not n:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(texts), dtype=np.int64)
        slot = (key & self.mask).astype(np.int64)
        one, two = ((self.keys[w][slot] == key) & (self.checks[w][slot] == pieces.check) for w in (0, 1))
        way = np.where(one, 0, np.where(two, 1, -1))
        place, count = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for w in (0, 1):
            hit = way == w
            place[hit], count[hit] = self.place[w][slot[hit]], self.count[w][slot[hit]]
        miss = np.flatnonzero(way < 0)
        if len(miss):
            order = np.lexsort((pieces.check[miss], key[miss]))
            k, x = key[miss][order], pieces.check[miss][order]
            new = np.ones(len(k), dtype=bool)
            new[1:] = (k[1:] != k[:-1]) | (x[1:] != x[:-1])
            first = order[new]
            back = np.empty(len(k), dtype=np.int64)
            back[order] = np.cumsum(new) - 1
            p, c = self._add([pieces.text(i) for i in miss[first].tolist()])
            place[miss], count[miss] = p[back], c[back]
            s = (k[new] & self.mask).astype(np.int64)
            tables = ((self.keys, k[new]), (self.checks, x[new]), (self.place, p), (self.count, c))
            for a, _ in tables:  # the older entry moves to the second place
                a[1][s] = a[0][s]
            # of new pieces of one bucket the last stays, in all tables alike
            s, last = np.unique(s[::-1], return_index=True)
            for a, values in tables:
                a[0][s] = values[::-1][last]
        ends = np.cumsum(count)
        at = np.repeat(place - (ends - count), count) + np.arange(int(ends[-1]))
        bounds = np.concatenate([[0], ends])[pieces.first]
        return self.flat[at], np.diff(bounds)


def byte_alphabet() -> dict[int, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones for themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


class WithAdded:
    """A piece table for texts in which added tokens (such as an end mark)
    stand as they are: they get their own ids, what lies between is encoded."""

    def __init__(self, table: PieceTable, added: dict[str, int]):
        self.table, self.added = table, added
        # of tokens that begin alike the longest
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")").split

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each has."""
        parts = [self.split(t) if any(a in t for a in self.added) else [t] for t in texts]
        flat, counts = self.table.ids([x for p in parts for x in p[::2]])
        if all(len(p) == 1 for p in parts):
            return flat, counts
        out, sizes, at, k = [], [], 0, 0
        for p in parts:
            size = 0
            for i, x in enumerate(p):
                if i % 2:
                    own = np.array([self.added[x]], dtype=flat.dtype)
                else:
                    own = flat[at:at + counts[k]]
                    at, k = at + counts[k], k + 1
                out.append(own)
                size += len(own)
            sizes.append(size)
        return np.concatenate(out), np.array(sizes, dtype=np.int64)


_tables: dict[tuple, WithAdded | PieceTable] = {}


def library_table(path: str) -> PieceTable | WithAdded:
    """Pieces encoded by the BPE model of the ``tokenizers`` library with the
    file ``path``; one table per Python worker. Added tokens that a text holds
    get their ids, as in the library."""
    if (path,) not in _tables:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        model = tokenizer.model
        letters = byte_alphabet()

        def encode(pieces: list[str]) -> list[list[int]]:
            return [[t.id for t in model.tokenize(p.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters))]
                    for p in pieces]

        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take white space or whole words are not supported")
        table = PieceTable(encode)
        _tables[(path,)] = WithAdded(table, {t.content: i for i, t in added.items()}) if added else table
    return _tables[(path,)]
