"""Phrase collocations mined with weighted acyclic automata.

A *transducer* here reads a phrase word by word and gives its count: states
are prefixes, sorted so that the states after one prefix lie together, and
every state has a weight. It is kept as columns (``a``, ``b``, ``c``: the words
of a state as places in its own sorted dictionary, 0 for none) and travels as
its states in preorder, each with its depth, last word and weight.

1. Every task builds transducers of the n-grams of its texts, one per language
   and million words, from their sorted n-grams, and cuts them at bounds
   that all tasks share.
2. For each range of phrases the pieces are joined and their weights summed.
   Phrases that are frequent enough remain. A range asks for the counts of the
   parts of its candidates with one request transducer per group of ranges:
   each part once, however many candidates have it, with the largest count of
   a longer candidate that contains it.
3. Requests are composed with the counts of the ranges they go to: the answers
   are counts, and a phrase that is asked for with too large a weight is dropped.
4. Each range scores its candidates from the answers.

No phrase has more than one row per task in the shuffle, so common words and
pairs don't gather rows; the pieces of a range are joined as they arrive.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import written

#: Words of one shard (ids of so many words fit in 21 bits) and bytes of texts
#: gathered for it.
SHARD_WORDS, SHARD_BYTES = 1_000_000, 6 << 20
#: Text bytes of a range, ranges at most, and ranges whose counts are asked together.
RANGE_BYTES, MOST_RANGES, GROUP = 8 << 20, 200_000, 16
#: Texts, and characters of each, from which the bounds of ranges are chosen
#: (they only balance the work).
SAMPLE_ROWS, SAMPLE_CHARS = 2_000, 4_000
#: Pieces of a range are joined when so many states are waiting.
JOIN_STATES = 1_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPLIT, _GAP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_SPLIT[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP[list(b" \t")] = True


@dataclass
class Transducer:
    """``words``: sorted distinct words; ``a``, ``b``, ``c``: of each state its
    words as places in ``words`` plus 1 (0: none), in order; ``weight``."""
    words: pa.Array
    a: np.ndarray
    b: np.ndarray
    c: np.ndarray
    weight: np.ndarray

    def __len__(self) -> int:
        return len(self.weight)

    @property
    def depth(self) -> np.ndarray:
        return 1 + (self.b > 0) + (self.c > 0)

    def take(self, at) -> Transducer:
        return Transducer(self.words, self.a[at], self.b[at], self.c[at], self.weight[at])

    def pair(self) -> np.ndarray:
        return self.a.astype(np.int64) << 32 | self.b

    def phrases(self) -> list[bytes]:
        words = [b"", *(w.as_py() for w in self.words)]
        return [b" ".join(words[i] for i in (x, y, z) if i) for x, y, z in zip(self.a.tolist(), self.b.tolist(), self.c.tolist())]

    def place(self, bound: tuple[bytes, ...]) -> int:
        """Place of the first state that is not before the phrase ``bound``."""
        lo, hi = 0, len(self)
        for column, word in zip((self.a, self.b, self.c), bound):
            i = bisect_left(self.words, word, key=lambda x: x.as_py())
            known = i < len(self.words) and self.words[i].as_py() == word
            start = lo + int(np.searchsorted(column[lo:hi], i + 1, "left"))
            if not known:
                return start
            lo, hi = start, lo + int(np.searchsorted(column[lo:hi], i + 1, "right"))
        return lo

    def encode(self) -> bytes:
        """States in preorder, after those above the first; only own words."""
        a, b, c, weight = self.a, self.b, self.c, self.weight
        above = []
        if len(a):  # every state above another one is there, before it
            pair = self.pair()
            for column, new in ((a, np.diff(a, prepend=-1) != 0), (pair, np.diff(pair, prepend=-1) != 0)):
                at = np.flatnonzero(new)
                lower = (b[at] > 0) if column is a else (c[at] > 0)
                at = at[lower]
                above.append((a[at], np.zeros_like(a[at]) if column is a else b[at], np.zeros_like(a[at])))
            extra = [np.concatenate([x[k] for x in above]) for k in range(3)]
            order = np.lexsort((np.concatenate([extra[2], c]), np.concatenate([extra[1], b]), np.concatenate([extra[0], a])))
            weight = np.concatenate([np.zeros(len(extra[0]), dtype=weight.dtype), weight])[order]
            a, b, c = (np.concatenate([x, y])[order] for x, y in zip(extra, (a, b, c)))
        label = np.where(c > 0, c, np.where(b > 0, b, a))
        used, label = np.unique(label, return_inverse=True)
        words = self.words.take(pa.array(used - 1))
        lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
        kind = np.uint32 if not len(weight) or int(weight.max()) < 1 << 32 else np.int64
        head = np.array([len(used), len(a), np.dtype(kind).itemsize], dtype=np.int64)
        depth = (1 + (b > 0) + (c > 0)).astype(np.uint8)
        return zstandard.ZstdCompressor(level=1).compress(b"".join(
            [head.tobytes(), lengths.tobytes(), depth.tobytes(), label.astype(np.uint32).tobytes(),
             weight.astype(kind).tobytes(), *(w.as_py() for w in words)]))


def decode(blob: bytes) -> Transducer:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n_words, n, width = np.frombuffer(data, np.int64, 3).tolist()
    at = 24
    lengths = np.frombuffer(data, np.int32, n_words, at)
    at += 4 * n_words
    depth = np.frombuffer(data, np.uint8, n, at)
    at += n
    label = np.frombuffer(data, np.uint32, n, at).astype(np.int32) + 1
    at += 4 * n
    weight = np.frombuffer(data, np.uint32 if width == 4 else np.int64, n, at).astype(np.int64)
    words = _words(data[at + width * n:], lengths)
    place = np.arange(n)

    def above(k: int) -> np.ndarray:
        return label[np.maximum.accumulate(np.where(depth == k, place, 0))] if n else label

    a, b = above(1), np.where(depth > 1, above(2), 0)
    out = Transducer(words, a, b.astype(np.int32), np.where(depth > 2, label, 0).astype(np.int32), weight)
    return out.take(np.flatnonzero(weight > 0))


def _words(data: bytes, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, sorted, and the place (plus 1) of each given one."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), dtype=np.int32)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(order), rank[coded.indices.to_numpy()]


def _summed(words: pa.Array, a, b, c, weight, by=np.add) -> Transducer:
    """Sorted distinct states, the weights of equal ones added (or ``by``)."""
    pair = a.astype(np.int64) << 32 | b
    order = np.lexsort((c, pair))
    pair, c, weight = pair[order], c[order], weight[order]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (pair[1:] != pair[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return Transducer(words, *(np.zeros(0, dtype=np.int32) for _ in "abc"), np.zeros(0, dtype=np.int64))
    return Transducer(words, (pair[first] >> 32).astype(np.int32), pair[first].astype(np.int32), c[first],
                      by.reduceat(weight, first))


def union(parts: list[Transducer]) -> Transducer:
    """All states of all parts, the weights of equal ones summed."""
    if len(parts) == 1:
        return parts[0]
    words, rank = _ranked(pa.concat_arrays([p.words for p in parts]))
    at, columns = 0, ([], [], [])
    for p in parts:
        own = np.concatenate([[0], rank[at:at + len(p.words)]]).astype(np.int32)
        at += len(p.words)
        for out, column in zip(columns, (p.a, p.b, p.c)):
            out.append(own[column])
    return _summed(words, *map(np.concatenate, columns), np.concatenate([p.weight for p in parts]))


def shards(texts: list[bytes]) -> Iterator[Transducer]:
    """Transducers of the counts of all phrases of 1 to 3 words of the texts,
    one for each ``SHARD_WORDS`` words."""
    joined = b"\n".join(texts).translate(_LOWER) + b"\n"
    buf = np.frombuffer(joined, dtype=np.uint8)
    split = _SPLIT[buf]
    inside = ~(split | _GAP[buf])
    before = np.concatenate([[False], inside[:-1]])
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    if not len(start):
        return
    piece = np.cumsum(split, dtype=np.int32)[start]
    one, two = piece[1:] == piece[:-1], piece[2:] == piece[:-2]
    for lo in range(0, len(start), SHARD_WORDS):
        hi, more = min(lo + SHARD_WORDS, len(start)), min(lo + SHARD_WORDS + 2, len(start))
        stretch = slice(int(start[lo]), int(end[more - 1]))
        words, ids = _ranked(_words(buf[stretch][inside[stretch]].tobytes(), (end - start)[lo:more]))
        n = hi - lo
        ids = np.concatenate([ids, [0, 0]]).astype(np.int64)
        key = ids[:n] << 42
        key[:len(one[lo:hi])] |= np.where(one[lo:hi], ids[1:1 + len(one[lo:hi])] << 21, 0)
        key[:len(two[lo:hi])] |= np.where(two[lo:hi], ids[2:2 + len(two[lo:hi])], 0)
        key, count = np.unique(key, return_counts=True)
        # a state for every new word on the way to a distinct triple
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        first = np.flatnonzero(np.diff(a, prepend=-1))
        pair = key >> 21
        second = np.flatnonzero(np.diff(pair, prepend=-1))
        by_one, by_two = np.add.reduceat(count, first), np.add.reduceat(count, second)
        real = b[second] > 0
        second, by_two = second[real], by_two[real]
        third = np.flatnonzero(c)
        none = np.zeros(len(key), dtype=np.int64)
        states = [(a[first], none[:len(first)], none[:len(first)], by_one), (a[second], b[second], none[:len(second)], by_two),
                  (a[third], b[third], c[third], count[third])]
        packed = np.concatenate([x << 42 | y << 21 | z for x, y, z, _ in states])
        order = np.argsort(packed)
        packed, weight = packed[order], np.concatenate([s[3] for s in states])[order]
        yield Transducer(words, (packed >> 42).astype(np.int32), (packed >> 21 & 0x1FFFFF).astype(np.int32),
                         (packed & 0x1FFFFF).astype(np.int32), weight.astype(np.int64))


def _cut(lang: str, t: Transducer, bounds: list[tuple]) -> Iterator[tuple[int, Transducer]]:
    """The pieces of a transducer between the bounds, with their ranges."""
    low, high = bisect_left(bounds, (lang,)), bisect_left(bounds, (lang + "\0",))
    places = [0, *(t.place(b[1:]) for b in bounds[low:high]), len(t)]
    for k, (lo, hi) in enumerate(zip(places, places[1:])):
        if lo < hi:
            yield low + k, t.take(slice(lo, hi))


def _count(bounds: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            for t in shards(texts):
                rows = [(r, piece.encode()) for r, piece in _cut(lang, t, bounds)]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int32()), pa.array([lang] * len(rows)),
                                                  pa.array([x for _, x in rows], pa.binary())], names=["range", "lang", "blob"])

    for batch in batches:
        langs = batch.column(0).to_pylist()
        column = batch.column(1)
        for i, lang in enumerate(langs):
            text = column[i].as_py()
            if size and size + len(text) > SHARD_BYTES:
                yield from flush()
                held, size = {}, 0
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
    yield from flush()


def parts(t: Transducer) -> tuple[Transducer, np.ndarray]:
    """The parts of the candidates (states of 2 or 3 words) of ``t``: a
    transducer, whose weight is one more than the largest count of a longer
    candidate that holds the part, and per candidate the places in it of its
    first and last part at the first and at the second cut (or -1)."""
    two, three = np.flatnonzero((t.b > 0) & (t.c == 0)), np.flatnonzero(t.c)
    zero2, zero3 = np.zeros(len(two), dtype=np.int32), np.zeros(len(three), dtype=np.int32)
    x2, y2, x3, y3, z3 = t.a[two], t.b[two], t.a[three], t.b[three], t.c[three]
    cover, none = t.weight[three] + 1, np.ones(len(three), dtype=np.int64)
    asked = [(x2, zero2, zero2 + 1), (y2, zero2, zero2 + 1), (x3, zero3, none), (y3, z3, cover), (x3, y3, cover), (z3, zero3, none)]
    a, b = (np.concatenate([x[k] for x in asked]) for k in (0, 1))
    out = _summed(t.words, a, b, np.zeros(len(a), dtype=np.int32), np.concatenate([x[2] for x in asked]).astype(np.int64), np.maximum)
    at = np.searchsorted(out.pair(), a.astype(np.int64) << 32 | b)
    places = np.full((len(two) + len(three), 4), -1, dtype=np.int64)
    n, m = len(two), len(three)
    places[:n, 0], places[:n, 1] = at[:n], at[n:2 * n]
    for k in range(4):
        places[n:, k] = at[2 * n + k * m:2 * n + (k + 1) * m]
    return out, places


_STEP = "kind int, lang string, range int, dst int, blob binary, n long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                      names=["kind", "lang", "range", "dst", "blob", "n"])


_COUNTS, _DROPS, _REQUEST, _ANSWER, _TOTAL = range(5)


def _groups(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows (as dicts) by runs of equal values of ``by``, one at a time."""
    from itertools import groupby

    def rows() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}

    yield from groupby(rows(), key=lambda r: tuple(r[x] for x in by))


def _join(bounds: list[tuple], least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2: the pieces of a range joined, cut to frequent phrases; requests."""
    for (number, lang), rows in _groups(batches, "range", "lang"):
        done, waiting, states = None, [], 0
        for row in rows:
            waiting.append(decode(row["blob"]))
            states += len(waiting[-1])
            if states > max(JOIN_STATES, len(done) if done else 0):
                done, waiting, states = union([*([done] if done else []), *waiting]), [], 0
        t = union([*([done] if done else []), *waiting])
        out = [(_TOTAL, lang, number, None, None, int(t.weight[t.b == 0].sum()))]
        t = t.take(np.flatnonzero(t.weight >= least))
        if len(t):
            out.append((_COUNTS, lang, number, number // GROUP, t.encode(), None))
            asked: dict[int, list[Transducer]] = {}
            for r, piece in _cut(lang, parts(t)[0], bounds):
                asked.setdefault(r // GROUP, []).append(piece)
            for dst, pieces in asked.items():
                whole = Transducer(pieces[0].words, *(np.concatenate([getattr(p, x) for p in pieces]) for x in ("a", "b", "c", "weight")))
                out.append((_REQUEST, lang, number, dst, whole.encode(), None))
        yield _rows(out)


def _compose(share: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: for each group of ranges, its counts, then the requests to it."""
    for (dst, lang), rows in _groups(batches, "dst", "lang"):
        own: list[tuple[int, Transducer]] = []
        whole, key, cover = None, None, None
        for row in rows:
            if row["kind"] == _COUNTS:
                own.append((row["range"], decode(row["blob"])))
                continue
            if whole is None:
                whole = union([t for _, t in own])
                whole = whole.take(np.flatnonzero(whole.c == 0))  # parts have two words at most
                key, cover = whole.pair(), np.zeros(len(whole), dtype=np.int64)
            asked = decode(row["blob"])
            to = np.concatenate([[0], pc.index_in(asked.words, whole.words).to_numpy(zero_copy_only=False).astype(np.int64) + 1])
            at = np.searchsorted(key, to[asked.a] << 32 | to[asked.b])
            cover[at] = np.maximum(cover[at], asked.weight - 1)
            yield _rows([(_ANSWER, lang, row["range"], dst, whole.weight[at].tobytes(), None)])
        if whole is None:
            continue
        gone = whole.take(np.flatnonzero((whole.b > 0) & (100 * cover >= share * whole.weight)))
        if not len(gone):
            continue
        for number, t in own:  # each range learns which of its phrases go
            low, high = t.take([0]).phrases()[0].split(b" "), t.take([-1]).phrases()[0].split(b" ")
            lo, hi = gone.place(tuple(low)), gone.place((*high[:-1], high[-1] + b"\0"))
            if lo < hi:
                yield _rows([(_DROPS, lang, number, dst, gone.take(slice(lo, hi)).encode(), None)])


def _score(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Step 4: for each range and language its candidates, at most ``most``."""
    for (_, lang), rows in _groups(batches, "range", "lang"):
        t, gone, found = None, None, []
        for row in rows:
            if row["kind"] == _COUNTS:
                t = decode(row["blob"])
            elif row["kind"] == _DROPS:
                gone = decode(row["blob"])
            else:
                found.append(np.frombuffer(row["blob"], dtype=np.int64))
        if t is None or not found:
            continue
        counts = np.concatenate(found).tolist()
        _, places = parts(t)
        at = np.concatenate([np.flatnonzero((t.b > 0) & (t.c == 0)), np.flatnonzero(t.c)])
        left = np.ones(len(at), dtype=bool)
        if gone is not None:
            to = np.concatenate([[0], pc.fill_null(pc.index_in(gone.words, t.words), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1])
            pair = np.where(t.c[at] > 0, -1, t.pair()[at])
            left = ~np.isin(pair, to[gone.a] << 32 | to[gone.b])
        rows = []
        phrases = t.take(at[left]).phrases()
        for phrase, a, (i, j, k, m) in zip(phrases, t.weight[at[left]].tolist(), places[left].tolist()):
            top = 1_000_000 * a * a  # whole numbers of any size
            first, rest = counts[i], counts[j]
            score = top // (first * rest)
            if k >= 0 and (other := top // (counts[k] * counts[m])) < score:
                first, rest, score = counts[k], counts[m], other
            rows.append((-score, -a, phrase, first, rest))
        rows.sort()
        rows = rows[:most]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(rows)), pa.array([r[2].decode() for r in rows], pa.string()),
             *(pa.array(x, pa.int64()) for x in ([-r[1] for r in rows], [r[3] for r in rows], [r[4] for r in rows], [-r[0] for r in rows]))],
            names=["lang", "phrase", "a", "l", "r", "score"])


def _bounds(rows: DataFrame, count: int, ranges: int) -> list[tuple]:
    """Phrases (with their language) that divide a sample evenly, of some
    ``SAMPLE_ROWS`` rows of ``count``."""
    if ranges < 2:
        return []
    sample = rows.sample(min(1.0, SAMPLE_ROWS / count), seed=42).select(
        "lang", F.substring("text", 1, SAMPLE_CHARS).cast("binary").alias("data")).collect()
    by_lang: dict[str, list[bytes]] = {}
    for row in sample:
        by_lang.setdefault(row["lang"], []).append(bytes(row["data"]))
    every = sorted((lang, *p.split(b" ")) for lang, texts in by_lang.items() for t in shards(texts) for p in t.phrases())
    step = len(every) / ranges
    return sorted({every[int(k * step)] for k in range(1, ranges)}) if every else []


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, share: int = 50,
                 top: int = 2000, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The phrases of 2 or 3 words that occur ``least`` times or more, best
    first, up to ``top`` per language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into
    pieces, these at spaces and tabs into words. ``a`` counts the phrase; it is
    cut where ``score = floor(1000000 a a / (l r))`` is lowest (the first such
    place), ``l`` and ``r`` counting its parts; ``n`` counts all words of the
    language. A phrase inside a longer candidate that has at least ``share``
    percent of its count is left out. Ties rank by count, then phrase.

    Null texts are empty, null languages ``und``; repeated rows count again; an
    empty table gives no rows. A language without candidates has no rows.
    Memory follows a shard, a range and the longest single text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    bounds = _bounds(rows, count, int(min(MOST_RANGES, -(-size // range_bytes))))
    ranges = len(bounds) + 1
    groups = -(-ranges // GROUP)

    pieces = written(rows.select("lang", F.col("text").cast("binary")).mapInArrow(
        lambda it: _count(bounds, it), "range int, lang string, blob binary"), "pieces")
    joined = written(pieces.repartitionById(ranges, "range").sortWithinPartitions("range", "lang")
                     .mapInArrow(lambda it: _join(bounds, least, it), _STEP), "joined")
    both = joined.filter(F.col("kind").isin(_COUNTS, _REQUEST))
    composed = written(both.repartitionById(groups, "dst").sortWithinPartitions("dst", "lang", "kind", "range")
                       .mapInArrow(lambda it: _compose(share, it), _STEP), "composed")
    best = (joined.filter(F.col("kind") == _COUNTS).unionAll(composed).repartitionById(ranges, "range")
            .sortWithinPartitions("range", "lang", "kind", "dst")
            .mapInArrow(lambda it: _score(it, top), "lang string, phrase string, a long, l long, r long, score long"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # two steps, so that the last task of a language sees few rows per range
    some = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(64))).orderBy(*order)
    best = best.withColumn("place", F.row_number().over(some)).filter(F.col("place") <= top).drop("place")
    totals = joined.filter(F.col("kind") == _TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
