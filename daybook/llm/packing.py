"""Best-fit packing by a configuration program.

A configuration is a filling of one sequence: how many pieces of each length.
Only the histogram of lengths matters, so the program has at most as many
rows as a sequence has tokens, however many documents there are. It is solved
by multiplicative weights: a length that is packed more slowly than the
others gains weight, a knapsack dynamic program prices the next
configuration, and the configuration is used a whole number of times, so the
solution is rounded as it is made. The pieces are then dealt to the places of
their length by rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import chunks, id_and_text, written
from daybook.llm.pretoken import library_table

PIECE_SCHEMA = ("id long, piece int, start long, length int, ids_crc32 long, "
                "part int, place long")


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Pieces of a document of ``n`` tokens: only longer ones are cut; the
    first piece may be shorter."""
    full, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * full


def _pieces(path: str, end_id: int, capacity: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = library_table(path)
    part = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, dtype=np.int64)  # pieces of each length so far in this task
    for batch, texts in chunks(batches):
        ids, counts = table.ids([t.decode() for t in texts])
        at = 0
        rows: list[tuple] = []
        for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
            own = np.append(ids[at:at + n], end_id).astype("<u4")
            at += n
            start = 0
            for k, length in enumerate(cut_lengths(n + 1, capacity)):
                rows.append((doc, k, start, length, zlib.crc32(own[start:start + length].tobytes()), part,
                             int(seen[length])))
                seen[length] += 1
                start += length
        cols = list(zip(*rows))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=[x.split()[0] for x in PIECE_SCHEMA.split(", ")])


def _knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> list[int]:
    """Lengths (repeats allowed) of greatest value that fit into ``capacity``."""
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)  # 0: one token left empty
    fit = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fit[room]
        best[room] = best[room - 1]
        if n:
            total = best[room - lengths[:n]] + values[:n]
            top = int(total.argmax())
            if total[top] > best[room] + 1e-12:
                best[room], pick[room] = total[top], lengths[top]
    out, room = [], capacity
    while room > 0:
        if pick[room]:
            out.append(int(pick[room]))
        room -= int(pick[room]) or 1
    return out


def solve(histogram: dict[int, int], capacity: int, rate: float = 4.0, share: float = 0.5, tilt: float = 0.5) -> list[tuple[dict[int, int], int]]:
    """Configurations ``({length: pieces}, times used)`` that hold every piece
    of the histogram exactly once.

    ``rate``: how strongly a length that lags gains weight; ``share``: the
    part of its scarcest length that a configuration takes at once. The value
    of a length is its size times its weight, so that at even progress a full
    sequence is worth most. Each turn packs at least one sequence and a fixed
    part of one length, so the number of turns depends on the number of
    lengths and the logarithm of the counts.
    """
    wanted = np.zeros(capacity + 1)
    for length, n in histogram.items():
        wanted[length] = n
    left = wanted.astype(np.int64)
    out: list[tuple[dict[int, int], int]] = []
    while left.any():
        lengths = np.flatnonzero(left)
        behind = left[lengths] / wanted[lengths]
        weight = np.exp(rate * (behind - behind.mean()))
        # size dominates; weight and length decide between fillings that are about as full
        values = lengths * (1 + tilt * lengths / capacity * (1 + weight / weight.max()))
        chosen: dict[int, int] = {}
        for length in _knapsack(lengths, values, capacity):
            if chosen.get(length, 0) < left[length]:
                chosen[length] = chosen.get(length, 0) + 1
        # copies that don't exist leave room: fill it with the longest that fit
        room = capacity - sum(k * n for k, n in chosen.items())
        for length in lengths[::-1].tolist():
            while length <= room and chosen.get(length, 0) < left[length]:
                chosen[length] = chosen.get(length, 0) + 1
                room -= length
        most = min(int(left[k]) // n for k, n in chosen.items())
        times = max(1, int(most * share)) if most > 8 else most
        for k, n in chosen.items():
            left[k] -= n * times
        out.append((chosen, times))
    return out


class Places:
    """Where the ``rank``-th piece of a length goes."""

    def __init__(self, configurations: list[tuple[dict[int, int], int]]):
        self.ranks: dict[int, list[int]] = {}  # first rank of each slot of a length
        self.slots: dict[int, list[tuple[int, int]]] = {}  # its (first sequence, offset)
        taken: dict[int, int] = {}
        sequence = 0
        for filling, times in configurations:
            offset = 0
            for length, n in sorted(filling.items(), reverse=True):
                for _ in range(n):
                    first = taken.get(length, 0)
                    self.ranks.setdefault(length, []).append(first)
                    self.slots.setdefault(length, []).append((sequence, offset))
                    taken[length] = first + times
                    offset += length
            sequence += times
        self.sequences = sequence

    def of(self, length: int, rank: int) -> tuple[int, int]:
        at = bisect_right(self.ranks[length], rank) - 1
        sequence, offset = self.slots[length][at]
        return sequence + rank - self.ranks[length][at], offset


def _assign(places: Places, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [places.of(n, r) for n, r in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist())]
        keep = ["id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keep[:3]), batch.column("length").cast(pa.int64()), batch.column("ids_crc32"),
             pa.array([s for s, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())],
            names=[*keep, "sequence_id", "offset"])


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)``: every
    piece of every document and its place.

    A document is its text's ids by the tokenizer file ``path`` and
    ``end_id``. Null text counts as empty (one piece of one token). Null and
    repeated ids are kept, each row is packed. An empty table gives an empty
    result.

    The text is read once, without a shuffle; the pieces (some dozen bytes
    each) are written to the shared folder. The driver gets the histogram (at
    most ``capacity`` rows) and sends back the places. A rank is the rank in
    the task plus the count in earlier tasks, so a length that most pieces
    share is never gathered.
    """
    rows = id_and_text(docs, id_col, text_col)
    pieces = written(rows.mapInArrow(lambda it: _pieces(path, end_id, capacity, it), PIECE_SCHEMA), "pieces")
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(solve(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    # a task holds its share of the counts (at most ``capacity`` for each task of the first stage); pieces aren't sorted
    ranked = pieces.join(base.hint("shuffle_hash"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        lambda it: _assign(places, it),
        "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
