"""Finding repeated windows of a fixed size without a row for every window.

A scan divides the windows of each text into *groups*: consecutive windows
that choose the same anchor, an anchor being found from a window's own content
alone. Equal windows therefore have equal anchors, at the same distance from
their starts. What is compared are *units*, each with two names: ``c``, of
content that all its windows share (so equal windows lie in units of one
``c``), and ``s``, of all that its windows cover. The two come from independent
hashes, so that they are two names also where they cover the same.

1. Units are whole groups, ``c`` names the anchor. Units of the same (c, s)
   hold the same windows: one row per group and document decides most cases.
2. Where different groups share ``c``, some of their windows may be equal all
   the same. One document of each such (c, s) divides the group into blocks of
   windows at fixed distances from the anchor; ``c`` names the stretch that
   all windows of such a block have in common.
3. Different blocks that share ``c`` are divided into single windows.

The names found are brought back to their rows, known by ``doc`` and ``part``,
a hash of the text: rows without an id and rows of one id share a ``doc``, but
only equal texts (or a rare collision) share a ``part`` too. All groupings are
partial aggregations; joins are plain equi-joins that skew handling can split.
No list grows with anything but one text. Equal texts of one id do go to one
task, as rows with one list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import chunks, mix, written

#: Stands for a null id: after all others.
LAST = (1 << 63) - 1
#: What lists and texts are dealt and joined by.
KEY = ["doc", "part"]


@dataclass
class Units:
    """Runs of windows: ``text`` (index of the text), ``first`` and ``last``
    (starts, in the scan's own positions), ``anchor`` (place), ``c``, ``s``."""
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    c: np.ndarray
    s: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def take(self, at: np.ndarray) -> Units:
        return Units(*(x[at] for x in (self.text, self.first, self.last, self.anchor, self.c, self.s)))


@dataclass
class Scan:
    """The groups of some texts. ``of(start, end)`` names stretches by their
    content for ``c``, ``other`` does so independently for ``s``; ``size`` is
    that of a window, ``block`` the windows of a block; ``verify`` fails if equal names stand for different content."""
    groups: Units
    of: Callable[[np.ndarray, np.ndarray], np.ndarray]
    other: Callable[[np.ndarray, np.ndarray], np.ndarray]
    size: int
    block: int
    verify: Callable[[], None] = lambda: None

    def name(self, u: Units) -> np.ndarray:
        """``s`` of units: what they cover, and where their anchor lies."""
        return mix(self.other(u.first, u.last + self.size) ^ mix((u.anchor - u.first).astype(np.uint64) + np.uint64(99)))

    def divide(self, u: Units, width: int) -> Units:
        """The units in blocks of ``width`` windows at distances from the
        anchor that are the same for every unit."""
        low = (u.anchor - u.last) // width
        count = (u.anchor - u.first) // width - low + 1
        ends = np.cumsum(count)
        if not len(u):
            return u
        k = np.arange(int(ends[-1])) - np.repeat(ends - count, count) + np.repeat(low, count)
        out = u.take(np.repeat(np.arange(len(u)), count))
        near = out.anchor - k * width  # the last start that the block may have
        out.first, out.last = np.maximum(out.first, near - width + 1), np.minimum(out.last, near)
        out.c = mix(self.of(near, near - width + 1 + self.size) + mix(k.astype(np.uint64) + np.uint64(width)))
        out.s = self.name(out)
        return out


def no_groups() -> Units:
    none = np.zeros(0, dtype=np.int64)
    return Units(none, none, none, none, none.view(np.uint64), none.view(np.uint64))


class RangeMin:
    """Index of the least value (the first of equals) in ranges of an array."""

    def __init__(self, values: np.ndarray, widest: int):
        self.values = values
        self.levels = [np.arange(len(values), dtype=np.int32)]
        step = 1
        while 2 * step <= widest and 2 * step <= len(values):
            a, b = self.levels[-1][:-step], self.levels[-1][step:]
            self.levels.append(np.where(values[b] < values[a], b, a))
            step *= 2

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For half-open ranges, none empty or wider than ``widest``."""
        width = hi - lo
        level = np.frexp(width.astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k, best in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            if len(at):
                a, b = best[lo[at]], best[hi[at] - (1 << k)]
                out[at] = np.where(self.values[b] < self.values[a], b, a)
        return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _name_groups(scan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        found = scan(texts)
        found.verify()
        g = found.groups
        doc, part = _list(batch, "doc").to_numpy()[g.text], _list(batch, "part").to_numpy()[g.text]
        # a group that a text repeats becomes one row with a count
        key = mix(g.s + mix(g.c + mix(doc.view(np.uint64) + mix(part.astype(np.uint64)))))
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([_signed(g.c[at]), _signed(g.s[at]), pa.array(doc[at]), pa.array(part[at]),
                                          pa.array(n, pa.int64())], names=["c", "s", "doc", "part", "n"])


def _member(lists: pa.Array, text: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether each (text, name) is in that text's list."""
    out = np.zeros(len(names), dtype=bool)
    if not len(names) or lists.null_count == len(lists):
        return out
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    sizes = np.nan_to_num(np.array(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.float64)).astype(np.int64)
    owner = np.repeat(np.arange(len(lists), dtype=np.uint64), sizes)
    salt = np.uint64(0x9E3779B97F4A7C15)
    have = np.unique(mix(flat + owner * salt))
    if not len(have):
        return out
    want = mix(names + text.astype(np.uint64) * salt)
    return have[np.minimum(np.searchsorted(have, want), len(have) - 1)] == want


def _list(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _name_parts(scan, levels: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of the groups listed in ``groups``; with two levels the
    windows of those of their blocks that ``blocks`` lists."""
    for batch, texts in chunks(batches):
        found = scan(texts)
        whole = found.groups.take(np.flatnonzero(_member(_list(batch, "groups"), found.groups.text, found.groups.s)))
        parts = found.divide(whole, found.block)
        if levels == 2:
            parts = parts.take(np.flatnonzero(_member(_list(batch, "blocks"), parts.text, parts.s)))
            parent = parts.s
            windows = found.divide(parts, 1)
            source = np.repeat(parent, parts.last - parts.first + 1)
            parts = windows
        else:
            source = np.repeat(whole.s, (whole.anchor - whole.first) // found.block - (whole.anchor - whole.last) // found.block + 1)
        row = [pa.array(_list(batch, x).to_numpy()[parts.text]) for x in KEY]
        yield pa.RecordBatch.from_arrays([_signed(parts.c), _signed(parts.s), _signed(source), *row],
                                         names=["c", "s", "source", *KEY])


def repeated_windows(batch: pa.RecordBatch, texts: list[bytes], scan) -> tuple[np.ndarray, np.ndarray]:
    """First and last starts of the runs of windows to remove, of a batch with
    the lists ``gone_groups``, ``gone_blocks`` and ``gone_windows``, and the
    lists of what was divided."""
    found = scan(texts)
    g = found.groups
    gone = _member(_list(batch, "gone_groups"), g.text, g.s)
    out = [g.take(np.flatnonzero(gone))]
    left = g.take(np.flatnonzero(~gone & _member(_list(batch, "groups"), g.text, g.s)))
    blocks = found.divide(left, found.block)
    gone = _member(_list(batch, "gone_blocks"), blocks.text, blocks.s)
    out.append(blocks.take(np.flatnonzero(gone)))
    left = blocks.take(np.flatnonzero(~gone & _member(_list(batch, "blocks"), blocks.text, blocks.s)))
    windows = found.divide(left, 1)
    out.append(windows.take(np.flatnonzero(_member(_list(batch, "gone_windows"), windows.text, windows.s))))
    return np.concatenate([u.first for u in out]), np.concatenate([u.last for u in out])


def covered(first: np.ndarray, last: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that starts in one of the runs."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, np.minimum(last + size, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _lists(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.collect_set("s").alias(name))


def mark(docs: DataFrame, scan, earlier: bool) -> DataFrame:
    """``docs`` (columns ``doc`` (long, not null), ``data`` (binary), and any
    others but ``part``) with the lists that ``repeated_windows`` needs.

    ``earlier``: a window goes if it also occurs in a document with a smaller
    ``doc``; else if it occurs anywhere else, and then every occurrence goes.
    """
    docs = docs.withColumn("part", F.hash("data"))
    named = written(docs.select(*KEY, "data").mapInArrow(
        lambda it: _name_groups(scan, it), "c long, s long, doc long, part int, n long"), "groups")
    several = F.col("least") < F.col("most") if earlier else F.col("n") > 1
    ruled = F.col("doc") > F.col("least") if earlier else F.lit(True)

    def decide(units: DataFrame) -> DataFrame:
        """Units (c, s, least) that repeat (``again``) or share ``c`` with others (``open``)."""
        alone = units.groupBy("c").agg(F.min("s").alias("s0"), F.max("s").alias("s1"),
                                       F.min("least").alias("d0"), F.max("most").alias("d1"))
        shared = alone.filter("s0 <> s1 AND d0 <> d1" if earlier else "s0 <> s1").select("c", F.lit(True).alias("open"))
        return written(units.select("c", "s", "least", several.alias("again")).join(shared, "c", "left")
                       .withColumn("open", F.coalesce("open", F.lit(False))).filter("again OR open"), "units")

    groups = decide(named.groupBy("c", "s").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.sum("n").alias("n")))
    # every row of the least document divides: its rows have texts of their own
    gone, divides = F.col("again") & ruled, F.col("open") & (F.col("doc") == F.col("least"))
    listed = written(named.join(groups, ["c", "s"]).select(*KEY, "s", gone.alias("gone"), divides.alias("divides"))
                     .filter("gone OR divides").groupBy(*KEY)
                     .agg(F.collect_set(F.when(F.col("gone"), F.col("s"))).alias("gone_groups"),
                          F.collect_set(F.when(F.col("divides"), F.col("s"))).alias("groups")), "lists")

    # one exchange of the texts serves all joins: all ask for the same columns
    texts = docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEY)
    kinds = "c long, s long, source long, doc long, part int"
    divided = listed.filter("size(groups) > 0").select(*KEY, "groups")
    rows = written(texts.join(divided, KEY).mapInArrow(lambda it: _name_parts(scan, 1, it), kinds), "blocks")
    # a unit repeats when it comes from different units: one never holds it twice
    as_units = [F.min("doc").alias("least"), F.max("doc").alias("most"),
                F.when(F.min("source") != F.max("source"), 2).otherwise(1).alias("n")]
    blocks = decide(rows.groupBy("c", "s").agg(*as_units))
    gone_blocks = _lists(rows.join(blocks.filter("again"), ["c", "s"]).filter(ruled).select(*KEY, "s"), "gone_blocks")
    open_blocks = blocks.filter("open").select("c", "s", "least")
    open_rows = rows.join(open_blocks, ["c", "s"]).filter("doc = least")
    blocks_of = _lists(open_rows.select(*KEY, "s"), "blocks")

    rows = written(texts.join(divided.join(blocks_of, KEY), KEY).mapInArrow(
        lambda it: _name_parts(scan, 2, it), kinds), "windows")
    windows = rows.groupBy("c", "s").agg(*as_units).filter(several).select("c", "s", "least")
    gone_windows = _lists(rows.join(windows, ["c", "s"]).filter(ruled).select(*KEY, "s"), "gone_windows")
    # blocks and windows come from listed rows only
    lists = listed.join(blocks_of, KEY, "left").join(gone_blocks, KEY, "left").join(gone_windows, KEY, "left")
    return texts.join(lists, KEY, "left")
