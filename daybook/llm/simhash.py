"""SimHash near-duplicates by vantage-point trees.

Fingerprints are computed once per row. Equal ones are one vertex, so a group
of copies costs one row. A vantage-point tree, built on a bounded sample,
deals every distinct fingerprint to the shard (leaf) it lies in, and as a
query to each shard whose boundary is within the search radius. A shard is
searched with trees of its own, pruning by the triangle bound; it reports a
spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import Words, chunks, id_and_text, written
from daybook.llm.components import connected_components

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Most fingerprints fetched to choose vantage points, fingerprints meant for
#: one shard, and rows of one side that a search task takes at once.
SAMPLE, SHARD, TASK_ROWS = 20_000, 2_000, 200_000


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of each text: A-Z lower-cased, words joined by one space, a bit
    is set when it is set in over half of the shingles' hashes (repeats
    count). Fewer words: the whole sequence is the shingle; none: zero."""
    out = np.zeros(len(texts), dtype=np.uint64)
    plain = [b" ".join(t.lower().split()) for t in texts]
    words = Words(plain)
    start, end = words.start, words.end
    digest, joined = xxhash.xxh64_intdigest, words.joined
    for i in range(len(texts)):
        lo, hi = words.first[i], words.first[i + 1]
        if lo == hi:
            continue
        size = min(shingle, hi - lo)
        begins, ends = start[lo:hi - size + 1].tolist(), end[lo + size - 1:hi].tolist()
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(begins, ends)), dtype=">u8", count=len(begins))
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), 1 << 16):  # bounds the memory of one long text
            bits = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(h)).view(">u8")[0]
    return out


def _fingerprint_batches(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(fingerprints_of(texts, shingle).view(np.int64)), batch.column(2)],
            names=["id", "fp", "h"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp, h)`` per row; ``h`` is a hash of the text."""
    rows = id_and_text(docs, id_col, text_col).withColumn("h", F.xxhash64("data"))
    return rows.mapInArrow(lambda it: _fingerprint_batches(shingle, it), "id long, fp long, h long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _halve(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and radius that put about half of the points inside;
    None when no point tried divides them. Of a few points the one with the
    fewest others near its boundary is taken."""
    best = None
    for at in np.linspace(0, len(points) - 1, num=min(8, len(points)), dtype=np.int64):
        d = distance(points, points[at])
        radius = int(np.median(d))
        if radius == d.max():
            radius -= 1
        inside = int((d <= radius).sum())
        if radius < 0 or not 0 < inside < len(points):
            continue
        cost = (int((np.abs(d.astype(np.int16) - radius) <= RADIUS).sum()) + abs(2 * inside - len(points)), int(at))
        if best is None or cost < best[0]:
            best = cost, (points[at], radius)
    return best and best[1]


class ShardTree:
    """A vantage-point tree whose leaves are the shards."""

    def __init__(self, sample: np.ndarray, leaves: int, least: int = 16):
        self.nodes: list[tuple] = []  # (vantage, radius, inside, outside) or (leaf number,)
        self.leaves = 0
        self._build(np.unique(sample), max(1, leaves), least)

    def _build(self, points: np.ndarray, leaves: int, least: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        cut = _halve(points) if leaves > 1 and len(points) >= 2 * least else None
        if cut is None:
            self.nodes[at] = (self.leaves,)
            self.leaves += 1
            return at
        inside = distance(points, cut[0]) <= cut[1]
        n = int(inside.sum())
        share = min(leaves - 1, max(1, round(leaves * n / len(points))))
        self.nodes[at] = (*cut, self._build(points[inside], share, least),
                          self._build(points[~inside], leaves - share, least))
        return at

    def route(self, points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, indexes of points that lie in it, indexes of the others that
        must be asked there)."""
        todo = [(0, np.arange(len(points)), np.zeros(0, dtype=np.int64))]
        while todo:
            at, home, visit = todo.pop()
            if not len(home) and not len(visit):
                continue
            node = self.nodes[at]
            if len(node) == 1:
                yield node[0], home, visit
                continue
            vantage, r, inner, outer = node
            dh = distance(points[home], vantage).astype(np.int16)
            dv = distance(points[visit], vantage).astype(np.int16)
            inside = dh <= r
            todo.append((inner, home[inside], np.concatenate([home[~inside & (dh <= r + radius)], visit[dv <= r + radius]])))
            todo.append((outer, home[~inside], np.concatenate([home[inside & (dh > r - radius)], visit[dv > r - radius]])))


class Forest:
    """Union-find over ``n`` items with whole arrays of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (higher := self.root[self.root]).tolist() != self.root.tolist():
                self.root = higher


def search(points: np.ndarray, home: np.ndarray, visit: np.ndarray, radius: int, forest: Forest,
           block: int = 1 << 20) -> None:
    """Link every point of ``visit`` to every point of ``home`` (indexes) at
    most ``radius`` bits away: vantage-point halves while the product is
    large, then plain comparison."""
    todo = [(home, visit)]
    while todo:
        home, visit = todo.pop()
        if not len(home) or not len(visit):
            continue
        cut = _halve(points[home]) if len(home) * len(visit) > block and len(home) > 64 else None
        if cut is None:
            rows = max(1, block // len(home))
            for at in range(0, len(visit), rows):
                some = visit[at:at + rows]
                i, j = np.nonzero(distance(points[some][:, None], points[home][None, :]) <= radius)
                forest.link(some[i], home[j])
            continue
        dh = distance(points[home], cut[0]).astype(np.int16)
        dv = distance(points[visit], cut[0]).astype(np.int16)
        inside = dh <= cut[1]
        todo.append((home[inside], visit[dv <= cut[1] + radius]))
        todo.append((home[~inside], visit[dv > cut[1] - radius]))


def _search_shard(radius: int, key, rows: pa.Table) -> pa.Table:
    fp = rows.column("fp").to_numpy().view(np.uint64)
    points, at = np.unique(fp, return_inverse=True)
    is_home = rows.column("home").to_numpy()
    forest = Forest(len(points))
    home = np.unique(at[is_home])
    search(points, home, np.unique(at), radius, forest)
    child = np.flatnonzero(forest.root != np.arange(len(points)))
    return pa.table({"a": points[child].view(np.int64), "b": points[forest.root[child]].view(np.int64)})


def links(fps: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD,
          task_rows: int = TASK_ROWS) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints (column ``fp``)
    at most ``radius`` bits apart: a spanning forest per shard.

    Only ``sample`` fingerprints at most reach the driver; they choose the
    vantage points, and every fingerprint is dealt and asked exactly. A shard
    larger than ``task_rows`` is cut into a grid of (part of the shard) x
    (part of its queries), each pair in one cell.
    """
    n = fps.count()
    share = min(1.0, sample / max(n, 1))
    drawn = fps.sample(False, share, 7).limit(2 * sample) if share < 1 else fps
    seeds = np.array([r[0] for r in drawn.select("fp").collect()], dtype=np.int64).view(np.uint64)
    tree = ShardTree(seeds, max(1, n // shard))

    def deal(batches, grid):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            points = fp.view(np.uint64)
            for leaf, home, visit in tree.route(points, radius):
                both = np.concatenate([home, visit])
                is_home = np.arange(len(both)) < len(home)
                parts_h, parts_v = grid.get(leaf, (1, 1))
                salt = (points[both] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                # a home row is also a query of its own shard: it takes part in both roles
                for h in range(parts_h):
                    for v in range(parts_v):
                        mine = (is_home & (salt % np.uint64(parts_h) == h)) | (salt % np.uint64(parts_v) == v)
                        at = both[mine]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), leaf, np.int32)), pa.array(np.full(len(at), h, np.int32)),
                             pa.array(np.full(len(at), v, np.int32)), pa.array(fp[at]),
                             pa.array((is_home & (salt % np.uint64(parts_h) == h))[mine])],
                            names=["leaf", "h", "v", "fp", "home"])

    schema = "leaf int, h int, v int, fp long, home boolean"
    only = fps.select("fp")
    sizes = only.mapInArrow(lambda it: deal(it, {}), schema).groupBy("leaf").agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("asked")).collect()
    grid = {r.leaf: (-(-r.homes // task_rows) or 1, -(-r.asked // task_rows)) for r in sizes
            if r.asked > task_rows}
    dealt = only.mapInArrow(lambda it: deal(it, grid), schema)
    return dealt.groupBy("leaf", "h", "v").applyInArrow(
        lambda key, rows: _search_shard(radius, key, rows), "a long, b long")


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``(id, fp, h)`` and, per distinct fingerprint, the root
    fingerprint of its component."""
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = written(rows.select("fp").distinct(), "simhash-distinct")
    roots = connected_components(links(distinct, radius))
    return rows, distinct.join(roots, distinct.fp == roots.vertex, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(id, fingerprint, component_id)`` per input row.

    Null and empty texts have fingerprint zero and are linked like any other.
    Null ids are kept; they never name a component unless all its ids are
    null (then it is null). Repeated rows each get a row. An empty table
    gives an empty result.
    """
    rows, roots = _classes(docs, id_col, text_col, shingle, radius)
    least = rows.groupBy("fp").agg(F.min("id").alias("least"))
    named = least.join(roots, "fp")
    comp = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = named.join(comp, "root").select("fp", "component_id")
    return rows.join(label, "fp").select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the
    smallest id (nulls last), of the smallest text hash where ids repeat, and
    one row of it where the row repeats."""
    rows, roots = _classes(docs, id_col, text_col, shingle, radius)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    best = rows.groupBy("fp").agg(F.min(order).alias("first"))
    stay = best.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("id"), F.col("first.h").alias("h"))
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = plain[f"c{names.index(id_col)}"].cast("long")
    text = F.coalesce(plain[f"c{names.index(text_col)}"], F.lit(""))
    # coalesced keys keep the joins plain equi-joins that skew handling knows
    keyed = plain.select("*", key.isNull().alias("k0"), F.coalesce(key, F.lit(0)).alias("k1"),
                         F.xxhash64(text.cast("binary")).alias("k2"))
    once = keyed.withColumn("n", F.row_number().over(Window.partitionBy("k0", "k1", "k2").orderBy("k2"))) \
        .filter("n = 1")
    stay = stay.select(F.col("id").isNull().alias("k0"), F.coalesce("id", F.lit(0)).alias("k1"), F.col("h").alias("k2"))
    return once.join(stay, ["k0", "k1", "k2"], "left_semi").select(*plain.columns).toDF(*names)
