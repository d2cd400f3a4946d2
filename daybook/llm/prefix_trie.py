"""Prefix trie of conversations, found by truncation peeling.

A conversation is a path: 16 bytes a turn, a hash of its role and text. Paths
are sorted and dealt by range, so that conversations with a common beginning
lie side by side and a common beginning of any size is split over tasks. A task
peels its paths block by block, from the greatest depth down: the nodes left
over from one depth deeper lose their last turn, meet the conversations that
end here, and equal ones are merged, which yields the nodes of this depth with
their counts. A node that may also have members outside the block is a prefix
of the block's first or last path: it is not finished, but stays as a partial
count on that path. The next Spark round peels these survivors (two rows at
most of every block) in the same way, until one block holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

TURN = 16
#: A block ends at so many rows, or at so many bytes of paths when it has the
#: least number of rows.
BLOCK_ROWS, BLOCK_BYTES, LEAST_ROWS = 1 << 16, 8 << 20, 64
#: The last round takes at most so many survivors.
LAST_ROWS = 1 << 14
EMPTY = hashlib.sha256().hexdigest()
_SUMS = ["cnt", "least", "kids", "leaves", "saved"]
_ENTRIES = ["at", *_SUMS]
_KINDS = ("kind int, conv_id long, depth long, parent_conv_id long, parent binary, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, key binary, joined binary, path binary, "
          "words array<int>, at array<int>, " + ", ".join(f"{n} array<long>" for n in _SUMS))
_NODE, _ENDS, _LEFT = range(3)
_FAR = np.iinfo(np.int64).max


def _typed(name: str) -> pa.DataType:
    kinds = dict(part.split(" ") for part in _KINDS.split(", "))
    return {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
            "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[kinds[name]]


_NAMES = [part.split(" ")[0] for part in _KINDS.split(", ")]


def _batch(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], _typed(name)) if name in columns else pa.nulls(n, _typed(name)) for name in _NAMES],
        names=_NAMES)


class Block:
    """Rows sorted by path, with partial counts (``entries``) at some depths of
    their paths; a conversation that ends has one at its own depth."""

    def __init__(self, paths: list[bytes], words: np.ndarray, entries: dict[str, np.ndarray], convs: np.ndarray | None):
        self.paths, self.words, self.entries, self.convs = paths, words, entries, convs
        self.depth = np.fromiter((len(p) // TURN for p in paths), np.int64, len(paths))
        self.offset = np.concatenate([[0], np.cumsum(self.depth)])
        flat = np.frombuffer(b"".join(paths), dtype=np.uint64).reshape(-1, 2)
        both = np.minimum(self.depth[1:], self.depth[:-1])
        self.common = np.zeros(len(paths), dtype=np.int64)  # turns shared with the row before
        some = np.flatnonzero(both)
        if len(some):
            size = both[some]
            ends = np.cumsum(size)
            k = np.arange(int(ends[-1])) - np.repeat(ends - size, size)
            a, b = np.repeat(self.offset[some], size) + k, np.repeat(self.offset[some + 1], size) + k
            same = (flat[a] == flat[b]).all(axis=1)
            self.common[some + 1] = np.minimum.reduceat(np.where(same, _FAR, k), ends - size)
        self.common[1:] = np.minimum(self.common[1:], both)
        self._keys: dict[int, list[bytes]] = {}

    def key(self, row: int, depth: int) -> bytes:
        """Names the node of the row's first ``depth`` turns, in any block."""
        if row not in self._keys:
            h, keys, path = hashlib.sha256(b"trie"), [], self.paths[row]
            for at in range(0, len(path) + 1, TURN):
                keys.append(h.digest()[:TURN])
                h.update(path[at:at + TURN])
            self._keys = {row: keys} if len(self._keys) > 1 else self._keys | {row: keys}
        return self._keys[row][depth]

    def _ended(self, row: int) -> tuple[int, bytes]:
        """The least of the conversations that end in the node whose first row
        is ``row``, and all of them joined."""
        end = row + 1
        while end < len(self.paths) and self.depth[end] == self.depth[row] == self.common[end]:
            end += 1
        ids = self.convs[row:end].tolist()
        return ids[0], ",".join(map(str, ids)).encode()

    def peel(self, last: bool) -> Iterator[pa.RecordBatch]:
        e, n = self.entries, len(self.paths)
        order = np.lexsort((e["row"], e["depth"]))
        e = {name: x[order] for name, x in e.items()}
        bounds = np.searchsorted(e["depth"], np.arange(int(self.depth.max()) + 2))
        none = {name: np.zeros(0, dtype=np.int64) for name in ["row", "open", *_SUMS]}
        found, below = none, None  # the nodes one deeper, and their rows of the result
        left: dict[int, list[tuple]] = {0: [], n - 1: []}
        ends: list[tuple[bytes, int, bytes]] = []
        for d in range(int(self.depth.max()), -1, -1):
            own = {name: x[bounds[d]:bounds[d + 1]] for name, x in e.items()}
            edge = np.where(self.depth[own["row"]] == d, (own["row"] == n - 1) * 2 + (own["row"] == 0), 0) * (not last)
            inner = found["open"] == 0
            both = {"row": np.concatenate([found["row"], own["row"]]), "open": np.concatenate([found["open"], edge]),
                    "cnt": np.concatenate([found["cnt"], own["cnt"]]), "least": np.concatenate([found["least"], own["least"]]),
                    "kids": np.concatenate([inner.astype(np.int64), own["kids"]]),
                    "leaves": np.concatenate([found["leaves"], own["leaves"]]),
                    "saved": np.concatenate([found["saved"], own["saved"]])}
            order = np.argsort(both["row"], kind="stable")
            both = {name: x[order] for name, x in both.items()}
            row = both["row"]
            new = self.common[row] < d
            new[1:] &= row[1:] != row[:-1]
            new[0] = True
            first = np.flatnonzero(new)
            group = np.empty(len(row), dtype=np.int64)
            group[order] = np.cumsum(new) - 1
            node = {name: np.add.reduceat(both[name], first) for name in ("cnt", "kids", "leaves", "saved")}
            node["least"] = np.minimum.reduceat(both["least"], first)
            node["open"] = np.bitwise_or.reduceat(both["open"], first)
            node["row"] = row[first]
            if below is not None:
                yield self._nodes(d + 1, below, node, group[:len(found["row"])], found)
            for g in np.flatnonzero(node["open"]).tolist():
                left[n - 1 if node["open"][g] & 2 else 0].append((d, *(int(node[name][g]) for name in _SUMS)))
            closed = node["open"] == 0
            if d:
                own_words = self.words[self.offset[node["row"]] + d - 1]
                node["saved"] = node["saved"] + (node["cnt"] - 1) * own_words
            node["leaves"] = np.where(node["kids"] == 0, 1, node["leaves"])
            digests = None
            if self.convs is not None:
                digests = np.full(len(first), EMPTY, dtype=object)
                for g in np.flatnonzero(self.depth[node["row"]] == d).tolist():
                    r = int(node["row"][g])
                    least, joined = self._ended(r)
                    if closed[g]:
                        digests[g] = hashlib.sha256(joined).hexdigest()
                    else:
                        ends.append((self.key(r, d), least, joined))
            below = (digests, node["kids"])
            # an open node goes on as a mark alone: its counts stay on its path
            found = {name: np.where(closed, node[name], _FAR if name == "least" else 0) for name in _SUMS}
            found |= {"row": node["row"], "open": node["open"]}
        yield self._nodes(0, below, None, None, found)
        if ends:
            yield _batch(len(ends), kind=[_ENDS] * len(ends), key=[x[0] for x in ends],
                         conv_id=[x[1] for x in ends], joined=[x[2] for x in ends])
        rows = [r for r in sorted(left) if left[r]]
        if rows:
            yield _batch(len(rows), kind=[_LEFT] * len(rows), path=[self.paths[r] for r in rows],
                         words=[self.words[self.offset[r]:self.offset[r + 1]] for r in rows],
                         **{name: [[x[k] for x in left[r]] for r in rows] for k, name in enumerate(_ENTRIES)})

    def _nodes(self, d: int, below: tuple, parents: dict | None, group: np.ndarray | None, found: dict) -> pa.RecordBatch:
        """The finished nodes of a depth, now that their parents are known."""
        digests, kids = below
        at = np.flatnonzero(found["open"] == 0)
        columns = {"kind": np.full(len(at), _NODE, np.int32), "conv_id": found["least"][at], "depth": np.full(len(at), d),
                   "n_convs": found["cnt"][at], "n_children": kids[at], "n_leaves": found["leaves"][at],
                   "saved_tokens": found["saved"][at]}
        if digests is not None:
            columns["ends_sha256"] = digests[at].tolist()
        else:
            columns["key"] = [self.key(r, d) for r in found["row"][at].tolist()]
        if parents is not None:
            of = group[at]
            done = parents["open"][of] == 0
            columns["parent_conv_id"] = pa.array(parents["least"][of], pa.int64(), mask=~done)
            names = {g: self.key(int(parents["row"][g]), d - 1) for g in np.unique(of[~done]).tolist()}
            columns["parent"] = [names.get(g) for g in of.tolist()]
        return _batch(len(at), **columns)


def _lists(batches: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([b.column(b.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
                           for b in batches]).astype(np.int64)


def _block(batches: list[pa.RecordBatch], first: bool) -> Block:
    paths = [p for b in batches for p in b.column(b.schema.get_field_index("path")).to_pylist()]
    n = len(paths)
    if first:
        convs = np.concatenate([b.column(b.schema.get_field_index("conv")).to_numpy() for b in batches])
        entries = {"row": np.arange(n), "depth": np.fromiter((len(p) // TURN for p in paths), np.int64, n),
                   "cnt": np.ones(n, dtype=np.int64), "least": convs}
        entries |= {name: np.zeros(n, dtype=np.int64) for name in ("kids", "leaves", "saved")}
    else:
        convs = None
        sizes = np.concatenate([b.column(b.schema.get_field_index("at")).value_lengths().to_numpy() for b in batches])
        entries = {"row": np.repeat(np.arange(n), sizes), "depth": _lists(batches, "at")}
        entries |= {name: _lists(batches, name) for name in _SUMS}
    return Block(paths, _lists(batches, "words"), entries, convs)


def _peel(first: bool, last: bool, block_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        at = 0
        for i, path in enumerate(batch.column(batch.schema.get_field_index("path")).to_pylist()):
            if not last and (rows >= block_rows or size >= BLOCK_BYTES and rows >= LEAST_ROWS):
                yield from _block([*held, batch.slice(at, i - at)], first).peel(False)
                held, at, rows, size = [], i, 0, 0
            rows, size = rows + 1, size + len(path) + TURN
        held.append(batch.slice(at))
    if rows:
        yield from _block(held, first).peel(last)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key of its parts, which come sorted by key and place."""
    key, h = None, None
    out: list[tuple[bytes, str]] = []
    for batch in batches:
        for k, joined in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != key:
                if h:
                    out.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256(joined)
            else:
                h.update(b",")
                h.update(joined)
        if len(out) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])],
                                             names=["key", "digest"])
            out = []
    if h:
        out.append((key, h.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])],
                                         names=["key", "digest"])


def paths(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv`` and its ``turns`` in order, each a
    struct (turn, sig, words): ``sig`` names role and text, ``words`` counts
    the text's words. Turns are ordered by number, null first, equal numbers by
    ``sig``. Null roles and texts are empty; rows without a conversation belong
    to none and are left out."""
    binary = [F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary") for c in (role_col, text_col)]
    named = F.concat(F.octet_length(binary[0]).cast("string").cast("binary"), F.lit(":").cast("binary"), *binary)
    sig = F.unhex(F.substring(F.sha2(named, 256), 1, 2 * TURN))
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    rows = convs.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        sig.alias("sig"), words.cast("int").alias("words")).filter("conv IS NOT NULL")
    return rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("turn", "sig", "words"))).alias("turns"))


def graft(convs: DataFrame, every: int, head: Column) -> DataFrame:
    """Conversations (conv, turns) rebuilt: the first ``head`` (0 to 3) turns
    of conversation ``conv - conv % every`` (all if fewer, none if there is no
    such one), then the own turns after the first ``head``."""
    heads = convs.filter(F.col("conv") % every == 0).select(
        F.col("conv").alias("base"), F.slice("turns", 1, 3).alias("head"))
    rows = convs.withColumn("h", head).withColumn("base", F.col("conv") - F.col("conv") % every)
    own = F.filter(F.col("turns"), lambda t, i: i >= F.col("h"))
    grafted = F.filter(F.coalesce("head", F.slice("turns", 1, 0)), lambda t, i: i < F.col("h"))
    return rows.join(heads, "base", "left").select("conv", F.concat(grafted, own).alias("turns"))


def prefix_trie(convs: DataFrame, block_rows: int = BLOCK_ROWS, last_rows: int = LAST_ROWS) -> DataFrame:
    """The trie of conversations (columns ``conv``, ``turns`` as of ``paths``):
    one row per distinct sequence of first d turns, from the root (d = 0) on:
    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (root:
    null), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes
    below or the node itself), ``saved_tokens`` (over the nodes below and the
    node: members less one, times the words of its last turn) and
    ``ends_sha256`` (of the decimal ids of the members that end here, rising,
    joined by commas).

    No conversations give no rows, not even a root; conversations without turns
    are members of the root alone; repeated conversations share all nodes.
    A conversation is one row (20 bytes a turn): memory follows the longest.
    The members that end in one node are hashed in order as a stream, because a
    digest can't be split, from joined stretches of up to a block's rows.
    """
    spark = convs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = convs.select("conv", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["sig"])), "")).alias("path"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))
    done = [written(rows.repartitionByRange(parts, "path", "conv").sortWithinPartitions("path", "conv")
                    .mapInArrow(lambda it: _peel(True, False, block_rows, it), _KINDS), "trie")]
    kept = ["path", "words", *_ENTRIES]
    last = False
    while not last:
        left = done[-1].filter(F.col("kind") == _LEFT).select(*kept)
        count, size = left.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
        if not count:
            break
        last = count <= last_rows and size <= BLOCK_BYTES or count <= LEAST_ROWS  # so few may have long paths
        if last:
            dealt = left.coalesce(1)
        else:  # two survivors of each task's blocks at most, so their number shrinks
            dealt = left.repartitionByRange(int(max(1, min(parts, 4 * count // last_rows))), "path")
        done.append(written(dealt.sortWithinPartitions("path").mapInArrow(
            lambda it, end=last: _peel(False, end, block_rows, it), _KINDS), "trie"))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    early = done[0].filter(F.col("kind") == _NODE).select(*columns, "parent")
    if len(done) == 1:
        return early.select(*columns)
    digests = (done[0].filter(F.col("kind") == _ENDS).select("key", "conv_id", "joined")
               .repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digests, "key binary, digest string"))
    late = done[1]
    for more in done[2:]:
        late = late.unionAll(more)
    late = late.filter(F.col("kind") == _NODE)
    named = late.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(EMPTY)))
    nodes = early.unionAll(named.select(*columns, "parent"))
    found = late.select(F.col("key").alias("parent"), F.col("conv_id").alias("found"))
    waiting = nodes.filter("parent IS NOT NULL").join(found, "parent", "left").withColumn("parent_conv_id", F.col("found"))
    return nodes.filter("parent IS NULL").select(*columns).unionAll(waiting.select(*columns))


def conversation_trie(convs: DataFrame, every: int = 20, **limits: int) -> DataFrame:
    """The trie of conversations that branch: each takes its first h turns
    from the conversation ``every`` divides, h = crc32(decimal id) % 4."""
    turns = written(paths(convs), "turns")
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie(graft(turns, every, head), **limits)
