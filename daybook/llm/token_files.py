"""Token ids in files coded with an asymmetric numeral system (range form).

One frequency table, counted over the whole corpus, serves all blocks. A
block codes the ids of consecutive documents in interleaved lanes: position
``k`` belongs to lane ``k mod lanes``, and all lanes advance together, so a
step is a handful of array operations. Blocks are independent. Each holds its
lanes' states, a checksum of its ids, and, when it is long, checkpoints (step,
place in the words, states) from which decoding can start inside it: a block
with checkpoints is read as ranges that different tasks decode, and the
checksums of the ranges are combined.

The files are Parquet: ``blocks`` (one row per block, in ascending document
order within and across files; ``points`` counts its checkpoints) and ``table``
(id, frequency).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import chunks, id_and_text, written
from daybook.llm.pretoken import library_table
from daybook.session import scratch_path

#: Frequencies sum to 2**SCALE; a state stays in [2**32, 2**64).
SCALE = 20
LOW = np.uint64(1 << 32)
_SLOT = np.uint64((1 << SCALE) - 1)
_BITS, _WORD = np.uint64(SCALE), np.uint64(32)

BLOCK_SCHEMA = ("part int, block int, before long, n_ids long, lanes int, ids_crc32 long, doc_ids array<long>, "
                "doc_sizes array<int>, words binary, states binary, "
                "points int, checkpoints array<struct<step:int,word:long,states:binary>>")


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of sum ``2**scale``, at least 1 where an id occurs (and
    for two ids at least, so that none has all)."""
    counts = np.pad(counts.astype(np.float64), (0, max(0, 2 - len(counts))))
    if (counts > 0).sum() < 2:
        counts = counts.copy()
        counts[:2] += 1e-9
    total = 1 << scale
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts / counts.sum() * total)), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    at, rest = 0, total - int(freq.sum())
    while rest:  # what rounding left or took goes to the most frequent
        i = order[at % len(order)]
        step = rest if rest > 0 else max(rest, 1 - int(freq[i]))
        if rest < 0 and freq[i] > 1:
            step = -min(-rest, int(freq[i]) // 4 + 1, int(freq[i]) - 1)
        freq[i] += step
        rest -= step
        at += 1
    if freq.max() == total:
        i, j = int(freq.argmax()), int(np.flatnonzero(counts > 0)[-1])
        j = j if j != i else (1 if i == 0 else 0)
        freq[i] -= 1
        freq[j] += 1
    return freq


@dataclass
class Table:
    """Frequencies, their running sums, and the id of every slot."""
    freq: np.ndarray

    def __post_init__(self) -> None:
        self.f = self.freq.astype(np.uint64)
        self.c = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq)


def encode_block(ids: np.ndarray, table: Table, lanes: int) -> tuple[bytes, bytes, int, list[np.ndarray]]:
    """(words, states, steps, words per step) of a block; the last step is
    filled up with the first id that has a frequency."""
    steps = -(-len(ids) // lanes)
    fill = int(np.flatnonzero(table.freq)[0])
    grid = np.full(steps * lanes, fill, dtype=np.int64)
    grid[:len(ids)] = ids
    grid = grid.reshape(steps, lanes)
    x = np.full(lanes, LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    states_at: list[np.ndarray] = [x]
    for t in range(steps - 1, -1, -1):
        f, c = table.f[grid[t]], table.c[grid[t]]
        over = x >= f << np.uint64(64 - SCALE)
        words.append(x[over].astype(np.uint32))  # the low word
        x = np.where(over, x >> _WORD, x)
        q = x // f
        x = (q << _BITS) + c + (x - q * f)
        states_at.append(x)
    words.reverse()
    states_at.reverse()  # states_at[t]: before step t is decoded
    return (b"".join(w.astype("<u4").tobytes() for w in words), x.astype("<u8").tobytes(), steps,
            [np.array([len(w) for w in words], dtype=np.int64), *states_at])


def decode_steps(words: np.ndarray, states: np.ndarray, table: Table, steps: int) -> np.ndarray:
    """The ids of ``steps`` steps from the given states and words."""
    x = states.astype(np.uint64)
    out = np.empty((steps, len(x)), dtype=np.int32)
    at = 0
    for t in range(steps):
        slot = x & _SLOT
        s = table.slot[slot]
        out[t] = s
        x = table.f[s] * (x >> _BITS) + slot - table.c[s]
        under = x < LOW
        n = int(np.count_nonzero(under))
        if n:
            if at + n > len(words):
                raise ValueError("checksum not reached: the words run out")
            x[under] = (x[under] << _WORD) | words[at:at + n]
            at += n
    return out


def decode_block(row: dict, table: Table, first: int = 0) -> np.ndarray:
    """The ids of a block, or those from checkpoint ``first`` on."""
    words = np.frombuffer(row["words"], dtype="<u4").astype(np.uint64)
    steps = -(-row["n_ids"] // row["lanes"])
    step, word, states = 0, 0, row["states"]
    if first:
        point = row["checkpoints"][first - 1]
        step, word, states = point["step"], point["word"], point["states"]
    ids = decode_steps(words[word:], np.frombuffer(states, dtype="<u8"), table, steps - step)
    return ids.reshape(-1)[:row["n_ids"] - step * row["lanes"]]


def _tokenise(path: str, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = library_table(path)
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch, texts in chunks(batches):
        ids, counts = table.ids([t.decode() for t in texts])
        ends = np.cumsum(counts)
        # 16-bit ids while the vocabulary allows, a byte tells the width
        packed = []
        for i, j in zip((ends - counts).tolist(), ends.tolist()):
            own = np.append(ids[i:j], end_id)
            wide = int(own.max()) > 0xFFFF
            packed.append((b"\x04" if wide else b"\x02") + pack(own.astype("<u4" if wide else "<u2").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "ids"])


def unpack(packed: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(packed[1:])
    return np.frombuffer(raw, dtype="<u4" if packed[0] == 4 else "<u2")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            ids = unpack(packed)
            if len(ids) and int(ids.max()) >= len(total):
                total = np.pad(total, (0, int(ids.max()) + 1 - len(total)))
            total += np.bincount(ids, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["token", "n"])


def _blocks(freq: np.ndarray, lanes: int, block_ids: int, every: int,
            batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Table(freq)
    part = TaskContext.get().partitionId()
    number, before = 0, 0
    names = [x.strip().split()[0] for x in BLOCK_SCHEMA.replace("step:int,word:long,states:binary", "").split(",")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
             pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int32(),
             pa.list_(pa.struct([("step", pa.int32()), ("word", pa.int64()), ("states", pa.binary())]))]

    def block(docs: list[int | None], held: list[np.ndarray]) -> pa.RecordBatch:
        nonlocal number, before
        ids = np.concatenate(held)
        width = min(lanes, max(1, len(ids) // 64))
        words, states, steps, (per_step, *at) = encode_block(ids, table, width)
        sums = np.cumsum(per_step)
        points = [{"step": s, "word": int(sums[s - 1]), "states": at[s].astype("<u8").tobytes()}
                  for s in range(every, steps, every)]
        row = (part, number, before, len(ids), width, zlib.crc32(ids.astype("<u4").tobytes()), docs,
               [len(x) for x in held], words, states, len(points), points)
        number += 1
        before += len(ids)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    docs: list[int | None] = []
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for doc, packed in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
            ids = unpack(packed)
            if held and size + len(ids) > block_ids:
                yield block(docs, held)
                docs, held, size = [], [], 0
            docs.append(doc)
            held.append(ids)
            size += len(ids)
    if held:
        yield block(docs, held)


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int = 0, lanes: int = 512,
                 block_ids: int = 1 << 17, every: int = 256, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, each followed by ``end_id``, under
    ``out`` in ascending id order (nulls last; rows of the same id by the hash
    of their ids).

    Null text counts as empty. An empty table gives a table file and no
    blocks. The text is read and encoded once; its packed ids are staged in
    the shared folder, counted there (the driver gets one row per id of the
    vocabulary), dealt to ranges of (id, hash) and coded. A block ends with a
    document; one document alone may be longer than ``block_ids`` and then has
    checkpoints every ``every`` steps.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    staged = written(rows.mapInArrow(lambda it: _tokenise(path, end_id, it), "id long, ids binary"), "token-ids")
    counted = staged.select("ids").mapInArrow(_count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    found = counted.collect()
    counts = np.zeros(max([1, *(r.token for r in found)]) + 1, dtype=np.int64)
    for r in found:
        counts[r.token] = r.n
    freq = scaled(counts)
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(freq)], "token int, frequency int").coalesce(1) \
        .write.parquet(f"{out}/table")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("ids").asc()]
    ranged = staged.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(lambda it: _blocks(freq, lanes, block_ids, every, it), BLOCK_SCHEMA).write.parquet(f"{out}/blocks")


def _read(freq: np.ndarray, base: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = Table(freq)
    for batch in batches:
        ids, starts, sizes, sums = [], [], [], []
        for row in batch.to_pylist():
            tokens = decode_block(row, table)
            if zlib.crc32(tokens.astype("<u4").tobytes()) != row["ids_crc32"]:
                raise ValueError(f"checksum of block {row['part']}/{row['block']} differs")
            at = 0
            for doc, n in zip(row["doc_ids"], row["doc_sizes"]):
                ids.append(doc)
                starts.append(base[row["part"]] + row["before"] + at)
                sizes.append(n)
                sums.append(zlib.crc32(tokens[at:at + n].astype("<u4").tobytes()))
                at += n
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, starts, sizes, sums)],
                                         names=["id", "start", "n_tokens", "ids_crc32"])


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of the checksum, over bits in
    reverse order (the highest bit is 1)."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, n_bytes: int) -> int:
    """Checksum (crc32) of two byte strings one after the other, from theirs
    and the length of the second."""
    shift, square, n = 1 << 31, 1 << 30, 8 * n_bytes
    while n:
        if n & 1:
            shift = _times(shift, square)
        square = _times(square, square)
        n >>= 1
    return _times(shift, first) ^ second


RANGE_SCHEMA = "part int, block int, k int, first long, n_ids long, steps int, words binary, states binary, cuts array<long>"


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's ranges, from one checkpoint up to the next, each with its
    words; ``first`` is the place of its first id in the block, ``cuts`` are
    the places where pieces of documents start and end."""
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(),
             pa.list_(pa.int64())]
    names = [x.split()[0] for x in RANGE_SCHEMA.split(", ")]
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            words, lanes, n = memoryview(row["words"]), row["lanes"], row["n_ids"]
            starts = [(0, 0, row["states"])] + [(p["step"], p["word"], p["states"]) for p in row["checkpoints"]]
            bounds = np.cumsum(np.array(row["doc_sizes"], dtype=np.int64))
            ends = [(step, word) for step, word, _ in starts[1:]] + [(-(-n // lanes), len(words) // 4)]
            for k, ((step, word, states), (stop, until)) in enumerate(zip(starts, ends)):
                first, end = step * lanes, min(n, stop * lanes)
                inside = bounds[np.searchsorted(bounds, first, "right"):np.searchsorted(bounds, end)]
                out = (row["part"], row["block"], k, first, end - first, stop - step,
                       bytes(words[4 * word:4 * until]), states, [first, *inside.tolist(), end])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(out, kinds)], names=names)


def _read_ranges(freq: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksum of every piece of a document in a range."""
    table = Table(freq)
    for batch in batches:
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], dtype="<u4").astype(np.uint64)
            ids = decode_steps(words, np.frombuffer(row["states"], dtype="<u8"), table, row["steps"]).reshape(-1)[:row["n_ids"]]
            first, cuts = row["first"], row["cuts"]
            sums = [zlib.crc32(ids[a - first:b - first].astype("<u4").tobytes()) for a, b in zip(cuts, cuts[1:])]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()),
                 pa.array(cuts[:-1], pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(sums, pa.int64())],
                names=["part", "block", "at", "n", "crc"])


def _join_ranges(base: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a block from the checksums of its pieces."""
    for batch in batches:
        for row in batch.to_pylist():
            pieces = iter(row["pieces"])
            whole, at, sums = 0, 0, []
            for size in row["doc_sizes"]:
                end, crc = at + size, 0
                while at < end:
                    p = next(pieces)
                    if p["at"] != at:
                        raise ValueError(f"a range of block {row['part']}/{row['block']} is missing")
                    crc = joined_crc(crc, p["crc"], 4 * p["n"])
                    at += p["n"]
                sums.append(crc)
                whole = joined_crc(whole, crc, 4 * size)
            if whole != row["ids_crc32"]:
                raise ValueError(f"checksum of block {row['part']}/{row['block']} differs")
            sizes = np.array(row["doc_sizes"], dtype=np.int64)
            starts = base[row["part"]] + row["before"] + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (row["doc_ids"], starts, sizes, sums)],
                                             names=["id", "start", "n_tokens", "ids_crc32"])


def _read_long(blocks: DataFrame, freq: np.ndarray, base: dict[int, int]) -> DataFrame:
    """Documents of the blocks with checkpoints. A range goes to the task of
    its number and block; the pieces' checksums of a block meet in one row
    (one piece per document and checkpoint)."""
    key = ["part", "block"]
    heads = blocks.select(*key, "before", "ids_crc32", "doc_ids", "doc_sizes")
    pieces = blocks.mapInArrow(_ranges, RANGE_SCHEMA).repartition(*key, "k").mapInArrow(
        lambda it: _read_ranges(freq, it), "part int, block int, at long, n long, crc long")
    met = pieces.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces"))
    return heads.join(met, key).mapInArrow(lambda it: _join_ranges(base, it),
                                           "id long, start long, n_tokens long, ids_crc32 long")


def read_table(spark: SparkSession, out: str) -> np.ndarray:
    rows = spark.read.parquet(f"{out}/table").collect()
    freq = np.zeros(len(rows), dtype=np.int64)
    for r in rows:
        freq[r.token] = r.frequency
    return freq


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` per document from the files under
    ``out``. A block without checkpoints is decoded by itself, one with
    checkpoints (a document longer than a block) range by range in different
    tasks; both are held against the block's checksum. The driver gets one row
    per written file."""
    freq = read_table(spark, out)
    blocks = spark.read.parquet(f"{out}/blocks")
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    base, total = {}, 0
    for r in sorted(sizes, key=lambda r: r.part):
        base[r.part] = total
        total += r.n
    short = blocks.filter("points = 0").mapInArrow(lambda it: _read(freq, base, it),
                                                   "id long, start long, n_tokens long, ids_crc32 long")
    return short.unionByName(_read_long(blocks.filter("points > 0"), freq, base))


def token_files(docs: DataFrame, path: str, end_id: int = 0, **kw) -> DataFrame:
    """Write the files to a new folder of the shared scratch space and read
    them back."""
    out = scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, out, path, end_id, **kw)
    return read_tokens(docs.sparkSession, out)
