"""Byte-level BPE as a finite-state transducer.

The transducer reads a piece byte by byte. A state holds the hypotheses that
are still open: for each place where a token may have begun, how far into the
vocabulary's trie the bytes since then reach, the last token before that
place, and the tokens not yet emitted on the way to it. The last token of the
encoding of every prefix is unique: it is the one that its predecessor admits
as a neighbour. Tokens that all open hypotheses share are emitted. States and
transitions are made when first met and kept in bounded tables.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daybook.llm.common import chunks, id_and_text
from daybook.llm.pretoken import PieceTable


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = 400_000):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.max_states = max_states
        self.neighbours: dict[tuple[int, int], bool] = {}
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                if b not in self.trie[node]:
                    self.trie[node][b] = len(self.trie)
                    self.trie.append({})
                    self.token_at.append(-1)
                node = self.trie[node][b]
            self.token_at[node] = rank
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.begin = self._state(((0, -1, ()),))

    def _state(self, key: tuple) -> int:
        at = self.number.get(key)
        if at is None:
            at = self.number[key] = len(self.states)
            self.states.append(key)
        return at

    def merge(self, data: bytes) -> list[int]:
        """The merges applied one by one, lowest rank first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        while len(parts) > 1:
            best = min(((r, i) for i in range(len(parts) - 1)
                        if (r := rank(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _admits(self, last: int, token: int) -> bool:
        """Whether the merges leave these two side by side (``last`` -1: the
        token alone)."""
        key = (last, token)
        known = self.neighbours.get(key)
        if known is None:
            tokens = [token] if last < 0 else [last, token]
            if len(self.neighbours) > 4_000_000:
                self.neighbours.clear()
            known = self.neighbours[key] = self.merge(b"".join(self.bytes_of[t] for t in tokens)) == tokens
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        open_, done = [], None
        for node, last, pending in self.states[state]:
            child = self.trie[node].get(byte)
            if child is None:
                continue
            if self.trie[child]:
                open_.append((child, last, pending))
            token = self.token_at[child]
            if done is None and token >= 0 and self._admits(last, token):
                done = (0, token, (*pending, token))
        if done is None:
            raise ValueError("no token of the vocabulary ends here; single bytes are missing")
        open_.append(done)
        shared = 0
        least = min(len(p) for _, _, p in open_)
        while shared < least and len({p[shared] for _, _, p in open_}) == 1:
            shared += 1
        emitted = open_[0][2][:shared]
        return self._state(tuple((n, t, p[shared:]) for n, t, p in open_)), emitted

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [whole] if piece else []
        if len(self.states) > self.max_states:
            self._reset()
        out: list[int] = []
        state, moves = self.begin, self.moves
        for byte in piece:
            key = state << 8 | byte
            step = moves.get(key)
            if step is None:
                step = moves[key] = self._move(state, byte)
            state = step[0]
            out += step[1]
        out += self.states[state][-1][2]
        return out


class Utf8Stream:
    """UTF-8 decoding of a stream of byte blocks by a state machine: the state
    is the sequence begun but not complete (at most three bytes). Bytes that
    can't be part of a character become U+FFFD."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _open(data: bytes) -> int:
        """Length of an incomplete sequence at the end of ``data``."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b < 0x80:
                return 0
            if b >= 0xC0:
                need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4 if b < 0xF5 else 1
                return back if back < need else 0
        return 0

    def feed(self, block: bytes) -> str:
        data = self.held + block
        cut = len(data) - self._open(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Decoder:
    """Token ids to bytes, block by block."""

    def __init__(self, bytes_of: dict[int, bytes]):
        size = max(bytes_of) + 1
        words = [bytes_of.get(i, b"") for i in range(size)]
        self.flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        self.length = np.fromiter(map(len, words), dtype=np.int64, count=size)
        self.place = np.cumsum(self.length) - self.length

    def bytes_of(self, ids: np.ndarray) -> bytes:
        count = self.length[ids]
        ends = np.cumsum(count)
        if not len(ids):
            return b""
        at = np.repeat(self.place[ids] - (ends - count), count) + np.arange(int(ends[-1]))
        return self.flat[at].tobytes()

    def stream(self, ids: np.ndarray, block: int = 1 << 14) -> Iterator[tuple[bytes, str]]:
        """(bytes, text) of each block of ids; a character cut by a block's
        end comes with the next one."""
        utf8 = Utf8Stream()
        for at in range(0, len(ids), block):
            data = self.bytes_of(ids[at:at + block])
            yield data, utf8.feed(data)
        if rest := utf8.close():
            yield b"", rest


_workers: dict[str, tuple[PieceTable, Decoder]] = {}


def codec(path: str) -> tuple[PieceTable, Decoder]:
    """The encoder and decoder of a rank file, one pair per Python worker."""
    if path not in _workers:
        ranks = load_ranks(path)
        fst = Transducer(ranks)
        table = PieceTable(lambda pieces: [fst.encode(p.encode("utf-8", "surrogatepass")) for p in pieces])
        _workers[path] = table, Decoder({i: t for t, i in ranks.items()})
    return _workers[path]


def _round_trip(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, decoder = codec(path)
    for batch, texts in chunks(batches):
        ids, counts = table.ids([t.decode() for t in texts])
        ends = np.cumsum(counts)
        begins = ends - counts
        id_hash, back_hash = [], []
        for i, j in zip(begins.tolist(), ends.tolist()):
            own = ids[i:j]
            id_hash.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            digest = hashlib.sha256()
            for _, text in decoder.stream(own):
                digest.update(text.encode())
            back_hash.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hash), pa.array(back_hash)],
            names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _encode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, _ = codec(path)
    for batch, texts in chunks(batches):
        ids, counts = table.ids([t.decode() for t in texts])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "ids"])


def _decode(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, decoder = codec(path)
    for batch in batches:
        texts = ["".join(t for _, t in decoder.stream(np.asarray(x or [], dtype=np.int64)))
                 for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids)``: the token ids of every row's text by the rank file
    ``path``, without special tokens. Null text counts as empty; no shuffle."""
    return id_and_text(docs, id_col, text_col).mapInArrow(lambda it: _encode(path, it), "id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``(id, text)`` of a table ``(id, ids)``; null ids give empty text."""
    return tokens.select("id", "ids").mapInArrow(lambda it: _decode(path, it), "id long, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row: encodes the
    whole text, decodes the ids again.

    One pass without a shuffle. Null text counts as empty (no tokens). Null
    and repeated ids are kept, one row per input row; an empty table gives an
    empty result. Memory follows the longest single text.
    """
    return id_and_text(docs, id_col, text_col).mapInArrow(
        lambda it: _round_trip(path, it), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
