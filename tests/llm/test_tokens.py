import hashlib
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from daybook.llm import bpe, packing, pretoken, token_files  # noqa: E402
from tests.llm.helpers import SF, docs, edge_rows, have_tables, table_docs  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(FILE)
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def oracle():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


def strings(seed, n):
    rng = random.Random(seed)
    parts = ["'s", "'t", "'re", "'ll", "'", " ", "  ", "\n", "\t", "　", "a", "the", "ing", "É", "1", "½", "23", "!", "...",
             "日本", "한국", "🙂", "абв", "<|endoftext|>", "​", "x" * 9]
    return ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


def test_pieces_match_the_pattern():
    import regex
    texts = strings(1, 4000) + ["", " ", "\n\n", "don't've I'll  'll\n's   x'"]
    pieces = pretoken.Pieces(texts)
    got = [[pieces.text(k) for k in range(pieces.first[i], pieces.first[i + 1])] for i in range(len(texts))]
    assert got == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_piece_table_matches_library_also_when_full(library):
    texts = strings(2, 1500)
    want = library(texts)
    whole = pretoken.library_table(FILE)
    for table in (whole, pretoken.WithAdded(pretoken.PieceTable(whole.table.encode, bits=4, ids=500), whole.added)):
        for _ in range(2):
            ids, counts = table.ids(texts)
            assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == list(map(len, want))


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_pieces_of_equal_polynomials_stay_apart(n, library, oracle):
    """Such words collide in every polynomial hash modulo a power of two."""
    texts = [thue_morse(n), thue_morse(n, "b", "a"), f"x {thue_morse(n)}", f"x {thue_morse(n, 'b', 'a')}"]
    want = library(texts)
    table, _ = bpe.codec(RANKS)
    for found, expected in ((pretoken.library_table(FILE).ids(texts)[0], want), (table.ids(texts)[0], [oracle.encode_ordinary(t) for t in texts])):
        assert found.tolist() == [i for x in expected for i in x]


def test_added_tokens_in_a_text(library):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext", "plain", "", " <|endoftext|>\n"]
    ids, counts = pretoken.library_table(FILE).ids(texts)
    want = library(texts)
    assert 50256 in want[0] and ids.tolist() == [i for x in want for i in x] and counts.tolist() == list(map(len, want))


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_byte_bpe_query(spark, oracle):
    from daybook.llm.queries import op6_byte_bpe
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op6_byte_bpe(spark, SF).collect()}
    for r in table_docs(spark).collect():
        ids = oracle.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
                                 hashlib.sha256((r.text or "").encode()).hexdigest())


def test_transducer_matches_library(oracle):
    texts = strings(3, 3000)
    fst = bpe.Transducer(bpe.load_ranks(RANKS), max_states=500)
    import regex
    for t in texts:
        assert [i for p in regex.findall(public_tokenizers.PATTERN, t) for i in fst.encode(p.encode())] == oracle.encode_ordinary(t)


def test_transducer_emits_before_the_end():
    """Lookahead is bounded: a long piece leaves few tokens pending."""
    fst = bpe.Transducer(bpe.load_ranks(RANKS))
    state, emitted = fst.begin, 0
    for b in ("theing" * 2000).encode():
        state, out = fst._move(state, b)
        emitted += len(out)
    assert len(fst.states[state][-1][2]) < 10 < 1000 < emitted


def test_utf8_stream_at_every_cut():
    text = "aé日🙂 é́ x"
    data = text.encode()
    for cut in range(len(data) + 1):
        for second in range(cut, len(data) + 1):
            s = bpe.Utf8Stream()
            assert s.feed(data[:cut]) + s.feed(data[cut:second]) + s.feed(data[second:]) + s.close() == text
    s = bpe.Utf8Stream()
    assert s.feed(b"\xff a\xe6") + s.close() == "� a�"


def test_round_trip_edges(spark, oracle):
    rows = edge_rows() + [(30, t) for t in strings(4, 20)]
    out = bpe.round_trip(docs(spark, rows), RANKS).collect()
    want = []
    for i, t in rows:
        ids = np.array(oracle.encode_ordinary(t or ""), dtype="<u4")
        want.append(str((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())))
    assert sorted(str(tuple(r)) for r in out) == sorted(want)
    assert bpe.round_trip(docs(spark, []), RANKS).count() == 0
    back = bpe.decode(bpe.encode(docs(spark, rows), RANKS), RANKS).collect()
    assert sorted(str(tuple(r)) for r in back) == sorted(str((i, t or "")) for i, t in rows)


def check_packing(out, rows, library, capacity=1024):
    ids = {}
    for (i, t), x in zip(rows, library([t or "" for _, t in rows])):
        ids.setdefault(i, []).append(np.array(x + [2], dtype="<u4"))
    by_sequence, total = {}, 0
    want = sorted(str((i, len(x))) for i, xs in ids.items() for x in xs)
    got = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        got.setdefault(r.id, []).append(r)
        total += r.length
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert total == sum(len(x) for xs in ids.values() for x in xs)
    for i, pieces in got.items():
        sums = sorted((r.start, r.length, r.ids_crc32) for r in pieces)
        expect = []
        for x in ids[i]:
            first = (len(x) - 1) % capacity + 1
            for a, b in zip([0, *range(first, len(x), capacity)], [*range(first, len(x) + 1, capacity)]):
                expect.append((a, b - a, zlib.crc32(x[a:b].tobytes())))
        assert sums == sorted(expect)
    assert want and len(by_sequence) >= -(-total // capacity)
    return len(by_sequence), -(-total // capacity)


def test_packing_edges(spark, library):
    rows = edge_rows()
    check_packing(packing.pack(docs(spark, rows), FILE).collect(), rows, library)
    check_packing(packing.pack(docs(spark, rows), FILE, capacity=16).collect(), rows, library, 16)
    assert packing.pack(docs(spark, []), FILE).count() == 0


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_packing_query(spark, library):
    from daybook.llm.queries import op8_best_fit_packing
    rows = [(r.doc_id, r.text) for r in table_docs(spark).collect()]
    used, least = check_packing(op8_best_fit_packing(spark, SF).withColumnRenamed("doc_id", "id").collect(), rows, library)
    assert used <= least * 1.02 + 1


def best_fit_decreasing(histogram, capacity):
    import bisect
    rooms, n = [], 0
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            at = bisect.bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else capacity
            n += room == capacity
            if room > length:
                bisect.insort(rooms, room - length)
    return n


@pytest.mark.parametrize("seed", range(4))
def test_program_against_best_fit(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 100): rng.randint(1, 400) for _ in range(rng.randint(3, 60))}
    solution = packing.solve(histogram, 100)
    packed = {}
    for filling, times in solution:
        assert sum(k * n for k, n in filling.items()) <= 100 and times > 0
        for k, n in filling.items():
            packed[k] = packed.get(k, 0) + n * times
    assert packed == histogram
    assert sum(t for _, t in solution) <= 1.01 * best_fit_decreasing(histogram, 100) + 1


def test_program_of_nothing_and_of_one():
    assert packing.solve({}, 8) == []
    assert packing.solve({8: 5}, 8) == [({8: 1}, 5)]


def test_a_length_that_most_pieces_share(spark, library):
    rows = [(i, "same text here") for i in range(3000)]
    used, least = check_packing(packing.pack(docs(spark, rows, False).repartition(7), FILE).collect(), rows, library)
    assert used <= least + 1


@pytest.mark.parametrize("lanes,n", [(1, 1), (1, 50), (4, 3), (8, 1000), (64, 5000)])
def test_blocks_round_trip(lanes, n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n), 60_000).astype(np.int64)
    table = token_files.Table(token_files.scaled(np.bincount(ids, minlength=50_257)))
    words, states, steps, (per_step, *at) = token_files.encode_block(ids, table, lanes)
    points = [{"step": s, "word": int(per_step[:s].sum()), "states": at[s].astype("<u8").tobytes()} for s in range(3, steps, 3)]
    row = {"words": words, "states": states, "n_ids": n, "lanes": lanes, "checkpoints": points}
    assert token_files.decode_block(row, table).tolist() == ids.tolist()
    for k, p in enumerate(points, 1):
        assert token_files.decode_block(row, table, k).tolist() == ids[p["step"] * lanes:].tolist()


@pytest.mark.parametrize("counts", [[5], [0, 7], [1, 1], [10 ** 12, 1, 0, 1], list(range(3000)), [1] * 60_000])
def test_frequencies(counts):
    freq = token_files.scaled(np.array(counts))
    assert freq.sum() == 1 << token_files.SCALE and freq.max() < 1 << token_files.SCALE
    assert all(f > 0 for f, c in zip(freq, counts) if c)


def token_rows(rows, library):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    encoded = library([t or "" for _, t in rows])
    return [(rows[k][0], np.array(encoded[k] + [0], dtype="<u4")) for k in order]


def test_token_files_edges(spark, library):
    rows = edge_rows()
    out = token_files.token_files(docs(spark, rows), FILE, block_ids=300, lanes=16, every=8).collect()
    want = token_rows(rows, library)
    out.sort(key=lambda r: r.start)
    assert [r.id for r in out] == [i for i, _ in want]
    start, sums = 0, []
    for r in out:
        assert r.start == start
        start += r.n_tokens
    assert sorted(str((r.id, r.n_tokens, r.ids_crc32)) for r in out) == \
        sorted(str((i, len(x), zlib.crc32(x.tobytes()))) for i, x in want)
    assert token_files.token_files(docs(spark, []), FILE).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_joined_checksums(n):
    a, b = b"some bytes", bytes(range(256)) * 4
    assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b[:n]), n) == zlib.crc32(a + b[:n])
    assert token_files.joined_crc(0, zlib.crc32(a), len(a)) == zlib.crc32(a)


def test_a_long_document_is_decoded_in_ranges(spark, library):
    """One document of many blocks among short ones: its ranges are rows of
    their own, and documents that meet in a block with checkpoints are told
    apart; a damaged range is noticed."""
    from pyspark.sql import functions as F

    from daybook.session import scratch_path
    rows = [(i, f"short text {i}") for i in range(50)] + [(20, "many words of one long text " * 4000)]
    want = {(i, len(x), zlib.crc32(x.tobytes())) for i, x in token_rows(rows, library)}
    for lanes, block_ids, every in ((16, 500, 8), (4, 1 << 17, 5)):
        out, bad = scratch_path(spark, "t"), scratch_path(spark, "t")
        token_files.write_tokens(docs(spark, rows, False), out, FILE, lanes=lanes, block_ids=block_ids, every=every)
        blocks = spark.read.parquet(f"{out}/blocks")
        assert blocks.agg(F.max("points")).first()[0] > 100
        found = token_files.read_tokens(spark, out).collect()
        assert {(r.id, r.n_tokens, r.ids_crc32) for r in found} == want and len(found) == len(rows)
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        spark.read.parquet(f"{out}/table").write.parquet(f"{bad}/table")
        shifted = F.expr("transform(checkpoints, c -> named_struct('step', c.step, 'word', c.word + 1, 'states', c.states))")
        blocks.withColumn("checkpoints", shifted).write.parquet(f"{bad}/blocks")
        with pytest.raises(Exception, match="checksum"):
            token_files.read_tokens(spark, bad).collect()


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_token_files_query(spark, library):
    from daybook.llm.queries import op10_token_files
    rows = [(r.doc_id, r.text) for r in table_docs(spark).collect()]
    start, want = 0, []
    for i, x in token_rows(rows, library):
        want.append((i, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert sorted(tuple(r) for r in op10_token_files(spark, SF).collect()) == sorted(want)


def test_damaged_block_is_noticed(spark):
    from pyspark.sql import functions as F

    from daybook.session import scratch_path
    out, bad = scratch_path(spark, "t"), scratch_path(spark, "t")
    token_files.write_tokens(docs(spark, [(1, "some text that is long enough to be coded in words")] * 40), out, FILE, lanes=2)
    spark.read.parquet(f"{out}/table").write.parquet(f"{bad}/table")
    spark.read.parquet(f"{out}/blocks").withColumn("ids_crc32", F.col("ids_crc32") + 1).write.parquet(f"{bad}/blocks")
    assert token_files.read_tokens(spark, out).count() == 40
    with pytest.raises(Exception, match="checksum"):
        token_files.read_tokens(spark, bad).collect()
