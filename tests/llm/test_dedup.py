import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from daybook.llm import substring_dedup, suffix_dedup
from daybook.llm.common import PrefixHash, byte_values
from daybook.llm.windows import RangeMin, mark
from tests.llm.helpers import SF, docs, edge_rows, have_tables, prose, table_docs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_expected(rows, size=50):
    """Brute force: every window of every text."""
    seen = {}
    parsed = [(i, WORD.findall((t or "").encode())) for i, t in rows]
    rank = lambda i: (i is None, i or 0)
    for i, w in parsed:
        for p in range(len(w) - size + 1):
            k = tuple(w[p:p + size])
            seen[k] = min(seen.get(k, rank(i)), rank(i))
    out = []
    for i, w in parsed:
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if seen[tuple(w[p:p + size])] < rank(i):
                gone[p:p + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append(str((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def bytes_expected(rows, size=200):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + size] for _, b in data for p in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p:p + size]] > 1:
                gone[p:p + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append(str((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def words_got(df):
    return sorted(str((r.id, r.n_words, r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest())) for r in df.collect())


def bytes_got(df):
    return sorted(str((r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()))
                  for r in df.collect())


def planted(seed, n=60):
    """Texts that share passages at many places and lengths, runs of one word
    and of few, and copies with single edits."""
    rng = random.Random(seed)
    passages = [prose(100 + k, rng.choice([30, 49, 50, 51, 60, 75, 120])) for k in range(8)]
    rows = []
    for i in range(n):
        parts = [prose(seed * 1000 + i, rng.randint(0, 70))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), prose(seed * 7000 + i * 9 + len(parts), rng.randint(0, 9))]
        if rng.random() < 0.2:
            parts.append("The " * rng.randint(40, 130))
        if rng.random() < 0.2:
            parts.append("ab cd ab ef " * rng.randint(10, 40))
        text = rng.choice([" ", "\n", "  "]).join(parts)
        if rows and rng.random() < 0.2:
            w = rng.choice(rows)[1].split(" ")
            w[rng.randrange(len(w))] = "edit"
            text = " ".join(w)
        rows.append((rng.randrange(40), text))  # ids repeat
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_planted_words(spark, seed):
    rows = planted(seed)
    assert words_got(substring_dedup.remove_repeats(docs(spark, rows))) == words_expected(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_planted_bytes(spark, seed):
    rows = planted(seed)
    assert bytes_got(suffix_dedup.remove_repeats(docs(spark, rows))) == bytes_expected(rows)


def test_edges(spark):
    rows = edge_rows()
    assert words_got(substring_dedup.remove_repeats(docs(spark, rows))) == words_expected(rows)
    assert bytes_got(suffix_dedup.remove_repeats(docs(spark, rows))) == bytes_expected(rows)
    assert substring_dedup.remove_repeats(docs(spark, [])).count() == 0
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_other_sizes(spark):
    rows = planted(9, 30)
    assert words_got(substring_dedup.remove_repeats(docs(spark, rows), size=12)) == words_expected(rows, 12)
    assert bytes_got(suffix_dedup.remove_repeats(docs(spark, rows), size=64)) == bytes_expected(rows, 64)


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_queries_match_brute_force(spark):
    from daybook.llm.queries import op2_substring_dedup, op4_suffix_array_dedup
    rows = [(r.doc_id, r.text) for r in table_docs(spark).collect()]
    out = [str((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)) for r in op2_substring_dedup(spark, SF).collect()]
    assert sorted(out) == words_expected(rows)
    out = [str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
           for r in op4_suffix_array_dedup(spark, SF).collect()]
    assert sorted(out) == bytes_expected(rows)


def test_dedup_documents_cuts_only_repeats(spark):
    shared = prose(50, 70)
    rows = [(1, f"start\n{shared}  end"), (2, f"other words\n {shared}\tand  then"), (3, "left  as \n it was"), (4, None),
            (5, shared)]
    table = docs(spark, rows)
    out = substring_dedup.dedup_documents(table)
    assert out.dtypes == table.dtypes
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: rows[0][1], 2: "other words\n and  then", 3: "left  as \n it was", 4: None, 5: ""}


def test_anchors_are_the_same_wherever_a_window_stands():
    rng = random.Random(8)
    for _ in range(30):
        window = " ".join(rng.choice(["x", "y", "zz", "w1", "w2", "w3"]) for _ in range(rng.randint(50, 90)))
        texts = [f"{prose(rng.randrange(999), rng.randint(0, 9), 9)} {window} {prose(rng.randrange(999), rng.randint(0, 9), 9)}"
                 .strip().encode() for _ in range(3)] + [window.encode()]
        for scan, size in ((substring_dedup.scan_words, 50), (suffix_dedup.scan_bytes, 90)):
            names = {}
            for t in texts:
                found = scan([t], size)
                blocks = found.divide(found.groups, found.block)
                single, of_blocks = found.divide(found.groups, 1), found.divide(blocks, 1)
                assert single.first.tolist() == single.last.tolist() and single.s.tolist() == of_blocks.s.tolist()
                assert sorted(single.first.tolist()) == sorted(of_blocks.first.tolist())
                g = found.groups
                parent = np.repeat(np.arange(len(g)), g.last - g.first + 1)
                block = np.repeat(np.arange(len(blocks)), blocks.last - blocks.first + 1)
                content = found.of(single.first, single.first + size)
                for k, w in enumerate(content.tolist()):
                    names.setdefault(w, set()).add((int(g.c[parent[k]]), int(blocks.c[block[k]]), int(single.s[k])))
            assert names and all(len(c) == 1 for c in names.values())


def test_suffix_sort_matches_python():
    rng = random.Random(6)
    for alphabet, n in ((2, 300), (4, 500), (1, 80)):
        buf = np.array([rng.randrange(alphabet) + 65 for _ in range(n)], dtype=np.uint8)
        raw = buf.tobytes()
        start = np.array(sorted(rng.sample(range(n), n // 2)))
        end = np.minimum(start + np.array([rng.randrange(1, 60) for _ in start]), n)
        order = suffix_dedup.Suffixes(buf, PrefixHash(byte_values(buf))).sort(start, end)
        got = [raw[start[i]:end[i]] for i in order]
        assert sorted(order.tolist()) == list(range(len(start))) and got == sorted(got)


def test_range_minimum_takes_the_first_of_equals():
    rng = random.Random(2)
    v = np.array([rng.randrange(6) for _ in range(200)], dtype=np.uint64)
    lo = np.array([rng.randrange(199) for _ in range(400)])
    hi = np.minimum(lo + np.array([rng.randint(1, 50) for _ in lo]), 200)
    assert RangeMin(v, 50).of(lo, hi).tolist() == [int(a + np.argmin(v[a:b])) for a, b in zip(lo, hi)]


def test_a_collision_of_names_is_found():
    buf = np.frombuffer(b"abcdabce", dtype=np.uint8)
    hashed = PrefixHash(byte_values(buf))
    start, end = np.array([0, 4]), np.array([4, 8])
    suffix_dedup._verify(buf, hashed, start, end, np.array([1, 2], dtype=np.uint64))
    with pytest.raises(ValueError):
        suffix_dedup._verify(buf, hashed, start, end, np.array([1, 1], dtype=np.uint64))


def shared_ids(n=3000):
    """Many rows without an id and many of one id, some with a passage of
    another row."""
    rng = random.Random(12)
    passages = [prose(500 + k, 60) for k in range(9)]
    rows = [(1, passages[0]), (3, passages[1]), (9, passages[2]), (None, None), (None, "")]
    for i in range(n):
        text = prose(20_000 + i, rng.randint(55, 75))
        if rng.random() < 0.2:
            text += " " + rng.choice(passages) + " " + prose(40_000 + i, 3)
        rows.append((rng.choice([None, None, 5]), text))
    return rows + [(None, rows[10][1]), (5, rows[11][1]), (2, rows[12][1])]


def test_thousands_of_rows_share_an_id_or_have_none(spark):
    rows = shared_ids()
    assert words_got(substring_dedup.remove_repeats(docs(spark, rows))) == words_expected(rows)
    assert bytes_got(suffix_dedup.remove_repeats(docs(spark, rows))) == bytes_expected(rows)


@pytest.mark.parametrize("scan, earlier", [(substring_dedup.scan_words, True), (suffix_dedup.scan_bytes, False)])
def test_lists_hold_names_of_their_own_text_only(spark, scan, earlier):
    rows = [((1 << 63) - 1 if i is None else i, (t or "").encode()) for i, t in shared_ids(1500)]
    marked = mark(spark.createDataFrame(rows, "doc long, data binary"), scan, earlier)
    some = 0
    for r in marked.collect():
        g = scan([bytes(r.data)]).groups
        own = set(g.s.view(np.int64).tolist())
        assert set(r.gone_groups or []) <= own and set(r.groups or []) <= own
        some += len(r.gone_groups or [])
    assert marked.count() == len(rows) and some > 0


def test_windows_that_share_a_polynomial_hash_have_different_names():
    """The Thue-Morse sequence and its complement collide modulo 2**64,
    whatever the base; ``c`` is the same then, ``s`` must not be."""
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = (" ".join("xy"[s ^ flip] for s in signs).encode() for flip in (0, 1))
    plain_a, plain_b = a.replace(b" ", b""), b.replace(b" ", b"")
    for scan, x, y in ((substring_dedup.scan_words, a, b), (suffix_dedup.scan_bytes, plain_a, plain_b)):
        found = scan([x, y], 1024)
        g = found.groups
        assert len(g) == 2
        assert found.of(g.first[:1], g.first[:1] + 1024) == found.of(g.first[1:], g.first[1:] + 1024)
        g.anchor = g.first.copy()  # at one distance
        single = found.divide(g, 1)
        assert single.c[0] == single.c[1] and single.s[0] != single.s[1]
