import re
from collections import Counter

import pytest

from daybook.llm.quality import Bands, keep_quality, quality_rules
from tests.llm.helpers import SF, docs, edge_rows, have_tables, prose, table_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n)


def got(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_edges_match_brute_force(spark):
    rows = edge_rows()
    out = quality_rules(docs(spark, rows)).collect()
    assert sorted((r.id is None, r.id or 0, *got(r)) for r in out) == \
        sorted((i is None, i or 0, *base(t)) for i, t in rows)


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_table_matches_brute_force(spark):
    from daybook.llm.queries import op5_quality_rules
    want = {r.doc_id: base(r.text) for r in table_docs(spark).collect()}
    out = op5_quality_rules(spark, SF).collect()
    assert {r.doc_id: got(r) for r in out} == want
    assert all(not (r.kept and r.base_failed) for r in out)
    assert sum(r.kept for r in out) > 0.7 * len(out)


def test_bands_reject_repetition_and_noise_and_keep_prose(spark):
    import random
    rng = random.Random(3)
    noise = " ".join("".join(chr(rng.randrange(33, 0x2FF)) for _ in range(9)) for _ in range(400))
    loop = " ".join(f"{w} {i}" for i, w in enumerate(["alpha"] * 900))
    rows = [(1, prose(1, 600)), (2, noise), (3, loop), (4, prose(4, 40))]
    kept = {r.id: r.kept for r in quality_rules(docs(spark, rows)).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: True}


def test_keep_returns_the_same_columns(spark):
    rows = edge_rows()
    table = docs(spark, rows)
    flags = quality_rules(table).filter("kept").count()
    out = keep_quality(table)
    assert out.schema == table.schema and out.count() == flags
    assert keep_quality(docs(spark, [])).count() == 0 and quality_rules(docs(spark, [])).count() == 0


def test_limits_are_parameters(spark):
    strict = Bands(whole=((0, 0.0, 0.0),))
    assert quality_rules(docs(spark, [(1, prose(1, 600))]), bands=strict).first().kept is False


def _noise(seed, size):
    import base64
    import random
    return base64.b64encode(random.Random(seed).randbytes(size))[:size].decode()


def test_noise_only_in_the_last_partial_chunk_is_rejected(spark):
    clean = prose(1, 3000, 30)
    rows = [(k, clean[:4096] + _noise(k, size)) for k, size in enumerate((2000, 2250, 2500, 2750, 3000))]
    rows += [(10 + k, clean[:4096 + size]) for k, size in enumerate((1, 63, 64, 127, 128, 1000, 4000))]
    out = {r.id: r for r in quality_rules(docs(spark, rows)).collect()}
    assert all(out[k].ratio < 0.63 and not out[k].base_failed and not out[k].kept for k in range(5))
    assert all(out[10 + k].kept for k in range(7))
    assert keep_quality(docs(spark, rows)).count() == 7


def test_every_byte_lies_in_a_chunk(spark):
    text = prose(2, 3000)
    rows = [(1, text[:1000]), (2, text[:4096]), (3, text[:4096] + _noise(2, 600))]
    out = {r.id: r for r in quality_rules(docs(spark, rows)).collect()}
    assert all(out[k].chunk_low == out[k].chunk_high == out[k].ratio for k in (1, 2))
    assert out[3].chunk_high > 0.76 and out[3].kept  # 600 of 4,696 bytes are less than a quarter


def test_words_of_equal_polynomials_are_different_words(spark):
    """Words that collide in a polynomial hash modulo a power of two don't
    make a window repeat."""
    odd = ["".join("ab"[(bin(i).count("1") + k) % 2] for i in range(2048)) for k in (0, 1)]
    text = f"k l m n {odd[0]} k l m n {odd[1]}"
    row = quality_rules(docs(spark, [(1, text), (2, f"k l m n {odd[0]} k l m n {odd[0]}")])).orderBy("id").collect()
    assert [r.n_repeat_words for r in row] == [0, 10]
