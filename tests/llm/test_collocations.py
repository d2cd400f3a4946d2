"""Collocations against plain counting."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from daybook.llm import collocations as C
from tests.llm.helpers import CLASHING, SF, edge_rows, have_tables, prose

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, share=50, top=2000):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        f = counts["und" if lang is None else lang]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(_LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        gone = {p[i:i + 2] for p, c in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * c >= share * f[p[i:i + 2]]}
        best = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string").select(
        "*", *[F.lit("x").alias(c) for c in [*CLASHING, "range", "blob", "a", "l", "r", "score"]])


def found(df):
    return sorted(tuple(r) for r in df.collect())


def many():
    rows = [("en", prose(s, 900, 1)) for s in range(40)] + [(None, prose(s, 200, 3) + ". New York; new York!") for s in range(30)]
    rows += [("fr", prose(99, 250, 2))] * 12
    rows += [("de", "Ein Satz mit Wörtern, é 日本 🙂\tteilt sich.\nnoch ein Satz mit Wörtern")] * 25  # copies
    rows += [("xx", "so oft " * 3000), ("", "ab ab ab " * 20), ("und", "new york " * 9), ("f r", "deux mots " * 12)]
    return rows


@pytest.mark.parametrize("range_bytes", [12 << 20, 20_000, 3000])
def test_matches_counting(spark, range_bytes):
    rows = many() + [("en", t) for _, t in edge_rows()]
    want = sorted(brute(rows))
    assert found(C.collocations(frame(spark, rows), range_bytes=range_bytes)) == want and len(want) > 1000


def test_top_and_ties(spark):
    rows = many()
    assert found(C.collocations(frame(spark, rows), top=17)) == sorted(brute(rows, top=17))
    assert found(C.collocations(frame(spark, rows), least=3, share=90)) == sorted(brute(rows, least=3, share=90))


def test_nothing_there(spark):
    assert C.collocations(frame(spark, [])).count() == 0
    assert C.collocations(frame(spark, [(None, None), ("en", ""), ("en", " . ")])).count() == 0
    assert C.collocations(frame(spark, [("en", "one two")])).count() == 0


def test_shards_of_a_long_text(monkeypatch):
    """Cutting a text into shards loses no phrase at their edges."""
    monkeypatch.setattr(C, "SHARD_WORDS", 7)
    texts = [(prose(3, 100, 3) + ". " + prose(4, 50, 3)).encode(), b"", b"a b c"]
    whole = C.union(list(C.shards(texts)))
    monkeypatch.setattr(C, "SHARD_WORDS", 1000)
    one, = C.shards(texts)
    assert whole.phrases() == one.phrases() and whole.weight.tolist() == one.weight.tolist()


def test_transducers_travel_whole():
    t, = C.shards([prose(5, 400, 4).encode()])
    for lo, hi in ((0, len(t)), (5, 60), (77, 78)):
        piece = t.take(slice(lo, hi))
        back = C.decode(piece.encode())
        assert back.phrases() == piece.phrases() and back.weight.tolist() == piece.weight.tolist()


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op12_phrase_collocations
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op12_phrase_collocations(spark, SF)) == sorted(brute(rows))
