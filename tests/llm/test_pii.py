"""Base spans against the plain patterns; added spans on made texts."""

import hashlib
import re
import time

import numpy as np
import pytest

from daybook.llm import pii as P
from tests.llm.helpers import SF, docs, edge_rows, have_tables, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m.group())
        if 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


HARD = ["a@b.c@d.e f@g h@i. @j.k l@@m.n o%+p@q-.r-.s.", "1.2.3.4.5.6.7.8.9 256.1.1.1 0001.02.3.255. 1..2.3.4 1.2.3.4.5",
        "4111 1111 1111 1111 4111-1111-1111-1111-4 4111111111111111 4  111111111111111", "4111111111111112 5500000000000004x",
        "+1 (559) 555-3817 +49.30.1234567 ++1234567890 +1 2 +1(((  )))23 +123456789012345678", "é+é@é.com ü1.2.3.4日 🙂 +1 (201) 555-0100🙂",
        "x@y.com" * 50, "1.2.3." * 40, "4 " * 60, "+" * 50 + "1 23456789"]

def expected(text, *found):
    """The text, and its spans (kind, what it says)."""
    return text, P.joined([(P.KINDS.index(k), text.index(x), text.index(x) + len(x)) for k, x in found])


ADDED = [expected("write to jane.roe [at] example [dot] com today", ("email", "jane.roe [at] example [dot] com")),
         expected("call +1 (826) 555-4081 190.137.223.204 please", ("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")),
         expected("cards 4539578763621486 4485275742308327 both", ("card", "4539578763621486"), ("card", "4485275742308327")),
         expected("phone (201) 555-0123 or mail a.b@example.com", ("phone", "(201) 555-0123"), ("email", "a.b@example.com"))]


def test_base_spans_are_the_patterns():
    for text in [*HARD, *(t or "" for _, t in edge_rows()), *(a for a, _ in ADDED)]:
        assert P.base_spans(text)[0] == plain(text), text


def test_long_runs_are_linear():
    t0 = time.time()
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "4-" * 200_000, "a@" * 200_000, "[at] " * 80_000):
        spans, failed = P.base_spans(text)
        P.proposals(text, failed)
    assert time.time() - t0 < 20


def corpus():
    """Prose with personal data, and the forms that only wider patterns find."""
    rows = []
    for i in range(120):
        words = prose(i, 60).split()
        words[10:10] = [f"user{i}.x@mail{i % 9}.example.com", "and", f"{20 + i % 200}.{i}.7.{i + 1}"]
        words[30:30] = [f"+1 (2{i % 10}1) 555-{1000 + i}", "card", "4539578763621486"]
        rows.append((i, " ".join(words)))
    rows += [(200 + i, f"number 45395787636214{i:02d} of order") for i in range(40) if not P.luhn(f"45395787636214{i:02d}")]
    return rows + [(500 + i, prose(900 + i, 80) + " version 3.1.2 at noon, 12:30 at the.end") for i in range(50)]


def test_adds_what_the_base_misses(spark):
    rows = corpus() + [(1000 + i, text) for i, (text, _) in enumerate(ADDED)]
    got = {r.id: r for r in P.personal_data(docs(spark, rows)).collect()}
    for i, text in rows:
        assert got[i].base == P.joined(plain(text))
        assert set(filter(None, got[i].base.split(","))) <= set(filter(None, got[i].spans.split(",")))
    for i, (_, want) in enumerate(ADDED):
        assert got[1000 + i].spans == want
    assert all(got[i].spans == got[i].base for i, _ in corpus())  # clean texts and false cards stay alone


def test_edges(spark):
    rows = edge_rows() + [(50 + i, t) for i, t in enumerate(HARD)] + [(None, HARD[0])] * 3
    out = P.personal_data(docs(spark, rows)).collect()
    assert sorted(str((r.id, r.base, r.n_email, r.n_card)) for r in out) == sorted(
        str((i, P.joined(s), sum(x[0] == 0 for x in s), sum(x[0] == 2 for x in s))) for i, s in ((i, plain(t or "")) for i, t in rows))
    assert P.personal_data(docs(spark, [])).count() == 0
    only = P.personal_data(docs(spark, [(1, None), (2, "no data")])).collect()
    assert [r.spans for r in only] == ["", ""]


def test_estimation_finds_reliabilities():
    """Labelers of known reliability on made truth."""
    rng = np.random.default_rng(3)
    n, right = 20_000, np.array([[0.0, 1.0], [0.9, 0.95], [0.7, 0.8], [0.8, 0.9], [0.6, 0.9], [0.6, 0.7]])
    truth = rng.random(n) < 0.3
    votes = np.zeros(n, dtype=np.int64)
    for j, (no, yes) in enumerate(right):
        says = np.where(truth, rng.random(n) < yes, rng.random(n) >= no)
        silent = rng.random(n) < (1.0 if j == 0 else 0.2)
        votes += np.where(silent, 2, says) * 3 ** j
    pattern, count = np.unique(votes, return_counts=True)
    kind = np.full(len(pattern), P.CARD)
    share, reliability, likely = P.estimate(kind, pattern, count.astype(float))
    assert abs(share[P.CARD] - 0.3) < 0.05
    for j in range(1, 6):
        assert abs(reliability[P.CARD, j, 1, 1] - right[j, 1]) < 0.06 and abs(reliability[P.CARD, j, 0, 0] - right[j, 0]) < 0.06
    model = P.fit(kind, pattern, np.zeros_like(pattern), count.astype(float))
    guess = model.probability(np.full(n, P.CARD), votes, np.zeros(n, dtype=np.int64)) >= 0.5
    assert (guess == truth).mean() > 0.9


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op11_personal_data
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op11_personal_data(spark, SF).collect()
    assert len(out) == len(rows)
    for r in out:
        spans = plain(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(P.joined(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
