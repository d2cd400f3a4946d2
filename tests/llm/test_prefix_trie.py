"""The trie against a plain dictionary of prefixes."""

import collections
import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from daybook.llm.prefix_trie import conversation_trie
from tests.llm.helpers import CLASHING, SF, have_tables

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, every=20):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append((t is not None, t or 0, name, (role, text)))
    own = {c: [x[3] for x in sorted(turns)] for c, turns in convs.items()}
    paths = {}
    for c, turns in own.items():
        base = c - (c % every if c >= 0 else -(-c % every))
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = collections.defaultdict(set), collections.Counter(), collections.Counter()
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    for node, of in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(of) - 1) * len(WORD.findall(node[-1][1])) if node else 0
            leaves[node[:d]] += not kids[node]
    return sorted(str((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(kids[node]), leaves[node],
                       saved[node], hashlib.sha256(",".join(map(str, sorted(c for c in of if len(paths[c]) == len(node))))
                                                   .encode()).hexdigest())) for node, of in members.items())


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select(*COLUMNS).collect())


def made(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in [*CLASHING, "turns", "sig", "words"]])


def many():
    """A first turn that most share, hundreds of copies, long tails, ends inside others."""
    rows = []
    for c in range(700):
        size = 2 + c % 5 if c % 60 else 70 + c % 7
        for t in range(size):
            text = "common start" if t == 0 and c % 3 else f"turn {t} of {c % 11 if c % 4 else 5}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


def test_edges(spark):
    rows = [(0, 0, "user", "a b"), (0, 1, None, None), (0, None, "user", "first of all"), (1, 0, "user", "a b"), (1, 0, "user", "a b"),
            (2, 5, "", ""), (2, 5, "user", "tie"), (2, 5, "assistant", "tie"), (None, 0, "user", "nobody's"), (-3, 0, "x", "y"),
            (-40, 2, "é", "日本 🙂\x0bzwei"), (25, 0, "user", "one"), (26, None, None, "word " * 20_000), (27, 1, "us", "erx"),
            (28, 1, "user", "x")]
    assert rows_of(conversation_trie(made(spark, rows))) == brute(rows)


def test_no_conversations(spark):
    assert conversation_trie(made(spark, [])).count() == 0
    assert conversation_trie(made(spark, [(None, 1, "user", "text")])).count() == 0


def test_turnless_conversation(spark):
    rows = [(c, 0, "user", "x") for c in range(21, 29)]  # some lose their only turn and have no base
    got = conversation_trie(made(spark, rows))
    assert rows_of(got) == brute(rows)
    assert got.filter("depth = 0 AND n_convs = 8 AND n_children = 1").count() == 1


@pytest.mark.parametrize("limits", [{}, {"block_rows": 9, "last_rows": 24}, {"block_rows": 70, "last_rows": 65}])
def test_rounds_agree(spark, limits):
    """Nodes spread over many blocks and several rounds come out whole."""
    rows = many()
    assert rows_of(conversation_trie(made(spark, rows), **limits)) == brute(rows)


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op13_prefix_trie
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op13_prefix_trie(spark, SF)) == brute(rows)
