import random
import re

import numpy as np
import pytest
import xxhash

from daybook.llm.components import connected_components
from daybook.llm.simhash import ShardTree, Forest, distance, fingerprints_of, keep_one, links, near_duplicates, search
from tests.llm.helpers import SF, docs, edge_rows, have_tables, table_docs


def simhash(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", data)
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)) if h else 0


def components(points):
    root = {p: p for p in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(points)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in points}


def expected(rows):
    fps = [simhash(t) for _, t in rows]
    root = components(set(fps))
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(str((i, f"{f:016x}", least.get(root[f]))) for (i, _), f in zip(rows, fps))


def test_edges_match_brute_force(spark):
    rows = edge_rows()
    out = near_duplicates(docs(spark, rows)).collect()
    assert sorted(str((r.id, r.fingerprint, r.component_id)) for r in out) == expected(rows)


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op9_simhash_near_dedup
    rows = [(r.doc_id, r.text) for r in table_docs(spark).collect()]
    out = op9_simhash_near_dedup(spark, SF).collect()
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in out) == expected(rows)


def near_points(seed, n=1500):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(40)]
    out = [rng.getrandbits(64) for _ in range(n // 2)]
    while len(out) < n:
        p = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            p ^= 1 << rng.randrange(64)
        out.append(p)
    return sorted(set(out))


@pytest.mark.parametrize("shard,task_rows", [(100, 10_000), (100, 60), (10_000, 10_000)])
def test_links_connect_the_same_points_as_brute_force(spark, shard, task_rows):
    points = near_points(3)
    signed = np.array(points, dtype=np.uint64).view(np.int64).tolist()
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = links(fps, shard=shard, task_rows=task_rows)
    found = {r.vertex: r.root for r in connected_components(edges).collect()}
    want = components(points)
    classes = {}
    for p, s in zip(points, signed):
        classes.setdefault(want[p], set()).add(s)
    assert {frozenset(c) for c in classes.values()} == \
        {frozenset(x for x in signed if found.get(x, x) == r) for r in {found.get(x, x) for x in signed}}


def test_shards_cover_every_close_pair():
    points = np.array(near_points(4), dtype=np.uint64)
    tree = ShardTree(points[::3], 12)
    home = np.full(len(points), -1)
    asked = [set() for _ in points]
    for leaf, own, visit in tree.route(points, 2):
        home[own] = leaf
        for i in (*own.tolist(), *visit.tolist()):
            asked[i].add(leaf)
    assert (home >= 0).all() and tree.leaves > 4
    for i in range(len(points)):
        for j in np.flatnonzero(distance(points, points[i]) <= 2):
            assert home[j] in asked[i]


def test_search_prunes_without_losing_links():
    points = np.array(near_points(5, 700), dtype=np.uint64)
    every = np.arange(len(points))
    pruned, plain = Forest(len(points)), Forest(len(points))
    search(points, every, every, 2, pruned, block=500)
    search(points, every, every, 2, plain, block=1 << 30)
    assert pruned.root.tolist() == plain.root.tolist()


def test_keep_one_of_each_group(spark):
    rows = edge_rows()
    table = docs(spark, rows)
    out = keep_one(table)
    assert out.schema == table.schema
    kept = out.collect()
    fps = [simhash(t) for _, t in rows]
    root = components(set(fps))
    best = {}
    for (i, _), f in zip(rows, fps):
        best[root[f]] = min(best.get(root[f], (True, 0)), (i is None, i or 0))
    assert sorted((root[simhash(r.text)], r.doc_id is None, r.doc_id or 0) for r in kept) == \
        sorted((k, *v) for k, v in best.items())
    assert keep_one(docs(spark, [])).count() == 0 and near_duplicates(docs(spark, [])).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5000, 5000), (None, 7)], "a long, b long")
    out = {r.vertex: r.root for r in connected_components(edges).collect()}
    assert out == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
    assert connected_components(edges.limit(0)).count() == 0


def test_long_text_is_the_same_in_blocks():
    text = (" ".join(f"w{i % 977}x{i % 31}" for i in range(70_000))).encode()
    assert int(fingerprints_of([text])[0]) == int(fingerprints_of([b"x", text, b""])[1])
