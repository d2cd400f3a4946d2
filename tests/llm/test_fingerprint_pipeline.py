import hashlib

import pytest

from daybook.llm.fingerprint import containment, edited_fingerprints, with_sketch
from tests.llm.helpers import SF, docs, edge_rows, have_tables, prose, table_docs


def edited(rows):
    """(id, n_chars, sha256 of the edited text) where ids are distinct."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 3
        out.append(str((i, len(t), hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest())))
    return sorted(out)


def test_edges(spark):
    rows = list({i: (i, t) for i, t in edge_rows()}.values())
    out = edited_fingerprints(docs(spark, rows)).collect()
    assert sorted(str((r.id, r.n_chars, r.edited_sha256)) for r in out) == edited(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    by_id = {r.id: r for r in out}
    assert by_id[7].fingerprint == by_id[8].fingerprint != "" and by_id[2].fingerprint == ""
    assert by_id[8].near_next == 1.0 and by_id[10].near_edited > 0.6 > by_id[10].near_next


def test_repeated_rows_and_ids(spark):
    rows = edge_rows() + [(1, None)] * 3
    out = edited_fingerprints(docs(spark, rows)).collect()
    assert sorted(str(r.id) for r in out) == sorted(str(i) for i, _ in rows)
    assert edited_fingerprints(docs(spark, [])).count() == 0
    one = edited_fingerprints(docs(spark, [(5, prose(5, 90))])).first()
    assert one.near_next == 1.0


def test_sketches_estimate_containment_and_merge(spark):
    long, other = prose(1, 6000), prose(2, 3000)
    part = " ".join(long.split()[1000:2500])
    df = with_sketch(docs(spark, [(1, long), (2, part), (3, other), (4, part + " " + other)], False), "text", "s")
    s = {r.doc_id: set(r.s) for r in df.collect()}
    assert s[2] <= s[1] and not s[3] & s[1]
    assert len(s[4] ^ (s[2] | s[3])) <= 4  # the seam's shingles
    pair = df.filter("doc_id = 1").select("s").crossJoin(df.filter("doc_id = 4").select(df.s.alias("u")))
    assert pair.select(containment(pair.s, pair.u)).first()[0] == pytest.approx(1 / 3, abs=0.08)


def test_no_python_in_the_plan(spark):
    plan = edited_fingerprints(docs(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_query_matches_brute_force(spark):
    from daybook.llm.queries import op7_document_fingerprints
    rows = [(r.doc_id, r.text) for r in table_docs(spark).collect()]
    out = op7_document_fingerprints(spark, SF).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_sha256)) for r in out) == edited(rows)
    closer = sum(r.near_edited > r.near_next for r in out)
    assert closer > 0.9 * len(out)
    texts = dict(rows)
    prints = {}
    for r in out:
        prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())


@pytest.mark.skipif(not have_tables, reason="driver tables not present")
def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline
    from daybook.llm.common import table, written
    from daybook.llm.quality import quality_rules
    from daybook.llm.simhash import near_duplicates
    from tests.llm.test_dedup import WORD, words_expected
    from tests.llm.test_simhash import components, simhash

    before = table(spark, SF, "documents")
    columns = before.dtypes
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "simhash_near_dedup", "substring_dedup", "best_fit_packing"]
    first = written(stages["quality_rules"](spark, before, SF), "t1")
    flags = {r.id for r in quality_rules(before).filter("kept").collect()}
    assert first.dtypes == columns and {r.doc_id for r in first.collect()} == flags

    second = written(stages["simhash_near_dedup"](spark, first, SF), "t2")
    fps = {r.doc_id: simhash(r.text) for r in first.collect()}
    root = components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    assert second.dtypes == columns and {r.doc_id for r in second.collect()} == set(least.values())
    assert near_duplicates(second).filter("component_id <> id").count() == 0

    third = written(stages["substring_dedup"](spark, second, SF), "t3")
    assert third.dtypes == columns
    rows = [(r.doc_id, r.text) for r in second.collect()]
    after = {r.doc_id: r for r in third.collect()}
    got = []
    for i, t in rows:
        kept = WORD.findall((after[i].text or "").encode())
        n = len(WORD.findall((t or "").encode()))
        got.append(str((i, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())))
        assert after[i].n_chars == len(after[i].text or "") or after[i].text == t
    assert sorted(got) == words_expected(rows)

    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(after)


def test_pipeline_of_nothing(spark):
    import corpus_pipeline
    from daybook.llm.common import written
    now = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, "none"), name)
        assert now.count() == 0


def test_pipeline_of_odd_rows(spark):
    import corpus_pipeline
    from daybook.llm.common import written
    now = docs(spark, edge_rows() + [(None, prose(3, 300)), (50, prose(50, 300)), (50, prose(50, 300))])
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, "none"), name)
    assert {r.doc_id for r in now.select("doc_id").distinct().collect()} >= {None, 50}
