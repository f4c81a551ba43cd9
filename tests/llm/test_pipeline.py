from collections import Counter

import corpus_pipeline as cp
from fixtures import SF, documents, prose, shingles, similar

from tidegate.llm import language_id, queries
from tidegate.llm.common import table, written


def test_stages_work_on_what_was_kept_and_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, docs
    counts = [docs.count()]
    for name, stage in cp.STAGES[:-1]:
        before = Counter(tuple(r) for r in kept.collect())
        kept = written(stage(spark, kept, SF), f"test-{name}")
        assert kept.columns == columns
        after = Counter(tuple(r) for r in kept.collect())
        assert set(after) <= set(before)
        if name != "mixing":
            assert all(n <= before[r] for r, n in after.items())
        counts.append(sum(after.values()))
    rows = [r for r in kept.collect()]
    # no two kept documents are near copies, unless the mix repeats one
    sets = {r.doc_id: shingles(r.text) for r in rows}
    ids = sorted(sets)
    assert not [(a, b) for a in ids for b in ids if a < b and similar(sets[a], sets[b])]
    last = cp.STAGES[-1][1](spark, kept, SF)
    assert Counter(r.doc_id for r in last.collect()) == Counter(r.doc_id for r in rows)
    assert sum(r.n_tokens for r in last.collect()) > 0


def test_language_stage_rejects_only_what_has_no_language(spark):
    docs = table(spark, SF, "documents")
    odd = documents(spark, [(10**9, None), (10**9 + 1, "1234 !!"), (10**9 + 2, "")])
    kept = cp.with_a_language(spark, docs.unionByName(odd), SF)
    model = language_id.train(docs.where(~queries.held_out()))
    names, scores = language_id.predict([r.text for r in docs.select("text").collect()], model)
    want = sum(n != "und" and s >= cp.LEAST_SCORE for n, s in zip(names, scores))
    assert kept.where(f"doc_id >= {10**9}").count() == 0
    assert kept.count() == want >= 0.99 * docs.count()


def test_run_and_empty_and_odd_tables(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    empty = documents(spark, [(1, "x")]).where("doc_id < 0")
    same = "the same text over and over again, and once more"
    odd = documents(spark, [(None, None), (1, None, None, None), (2, same, None, None), (2, same, None, None), (3, "", "en", "s"), (4, prose(4, 5000), None, None)])
    for docs in (empty, odd):
        for _, stage in cp.STAGES:
            assert stage(spark, docs, SF).count() <= 3 * max(1, docs.count())
