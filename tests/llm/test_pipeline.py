"""The pipeline's stages against plain versions on the small tables."""

from collections import Counter

import corpus_pipeline
from conftest import SF
from test_text_operators import links_by_hand, rules_by_hand

from millrace.llm.shared import table


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept, columns = [docs], docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert kept[-1].columns == columns
    start, ruled, single, clean, masked, mixed = [d.collect() for d in kept]

    counts = {r["doc_id"]: rules_by_hand(r["text"]) for r in start}
    base = {i for i, c in counts.items() if not (c[0] < 20 or 100 * c[4] > 30 * c[0])}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    ids = {r["doc_id"] for r in ruled}
    assert ids <= base and all(i in ids for i in base if labels.get(i) == 1)

    ruled.sort(key=lambda r: r["doc_id"])
    _, label = links_by_hand([r["text"] for r in ruled])
    assert sorted(r["doc_id"] for r in single) == [ruled[k]["doc_id"] for k in range(len(ruled)) if label[k] == k]

    items = [" ".join(r["text"].lower().split()) for r in table(spark, SF, "benchmark").collect()]
    leaks = {r["doc_id"] for r in single if any(x in " ".join(r["text"].lower().split()) for x in items)}
    gone = {r["doc_id"] for r in single} - {r["doc_id"] for r in clean}
    assert leaks <= gone and len(gone) <= len(leaks) + 2

    from millrace.llm import privacy

    before, after = {r["doc_id"]: r for r in clean}, {r["doc_id"]: r for r in masked}
    assert set(before) == set(after)
    for i, r in after.items():
        assert privacy.rule_spans(r["text"]) == [] and r["n_chars"] == (len(r["text"]) if r["text"] != before[i]["text"] else before[i]["n_chars"])

    assert {r["doc_id"] for r in mixed} <= set(after) and max(Counter((r["doc_id"], r["pass"]) for r in mixed).values()) == 1
    assert all(r["text"] == after[r["doc_id"]]["text"] for r in mixed)


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "personal data", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None
