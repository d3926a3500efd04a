"""The pipeline stage by stage against brute force, and the registered queries' SQL."""

import brute as B
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
import oracle_harness as H
from conftest import SF001, SF0001
from loadshift.llm import common as C
from loadshift.llm import op3_quality
from loadshift.llm.queries import ORACLE, QUERIES


def test_registered():
    numbers = sorted(int(q[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in E.queries()
    assert [n for n, _ in P.STAGES] == ["quality_rules", "jaccard_join", "decontamination", "secret_scan", "mixing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = H.compare(QUERIES[name](spark, SF001), H.duck(SF001), ORACLE[name])
    assert ok, msg


def test_stages(spark):
    docs = C.table(spark, SF0001, "documents")
    columns = docs.columns
    before = {x.doc_id: x for x in docs.collect()}

    step = C.materialise(P.quality_rules(spark, docs, SF0001), "t3")
    assert step.columns == columns
    after = {x.doc_id: x for x in step.collect()}
    rules = op3_quality.LineRules()
    for i, x in before.items():
        verdict = op3_quality.judge_text(x.text, rules)
        assert (i in after) == (not B.quality(x.text)[-1] and verdict[6])
        if i in after:
            assert after[i].text == verdict[-1] and after[i].n_chars == len(verdict[-1])

    before, step = after, C.materialise(P.jaccard_join(spark, step, SF0001), "t7")
    after = {x.doc_id: x for x in step.collect()}
    roots = B.jaccard_components({i: [x.text] for i, x in before.items()})
    assert step.columns == columns and set(after) == set(roots.values())

    before, step = after, C.materialise(P.decontamination(spark, step, SF0001), "t5")
    after = {x.doc_id: x for x in step.collect()}
    items = [(x.item_id, x.text) for x in C.table(spark, SF0001, "benchmark").collect()]
    found = B.contamination([x.text for x in before.values()], items)
    assert step.columns == columns
    assert set(after) == {i for i, c in zip(before, found) if not c[-1]}

    before, step = after, C.materialise(P.secret_scan(spark, step, SF0001), "t6")
    after = {x.doc_id: x for x in step.collect()}
    assert step.columns == columns and set(after) == set(before)
    for i, x in before.items():
        if not B.secrets(x.text):
            assert after[i] == x
        assert after[i].n_chars == len(after[i].text)

    out = P.mixing(spark, step, SF0001).collect()
    assert {x.doc_id for x in out} <= set(after) and len(out) > 0.8 * len(after)
    assert all(x.text == after[x.doc_id].text for x in out)


def test_run_over_empty_documents(spark, out_dir):
    docs = C.table(spark, SF0001, "documents").where("doc_id < 0")
    docs.write.parquet(f"{out_dir}/documents.parquet")
    C.table(spark, SF0001, "benchmark").write.parquet(f"{out_dir}/benchmark.parquet")
    assert P.run(spark, out_dir).count() == 0
