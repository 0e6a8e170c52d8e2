"""The pipeline stage by stage, and the registration of its queries."""

import __spark_entry__
import corpus_pipeline
from guestlens.llm import bayes_dedup, decontaminate, divergence_rules, line_join
from guestlens.llm.frames import table


def test_stages_do_what_their_operators_decide(spark, tiny):
    docs = table(spark, tiny, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tiny).checkpoint()
        assert after.columns == columns
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "quality rules":
            expected = {r["doc_id"] for r in divergence_rules.measured(docs).where("kept").collect()}
        elif name == "line dedup":
            gone = {r["doc_id"]: set(r["removed_lines"]) for r in line_join.line_report(docs, line_join.WORDS).collect()}
            left = {r["doc_id"]: "\n".join(x for i, x in enumerate((r["text"] or "").split("\n")) if i not in gone[r["doc_id"]]) for r in docs.collect()}
            expected = {i for i, text in left.items() if not gone[i] or text.split()}
            assert {r["doc_id"]: r["text"] or "" for r in after.collect()} == {i: left[i] for i in expected}
            assert any(gone.values())
        elif name == "near dedup":
            expected = {r["doc_id"] for r in bayes_dedup.near_duplicates(docs).where("kept").collect()}
        else:
            expected = before - {r["doc_id"] for r in decontaminate.contaminated(docs, table(spark, tiny, "benchmark")).collect()}
        assert ids == expected
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, tiny)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_every_operator_is_registered_once():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
