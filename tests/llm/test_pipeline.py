"""The pipeline: order and columns of its stages, and each stage against brute force on its own input."""

import __spark_entry__ as contract
import corpus_pipeline
from marketlake.llm import langid, packing
from marketlake.llm.common import stored, table
from tests.conftest import SF_DIR
from tests.llm.test_documents import check_packing, plain_dedup
from tests.llm.test_neardup import plain_near_groups


def test_stages_by_brute_force(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    outputs = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns, name
        outputs.append(docs.collect())
    model = langid.fit(table(spark, SF_DIR, "documents"))
    kept = {d: t for d, t in kept.items() if (a := langid.identify(model, t))[0] != "und" and a[1] >= langid.LEAST_SCORE}
    assert sorted(r["doc_id"] for r in outputs[0]) == sorted(kept) and len(kept) > 190
    stays = [d for d, *_, k in plain_dedup(list(kept.items())) if k]
    assert sorted(r["doc_id"] for r in outputs[1]) == sorted(stays)
    # Near copies: the smallest doc_id of a group stays; documents without a near one all stay.
    groups = plain_near_groups({d: kept[d] for d in stays})
    assert len(set(groups.values())) < len(stays)
    stays = [d for d in stays if groups[d] == d]
    assert sorted(r["doc_id"] for r in outputs[2]) == sorted(stays)
    assert {r["doc_id"] for r in outputs[3]} <= set(stays)
    total = sum(len(kept[d].split()) for d in stays)
    assert abs(sum(len(r["text"].split()) for r in outputs[3]) - total) < 100
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).toPandas()
    check_packing(last, packing.CAPACITY)
    assert (last["piece"] == 0).sum() == len(outputs[3])


def test_run_is_registered(spark):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "source mixing", "best-fit packing"]
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_empty_documents(spark, no_docs):
    docs = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        assert out.count() == 0


def test_odd_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0
