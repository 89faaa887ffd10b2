"""The pipeline against its operators applied by hand, and its stages' contracts."""

import corpus_pipeline as cp
from test_ngram_join import brute
from test_substring_dedup import covered
from test_text_scores import lowered
from test_tokens import check_packing

from odd_cases import odd_rows, odd_texts  # noqa: F401

from lakeforge.llm import toxicity
from lakeforge.llm.common import documents
from lakeforge.session import read_table

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    docs, labels = documents(spark, SF), read_table(spark, SF, "labels")
    model = toxicity.fit_severity(docs, labels)
    rejected = {r["doc_id"] for r in toxicity.severity(docs, model).where("rejected").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect() if r["doc_id"] not in rejected}
    last = {lowered(t): i for i, t in sorted(texts.items())}
    texts = {i: texts[i] for i in last.values()}
    texts = {i: texts[i] for i in {c for _, _, c in brute(list(texts.items()))}}
    rows = sorted(texts.items())
    left = {}
    for (i, text), _, mark in zip(rows, *covered([t for _, t in rows], 200)):
        at, kept = 0, []
        for c in text:
            n = len(c.encode())
            if not mark[at : at + n].all():
                kept.append(c)
            at += n
        left[i] = "".join(kept)
    check_packing(cp.run(spark, SF).collect(), left)


def test_stages_keep_columns_and_take_odd_rows(spark, odd_rows):
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, odd_rows, SF)
        assert out.columns == odd_rows.columns
        assert stage(spark, odd_rows.limit(0), SF).count() == 0
    assert cp.STAGES[-1][1](spark, odd_rows, SF).count() >= odd_rows.count()
