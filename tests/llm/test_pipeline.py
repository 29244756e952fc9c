import os
import sys

import pytest
from helpers import rows, table

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from ledgerspark.llm import base, decontaminate, langid, simhash, tokens, toxicity  # noqa: E402


def test_stages_one_by_one(spark, small):
    """Every stage against what its operator decides on that stage's input."""
    docs, (f1, f2, f3, f4, f5) = base.table(spark, small, "documents"), [f for _, f in corpus_pipeline.STAGES]
    labels, benchmark = base.table(spark, small, "labels"), base.table(spark, small, "benchmark")
    all_rows = rows(docs, "doc_id")

    first = base.materialize(f1(spark, docs, small))
    scores = toxicity.toxic_passages(docs, toxicity.fit(docs, labels))
    assert rows(first, "doc_id") == rows(scores.where(f"score < {toxicity.CUT}"), "doc_id") and first.columns == docs.columns
    second = base.materialize(f2(spark, first, small))
    assert rows(second, "doc_id") == rows(langid.identify(first, langid.fit(first)).where("accepted"), "doc_id") and second.columns == docs.columns
    third = base.materialize(f3(spark, second, small))
    assert rows(third, "doc_id") == rows(simhash.near_duplicates(second).where("doc_id = component_id"), "doc_id") and third.columns == docs.columns
    fourth = base.materialize(f4(spark, third, small))
    leaked = {r[0] for r in rows(decontaminate.contaminated(third, benchmark), "doc_id")}
    assert {r[0] for r in rows(fourth, "doc_id")} == {r[0] for r in rows(third, "doc_id")} - leaked and fourth.columns == docs.columns
    last = rows(f5(spark, fourth, small), "doc_id", "ids")
    enc, texts = tokens.encoding(tokens.rank_bytes()), {k: t for k, t in table(small, "documents")[["doc_id", "text"]].values}
    assert {k: ids for k, ids in last} == {k: enc.encode_ordinary(texts[k]) for (k,) in rows(fourth, "doc_id")}
    assert len(all_rows) > len(last) > 0.5 * len(all_rows)
    assert rows(corpus_pipeline.run(spark, small), "doc_id") == [(k,) for k, _ in last]


@pytest.mark.parametrize("stage", range(5))
def test_odd_and_empty_tables(spark, small, stage):
    f = corpus_pipeline.STAGES[stage][1]
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "some words of text"), (3, "some words of text"), (3, "some words of text"), (4, "w " * 100_000)], "doc_id long, text string")
    odd = odd.selectExpr("*", "'en' as lang", "CAST(NULL AS STRING) AS source", "1L as n_chars", "5 as text_key", "6 as fp", "0.5 as score", "7 as ids")
    got = f(spark, odd, small)
    assert got.count() >= 1 and f(spark, odd.limit(0), small).count() == 0
    assert stage == 4 or got.columns == odd.columns
