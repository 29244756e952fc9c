import numpy as np
import pytest
from helpers import rows, table

from ledgerspark.llm import base, langid


@pytest.fixture(scope="module")
def model(spark, medium):
    return langid.fit(spark.read.parquet(f"{medium}/documents.parquet"))


def test_held_out_accuracy(spark, medium):
    got = langid.op3_language(spark, medium).toPandas().merge(table(medium, "documents"), on="doc_id")
    assert len(got) == len(table(medium, "documents"))
    held = got[got.held_out]
    assert len(held) > 100 and (held.lang_pred == held.lang).mean() > 0.98 and held.accepted.mean() > 0.99


def test_held_out_rule(spark):
    import zlib

    got = spark.range(200).select("id", base.held_out("id")).collect()
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(base.held_out()).first()[0] is False


def test_nothing_held_out_is_learned(spark, medium):
    """Other texts and languages in the held-out rows change nothing."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    other = docs.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'zzz', text) AS text", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'xx', lang) AS lang")
    a, b = langid.fit(docs), langid.fit(other)
    assert a.languages == b.languages and np.array_equal(a.table, b.table) and a.threshold == b.threshold


def test_odd_texts(spark, model):
    data = [(1, None), (2, ""), (3, "123 !!"), (None, "the and that"), (5, "a"), (6, "the and that " * 300_000), (7, "日本語"), (7, "日本語")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as score", "'fr' as lang_pred")
    got = rows(langid.identify(df, model))
    assert [(r[0], r[1]) for r in got if r[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert all(0 <= r[2] <= 1 for r in got) and len(got) == 8 and [r[1] for r in got if r[0] in (None, 6)] == ["en", "en"]
    kept = langid.drop_rejected(df, model)
    assert kept.columns == df.columns and {r[0] for r in rows(kept, "doc_id")} >= {None, 6} and not {r[0] for r in rows(kept, "doc_id")} & {1, 2, 3}
    assert langid.identify(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    none = langid.fit(spark.createDataFrame([(1, "x", None), (2, None, "en")], "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert rows(langid.identify(df, none))[0][1] in ("und", "en")


def test_average_is_that_of_the_embeddings():
    """The table rows are embeddings times weights, so their mean gives the logits of the mean embedding."""
    known, rng = langid.letters(), np.random.default_rng(0)
    embed, weights = rng.normal(size=(langid.BUCKETS, 4)).astype(np.float32), rng.normal(size=(4, 3)).astype(np.float32)
    text = "Some Words, and more of them"
    found = langid.subwords(langid.signs(text, known))
    assert np.allclose(langid.average(text, known, embed @ weights), embed[found].mean(axis=0) @ weights, atol=1e-4)
    assert len(langid.subwords(langid.signs("a", known))) == 3 and len(langid.subwords(langid.signs(" ,. ", known))) == 0
