import numpy as np
import pytest
from helpers import rows, table

from ledgerspark.llm import toxicity


@pytest.fixture(scope="module")
def model(spark, medium):
    return toxicity.fit(spark.read.parquet(f"{medium}/documents.parquet"), spark.read.parquet(f"{medium}/labels.parquet"))


def all_maximal(w):
    """By definition: the best segment (shortest of equals, then first), then the same left and right of it."""
    best = None
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            s = w[i:j].sum()
            if s > 0 and (best is None or (s, i - j, -i) > (best[0], best[1] - best[2], -best[1])):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return all_maximal(w[:i]) + [(i, j, s)] + [(a + j, b + j, x) for a, b, x in all_maximal(w[j:])]


def test_segments_are_the_maximal_ones():
    rng = np.random.default_rng(2)
    for _ in range(300):
        w = np.round(rng.normal(-0.3, 1.5, size=int(rng.integers(1, 25))), 3) + rng.random(1)[0] * 1e-4
        got, want = toxicity.segments(w), all_maximal(w)
        assert [g[:2] for g in got] == [x[:2] for x in want] and np.allclose([g[2] for g in got], [x[2] for x in want])
    assert toxicity.segments(np.full(5, -1.0)) == [] and toxicity.segments(np.zeros(0)) == []


def test_segments_take_linear_time():
    w = np.tile([1.0, -0.9], 200_000)
    assert toxicity.segments(w)[0][:2] == (0, len(w) - 1)


def test_held_out_rows(spark, medium):
    got = toxicity.op10_toxicity(spark, medium).toPandas()
    assert len(got) == len(table(medium, "documents")) and got.score.between(0, 1).all()
    held = got[got.held_out].merge(table(medium, "labels"), on="doc_id")
    right = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert right >= 0.85 * (held.toxic == 1).sum() and ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.02 * len(held)


def test_passages_are_found_in_long_clean_text(spark, model):
    clean = "the onand then of reion thand " * 300
    text = clean + "you stupid idiot pathetic scum worthless moron " + clean
    found = toxicity.toxic_passages(spark.createDataFrame([(1, text), (2, clean)], "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r for r in found}
    assert by[1]["score"] > 0.3 > by[2]["score"] and not by[2]["passages"]
    shown = [text[p["start"] : p["end"]] for p in by[1]["passages"]]
    assert any("idiot pathetic scum" in s for s in shown) and max(map(len, shown)) < 400


def test_odd_rows(spark, model):
    data = [(1, None), (2, ""), (None, "idiot scum"), (3, "idiot scum"), (3, "idiot scum"), (4, "idiot " * 200_000), (5, "İ idiot moron scum"), (6, "?!")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'x' as label", "0.5 as score", "1 as passages")
    got = toxicity.toxic_passages(df, model).collect()
    assert len(got) == 8 and all(0 <= r["score"] <= 1 for r in got)
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns and {r[0] for r in rows(kept, "doc_id")} == {1, 2, 6}
    assert toxicity.toxic_passages(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (3, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.limit(0)):
        assert all(r["score"] < 0.3 for r in toxicity.toxic_passages(docs, toxicity.fit(docs, given)).collect())


def test_held_out_labels_are_not_learned(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 1 - toxic, toxic) AS toxic")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, other)
    assert a.weights == b.weights and a.curve == b.curve
