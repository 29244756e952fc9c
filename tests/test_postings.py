"""The full-text index against a search of the texts themselves."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators.postings import TextIndex
from ledgerspark.session import scratch_path

WORDS = ["the", "The", "cat", "ÉTÉ", "ñu", "42", "zug", "rare"]


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def texts(n, seed):
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        size = rng.choice([0, 1, 3, 8, 40])
        out[i] = None if rng.random() < 0.05 else rng.choice(["", " ", "-- "]) + "".join(rng.choices(WORDS, [40, 9, 9, 5, 5, 5, 5, 1])[0] + rng.choice([" ", ", ", "\n\n", "_"]) for _ in range(size))
    return out


def frame(spark, rows):
    return spark.createDataFrame(list(rows.items()), "id long, body string")


def check(index, live):
    for words in (["rare", "THE"], ["été", "ñu", "42"], ["the", "missing"]):
        low = [w.lower() for w in words]
        assert sorted(r[0] for r in index.search(words).collect()) == sorted(i for i, t in live.items() if set(low) <= set(tokens(t)))
    for words in (["the", "the", "the"], ["zug"], ["rare", "the"]):
        want = {}
        for i, t in live.items():
            own = tokens(t)
            if starts := [k for k in range(len(own)) if own[k : k + len(words)] == words]:
                want[i] = starts
        assert {r["id"]: r["starts"] for r in index.phrase(words).collect()} == want
    counts = {}
    for t in live.values():
        for w in set(tokens(t)):
            counts[w] = counts.get(w, 0) + 1
    assert {r["word"]: r["documents"] for r in index.terms().collect()} == counts


def test_index_batches_and_merge(spark):
    rows = texts(300, 1)
    index = TextIndex.build(frame(spark, rows), "id", "body", scratch_path(spark, "index"))
    check(index, rows)
    for seed in (2, 3):  # batches with new documents, and some that replace old ones, also by texts without words
        batch = {i + 100 * seed: t for i, t in texts(150, seed).items()}
        index.append(frame(spark, batch), "id", "body")
        rows |= batch
    check(index, rows)
    index.merge()
    check(index, rows)
    rebuilt = TextIndex.build(frame(spark, rows), "id", "body", scratch_path(spark, "index"))
    merged, fresh = (i._valid(lambda r: r).select("word", "id", "positions") for i in (index, rebuilt))
    assert merged.exceptAll(fresh).count() == fresh.exceptAll(merged).count() == 0
    index.drop_merged()
    index.append(frame(spark, {0: "the cat"}), "id", "body")
    check(index, rows | {0: "the cat"})


def test_unfinished_batches_do_not_count(spark):
    index = TextIndex.build(frame(spark, {1: "the cat"}), "id", "body", scratch_path(spark, "index"))
    frame(spark, {2: "the zug"}).selectExpr("'the' AS word", "id", "array(0) AS positions").write.parquet(f"{index.path}/batch-1/postings")
    assert [r[0] for r in index.search(["the"]).collect()] == [1]
    index.append(frame(spark, {2: "the zug"}), "id", "body")
    assert sorted(r[0] for r in index.search(["the"]).collect()) == [1, 2]


def test_a_search_reads_its_words_only(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    index = TextIndex.build(docs, "doc_id", "text", scratch_path(spark, "index"))
    plan = index.phrase(["on", "the"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(word,the)" in plan and "documents.parquet" not in plan and "text" not in plan
    assert "positions" not in index.search(["on", "the"])._jdf.queryExecution().executedPlan().toString()


def test_a_common_word_is_spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = {i: "the" for i in range(4000)}
        index = TextIndex.build(frame(spark, rows), "id", "body", scratch_path(spark, "index"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = index._read(("base", 0), "postings").groupBy(F.input_file_name()).count().collect()
    assert len(files) > 2 and max(r["count"] for r in files) < 3000


def test_empty_index_and_arguments(spark):
    path = scratch_path(spark, "index")
    with pytest.raises(ValueError):
        TextIndex(spark, path).search(["the"])
    index = TextIndex.build(frame(spark, {1: None}).filter("id > 1"), "id", "body", path)
    check(index, {})
    with pytest.raises(ValueError):
        TextIndex.build(frame(spark, {1: "x"}), "id", "body", path)
    for words in ([], ["two words"], [""]):
        with pytest.raises(ValueError):
            index.search(words)
        with pytest.raises(ValueError):
            index.phrase(words)
