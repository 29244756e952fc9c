"""From raw documents to token ids: toxic texts, unknown languages, near-duplicates and leaked test items go, the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import base, decontaminate, langid, simhash, tokens, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the classifier on labelled rows of ``docs`` and drops what it predicts to be toxic."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, base.table(spark, sf_dir, "labels")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language is below the calibrated score."""
    return langid.drop_rejected(docs, langid.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked, the one with the smallest id stays."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage that aligns with a test item."""
    return decontaminate.drop_contaminated(docs, base.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): token ids of every document left, decoded again for the last digest."""
    ranks = tokens.rank_bytes()
    return tokens.digests(tokens.encode(docs, ranks), ranks, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_codec", encode),
]

#: Fitted classifiers, alignments and token ids are beyond SQL: tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is a written table."""
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = base.materialize(stage(spark, docs, sf_dir), name)
        base.discard(docs)
        docs = done
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
