"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import chat, counts, decontaminate, langid, multiindex, negatives, phrases, simhash, tokens, topk, toxicity, urls, warc
from ledgerspark.llm.oracles import ORACLES

QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    topk.op1_topk,
    chat.op2_chat,
    langid.op3_language,
    urls.op4_url_filter,
    simhash.op5_simhash,
    warc.op6_warc,
    counts.op7_token_counts,
    decontaminate.op8_decontaminate,
    tokens.op9_bpe_codec,
    toxicity.op10_toxicity,
    negatives.op11_hard_negatives,
    phrases.op12_collocations,
    multiindex.op13_embedding_dedup,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
