import hashlib

import public_tokenizers
import pytest
from helpers import rows, table
from tokenizers import Tokenizer

from ledgerspark.llm import counts, tokens

ODD = [(1, None), (2, ""), (3, "a<|endoftext|> <|endoftext|>b  c\n\n d"), (4, "x" * 200_000), (5, " " * 100_000 + "a"), (6, "日本語 ՘ ‏ \U0001f389 'S 's\x1c\x85"), (7, "ab 12 " * 50_000),
       (7, "dup"), (7, "dup"), (None, "null id <|endoftext"), (8, "  　x\U00016d40"), (9, "the " * 200_000), (10, "qzx" * 70_000 + " " + "qzxv " * 70_000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "'a' as ids", "5 as block")


@pytest.fixture(scope="module")
def enc():
    return tokens.encoding(tokens.rank_bytes())


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def coded(enc, data):
    out = []
    for key, text in data:
        ids = enc.encode_ordinary(text or "")
        out.append((key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def counted(tok, data):
    out = []
    for key, text in data:
        n = len(tok.encode(text or "", add_special_tokens=False).ids)
        out.append((key, len((text or "").encode()), n, n > 512))
    return sorted(out, key=repr)


def test_codec_of_given_documents(spark, small, enc):
    assert rows(tokens.op9_bpe_codec(spark, small)) == coded(enc, table(small, "documents")[["doc_id", "text"]].values.tolist())


def test_codec_of_odd_texts(odd, enc):
    assert rows(tokens.codec_report(odd)) == coded(enc, ODD)
    assert tokens.codec_report(odd.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_are_cut_at_safe_places(spark, small, enc, piece):
    data = table(small, "documents")[["doc_id", "text"]].values.tolist()[:40]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = {k: enc.encode_ordinary(t) for k, t in data}
    assert {r[0]: r[1] for r in tokens.encode(df, piece=piece).collect()} == want


def test_decoding_gives_the_bytes_back(odd):
    got = sorted(((r["doc_id"], bytes(r["decoded"])) for r in tokens.decode(tokens.encode(odd)).collect()), key=repr)
    assert got == sorted(((k, (t or "").encode()) for k, t in ODD), key=repr)


def test_raw_bytes(spark):
    df = spark.createDataFrame([(1, [230]), (2, None), (3, [])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in tokens.decode(df).collect()}
    assert got[2] is None and got[3] == b"" and len(got[1]) >= 1


def test_counts_of_given_documents(spark, small, tok):
    assert rows(counts.op7_token_counts(spark, small)) == counted(tok, table(small, "documents")[["doc_id", "text"]].values.tolist())


def test_counts_of_odd_texts(odd, tok):
    assert rows(counts.count_tokens(odd)) == counted(tok, ODD)
    assert counts.count_tokens(odd.limit(0)).count() == 0


def test_counts_over_many_blocks(spark, tok, monkeypatch):
    monkeypatch.setattr(counts, "PAIRS", 50)
    monkeypatch.setattr(counts, "BLOCKS_HELD", 3)
    data = [(i, f"everyqzx rareqv{i % 17} zzqx " * (i % 5) + "everyqzx") for i in range(600)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(counts.count_tokens(df)) == counted(tok, data)


def test_long_frequencies(spark, tok):
    data = [(1, "zqxv" + " zqxv" * 140_000)]  # more than two bytes hold
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(counts.count_tokens(df)) == counted(tok, data)


def test_held_back_columns_are_not_read(spark, small):
    plan = counts.count_tokens(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "lang" not in plan.split("ReadSchema")[1].split(">")[0]
