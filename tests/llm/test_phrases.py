import re
from collections import Counter, defaultdict

import pytest
from helpers import rows, table

from ledgerspark.llm import phrases


def brute(docs, support=10, first=2000):
    """docs: (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\f\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f[lang].update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, count in f.items():
        found = []
        for phrase, a in count.items():
            words = phrase.split(" ")
            if len(words) == 1 or a < support:
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = count[" ".join(words[:k])], count[" ".join(words[k:])]
                cuts.append((10**6 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            longer = [b for other, b in count.items() if len(words) == 2 and b >= support and len(w := other.split(" ")) == 3 and (w[:2] == words or w[1:] == words)]
            if not any(100 * b >= 50 * a for b in longer):
                found.append((-score, -a, phrase.encode(), left, right))
        out += [(lang, r, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1)]
    return sorted(out, key=repr)


def test_given_table(spark, small):
    data = table(small, "documents")
    assert rows(phrases.op12_collocations(spark, small)) == brute(data[["lang", "text"]].values.tolist())


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_shards_slices_and_buckets(spark, monkeypatch, shards):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 300)
    monkeypatch.setattr(phrases, "chunks", lambda it, own=phrases.chunks: own(it, 300))
    monkeypatch.setattr(phrases, "BUCKET_ENTRIES", 50)
    docs = [("a", f"Big cat {'sat ' * (i % 4)}on the\tmat. the big  Cat, the mat" + " the" * (i % 5)) for i in range(60)]
    docs += [("b", "x y z; " * 40 + "x y." * 30), (None, "no lang no lang " * 20), ("und", "no lang"), ("c", ""), ("c", None), ("e", "ÀB àb ÀB àb " * 15), ("n", "a\x00b c d " * 12)]
    df = spark.createDataFrame([(lang, text, i, 1, 2) for i, (lang, text) in enumerate(docs)], "lang string, text string, hash int, phrase int, f int")
    got = rows(phrases.collocations(df, shards=shards))
    assert got == brute(docs) and len(got) > 15


def test_first_rows_support_and_no_rows(spark):
    docs = [("a", "p q r s t u v " * 3)] * 2
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows(phrases.collocations(df, first=3, support=4)) == brute(docs, 4, 3)
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.selectExpr("lang", "cast(null as string) as text")).count() == 0


def test_a_shard_gets_its_share_of_the_support(spark):
    """Only phrases that reach their share in some shard are candidates."""
    docs = spark.createDataFrame([("a", f"w{i} common pair") for i in range(300)], "lang string, text string")
    tokens = phrases._tokens(docs, 3)
    hashes = phrases.locally_frequent(tokens, phrases.totals(tokens), 2)
    assert hashes.count() == 3  # common, pair, common pair
