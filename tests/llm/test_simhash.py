from itertools import combinations

import numpy as np
import pytest
import xxhash
from helpers import rows, table

from ledgerspark.llm import graph, simhash


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({k: " " for k in (9, 10, 11, 12, 13)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute(data):
    """(id, fingerprint, smallest id that links lead to)."""
    prints = [plain_fingerprint(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(data)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for k, (key, _) in enumerate(data):
        least[find(k)] = min(least.get(find(k), key), key)
    return sorted([(key, f"{prints[k]:016x}", least[find(k)]) for k, (key, _) in enumerate(data)], key=repr)


def test_given_documents(spark, small):
    assert rows(simhash.op5_simhash(spark, small)) == brute(table(small, "documents")[["doc_id", "text"]].values.tolist())


def test_odd_texts(spark):
    data = [(5, "a b c"), (4, "A\tB\x0bC"), (3, None), (2, " \n"), (9, "one"), (8, "One"), (7, "two words"), (6, "É x y z"), (1, "x\u00a0y\u2003z w"), (10, "w " * 30_000), (11, "q" * 100_000)]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as component_id", "3 as least")
    got = simhash.near_duplicates(df).selectExpr("doc_id", "lpad(lower(hex(fp)), 16, '0')", "component_id")
    assert rows(got) == brute(data)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_words_in_pieces():
    data = ("ab " * 1000 + "\tlonger-word\n" * 300).encode()
    assert [w for part in simhash.words_of(data, 37) for w in part] == data.split()


def joined(spark, prints, **kw):
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    found = graph.components(simhash.links(df, **kw), "a", "b").collect()
    return {r[0] % 2**64: r[1] % 2**64 for r in found}


@pytest.mark.parametrize("bucket", [8192, 3])
def test_links_in_small_and_large_buckets(spark, bucket):
    """A dense ball of fingerprints, chains, far ones: the same components whichever way a bucket is handled."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**63)) * 2 + 1
    prints = {centre}
    for _ in range(250):
        flips = rng.choice(64, size=int(rng.integers(1, 5)), replace=False)
        prints.add(centre ^ sum(1 << int(b) for b in flips))
    chain = int(rng.integers(0, 2**63))
    for b in range(0, 40, 2):
        prints.add(chain := chain ^ (3 << b))
    prints |= {int(x) for x in rng.integers(0, 2**63, size=100)}
    prints = sorted(prints)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    got = joined(spark, prints, bucket=bucket)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(p)
    seen = {}
    for p, c in got.items():
        seen.setdefault(c, set()).add(p)
    assert sorted(map(sorted, seen.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5), (None, 4)], "a long, b long")
    got = dict(graph.components(edges).collect())
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def test_keep_one(spark):
    data = [(1, None), (2, ""), (None, "same words here now"), (None, "same words here now"), (3, "same words here now"), (3, "same words here now"), (4, "other words are there"),
            (4, "quite different things elsewhere always"), (None, "no id at all here")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "5 as text_key", "6 as fp", "7 as id", "8 as winner")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert rows(kept, "doc_id", "text") == sorted([(1, None), (3, data[4][1]), (4, data[6][1]), (4, data[7][1]), (None, data[8][1])], key=repr)
    assert simhash.keep_one(df.limit(0)).count() == 0
