import math

import numpy as np
from helpers import rows, table

from ledgerspark.llm import topk

LONG = 2**63


def brute(vectors, k=20, every=20):
    """All inner products, over whole numbers of any size."""
    width = max((len(x) for x in vectors.values()), default=0)
    wide = {i: x + [0] * (width - len(x)) for i, x in vectors.items()}
    out = []
    for i, x in wide.items():
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in wide.items() if j != i)[:k]
            out += [(i, r, j, min(max(-s, -LONG), LONG - 1)) for r, (s, j) in enumerate(best, 1)]
    return sorted(out, key=repr)


def whole(x):
    return [max(-LONG, min(LONG - 1, math.floor(64 * float(v)))) for v in x]


def test_given_table(spark, small):
    data = table(small, "embeddings")
    want = brute({i: whole(v) for i, v in data[["vec_id", "embedding"]].values})
    assert rows(topk.op1_topk(spark, small)) == want


def test_unusable_vectors_lengths_and_clashing_columns(spark):
    data = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (40, [math.nan, 1.0]), (60, [math.inf, 1.0]), (5, [-1.0, -2.0]),
            (80, []), (6, [1.0, 2.0, 3.0]), (6, [9.0]), (None, [1.0]), (100, [1e12, -1e12]), (7, [1e17, 1e3]), (1, [1.0, 2.0])]
    good = {}
    for i, v in data:
        if i is not None and v is not None and all(a is not None and math.isfinite(a) for a in v):
            good[i] = min(good.get(i, whole(v)), whole(v))
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as x", "2 as range", "3 as place")
    assert rows(topk.top_k(df)) == brute(good)
    assert topk.top_k(df.limit(0)).count() == 0


def test_a_common_vector(spark):
    rng = np.random.default_rng(1)
    data = {i: [0.5] * 8 for i in range(2000)} | {2000 + i: rng.normal(size=8).tolist() for i in range(400)}
    df = spark.createDataFrame(list(data.items()), "vec_id long, embedding array<double>")
    assert rows(topk.top_k(df)) == brute({i: whole(v) for i, v in data.items()})


def test_other_queries(spark):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(900, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [r[2] for r in rows(topk.top_k(df, asked, k=3))] == [6, 13, 20]


def test_blocks_are_skipped(spark):
    """Clustered vectors: bounds keep most blocks from being scored."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 16)) * 40
    x = np.floor(np.repeat(centre, 64, axis=0) + rng.normal(size=(2560, 16))).astype(np.int64)
    seen = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            seen.append(self.shape[0])
            return np.asarray(self) @ np.asarray(other)

    blocks = pa.table({
        "terms": [16] * 40, "width": [2] * 40, "ids": [np.arange(64 * b, 64 * b + 64).tobytes() for b in range(40)],
        "forward": [x[64 * b : 64 * b + 64].astype("i2").tobytes() for b in range(40)],
        "upper": [x[64 * b : 64 * b + 64].max(axis=0).tobytes() for b in range(40)], "lower": [x[64 * b : 64 * b + 64].min(axis=0).tobytes() for b in range(40)]})
    queries = pa.table({"vec_id": [5000], "x": [x[100].tolist()], "floor": pa.array([None], pa.int64())})
    got = sorted(topk.search_cell(blocks, queries, 20), key=lambda r: (-r[2], r[1]))
    scores = x @ x[100]
    assert [r[1] for r in got] == np.lexsort((np.arange(2560), -scores))[:20].tolist()
    bounds = np.maximum(x[100], 0) @ x.reshape(40, 64, 16).max(axis=1).T + np.minimum(x[100], 0) @ x.reshape(40, 64, 16).min(axis=1).T
    assert (bounds < np.sort(scores)[-20]).sum() > 20
