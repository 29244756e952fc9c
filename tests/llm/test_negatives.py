import math

import numpy as np
from helpers import rows, table

from ledgerspark.llm import negatives

LONG = 2**63


def floors(x):
    return [max(-LONG, min(LONG - 1, math.floor(256 * float(v)))) for v in x]


def brute(data, every=100):
    """All products, over whole numbers of any size; data: (vec_id, label, vector)."""
    good = {}
    for i, label, v in data:
        if i is not None and label is not None and v is not None and all(a is not None and math.isfinite(a) for a in v):
            good[i] = min(good.get(i, (str(label), floors(v))), (str(label), floors(v)))
    out = []
    for a, (label, x) in good.items():
        if a % every == 0:
            found = sorted((-min(max(sum(p * q for p, q in zip(x, y)), -LONG), LONG - 1), i, own) for i, (own, y) in good.items() if i != a)
            for low, positive, _ in [f for f in found if f[2] == label][:5]:
                inside = [f for f in found if f[2] != label and 80 * -low <= 100 * -f[0] <= 100 * -low][:5]
                out += [(a, positive, r, i, -low, -s) for r, (s, i, _) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def test_strassen():
    rng = np.random.default_rng(0)
    for m, k, n in ((1, 1, 1), (7, 5, 3), (33, 65, 70), (129, 64, 200)):
        a, b = rng.integers(-999, 999, (m, k)), rng.integers(-999, 999, (k, n))
        assert (negatives.strassen(a, b, leaf=3) == a @ b).all()
    a, b = rng.integers(-(2**30), 2**30, (40, 40)), rng.integers(-(2**26), 2**26, (40, 40))  # sums wrap on the way, the result fits
    assert (negatives.strassen(a * 4, b, leaf=4) == (a.astype(object) * 4) @ b.astype(object)).all()
    big = rng.integers(-(2**62), 2**62, (9, 9)).astype(object)
    assert (negatives.strassen(big, big, leaf=2) == big @ big).all()


def test_given_table(spark, small):
    data = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in table(small, "embeddings")[["vec_id", "label", "embedding"]].values]
    assert rows(negatives.op11_hard_negatives(spark, small)) == brute(data)


def test_a_common_label_ties_and_several_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CELL_ROWS", 100)
    monkeypatch.setattr(negatives, "CELL_ANCHORS", 2)
    monkeypatch.setattr(negatives, "TILE", (2, 16))
    rng = np.random.default_rng(1)
    data = [(i, 0 if i % 3 else int(rng.integers(5)), rng.integers(0, 3, 4).astype(float).tolist()) for i in range(700)]
    data += [(700 + i, i % 2, [1.0, 1.0, 1.0, 1.0]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    assert rows(negatives.mine(df)) == brute(data)


def test_odd_rows_and_clashing_columns(spark):
    data = [(0, 1, [1.0, 2.0]), (100, 2, [2.0, 1.0]), (1, 1, [1.0, 2.0]), (2, 1, None), (3, 1, [1.0, None]), (4, None, [1.0]), (5, 2, [math.nan, 1.0]), (6, 2, [math.inf]),
            (None, 1, [1.0]), (7, 2, []), (8, 2, [1.0, 1.9, 0.0]), (8, 2, [1.0, 1.9]), (9, 2, [1.0, 1.8]), (200, 3, [-1.0, -1.0]), (11, 3, [-2.0]), (12, 3, [1.0]),
            (300, 4, [1e17, 1.0]), (13, 4, [1e17, 1.0]), (14, 5, [9e16, 0.0]), (15, 5, [1e-3, 0.0]), (1, 1, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 as x", "2 as range", "3 as chunk", "4 as anchor_id")
    want = brute(data)
    assert len(want) > 4
    assert rows(negatives.mine(df)) == want
    assert rows(negatives.mine(df.withColumn("label", df["label"].cast("string")))) == want
    assert negatives.mine(df.limit(0)).count() == 0
    asked = spark.createDataFrame([(9,), (77,), (9,)], "vec_id long")
    assert {r[0] for r in rows(negatives.mine(df, asked))} <= {9}
