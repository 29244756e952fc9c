import math

import numpy as np
from helpers import rows

from ledgerspark.llm import multiindex


def brute(data, cosine=0.93):
    """One row per row; data: (vec_id, label, vector)."""
    def usable(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(a is not None and math.isfinite(a) for a in r[2]) and any(r[2])

    good = [r for r in data if usable(r)]
    near = {k: [] for k in range(len(good))}
    unit = [np.array(r[2]) / np.abs(r[2]).max() for r in good]
    unit = [x / np.linalg.norm(x) for x in unit]
    for i, a in enumerate(good):
        for j, b in enumerate(good):
            if i != j and a[1] == b[1] and len(a[2]) == len(b[2]) and unit[i] @ unit[j] >= cosine:
                near[i].append(j)
    out = [(r[0], 0, r[0], True) for r in data if not usable(r)]
    for i, a in enumerate(good):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        least = min(good[j][0] for j in seen)
        out.append((a[0], len(near[i]), least, least == a[0]))
    return sorted(out, key=repr)


def planted(n=600, dim=32, seed=5):
    """Unit vectors of which a half are moved copies, in chains and around the threshold, and some exact copies."""
    rng = np.random.default_rng(seed)
    x = [v / np.linalg.norm(v) for v in rng.normal(size=(n, dim))]
    data = [(10 * i, i % 3, v) for i, v in enumerate(x)]
    for i in range(n):
        base = data[int(rng.integers(len(data)))]
        way = rng.normal(size=dim)
        way -= (way @ base[2]) * base[2]
        cosine = rng.uniform(0.9, 1.0)
        data.append((10 * i + 7, base[1], cosine * base[2] + math.sqrt(1 - cosine**2) * way / np.linalg.norm(way)))
    data += [(10 * i + 3, data[i][1], data[i][2]) for i in range(0, 300, 3)]
    return [(i, label, v.tolist()) for i, label, v in data]


def test_links_components_and_recall(spark):
    data = planted()
    got = rows(multiindex.near_duplicates(spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")))
    want = brute(data)
    found, all_ = sum(r[1] for r in got), sum(r[1] for r in want)
    assert all_ > 800 and 0.99 * all_ <= found <= all_  # no link below the threshold, nearly all above it
    assert got == want or found < all_


def test_every_block_and_walk(spark, monkeypatch):
    """With a walk through all cells, and small blocks, the result is that of comparing all pairs."""
    monkeypatch.setattr(multiindex, "RESIDENTS", 16)
    monkeypatch.setattr(multiindex, "VISITORS", 24)
    monkeypatch.setattr(multiindex, "TILE", 5)
    data = planted(n=300, dim=8, seed=6) + [(100_000 + i, 0, [1.0 + i * 1e-4] + [0.0] * 6 + [1e-3]) for i in range(200)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    assert rows(multiindex.near_duplicates(df, recall=1.0)) == brute(data)


def test_short_walks_count_each_link_for_both(spark, monkeypatch):
    """Where only one of two rows comes to the other's cell, the link counts for both of them, once."""
    full = multiindex.Grid.__init__

    def short(self, *args):
        full(self, *args)
        self.reach /= 8

    monkeypatch.setattr(multiindex.Grid, "__init__", short)
    data = [r for r in planted(n=500, dim=16, seed=8) if r[0] % 10 != 3]
    got = {r[0]: r for r in rows(multiindex.near_duplicates(spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")))}
    want = {r[0]: r for r in brute(data)}
    assert all(got[i][1] <= want[i][1] for i in want)
    assert 0 < sum(r[1] for r in got.values()) < sum(r[1] for r in want.values())
    assert sum(r[1] for r in got.values()) % 2 == 0


def test_odd_rows_and_clashing_columns(spark):
    data = [(5, 1, [1.0, 2.0]), (3, 1, [2.0, 4.0]), (3, 1, [2.0, 4.0]), (9, 1, [1.0, 2.0]), (1, 2, [1.0, 2.0]), (2, None, [1.0, 2.0]), (None, 1, [1.0, 2.0]), (4, 1, None), (6, 1, []),
            (7, 1, [0.0, 0.0]), (8, 1, [1.0, None]), (10, 1, [math.nan, 1.0]), (11, 1, [math.inf, 1.0]), (12, 1, [1.0, 2.0, 0.0]), (13, 1, [1e300, 2e300]), (14, 1, [1e-310, 2e-310]), (15, 1, [5.0]), (16, 1, [7.0])]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 as cell", "2 as class_id", "3 as copies", "4 as use")
    assert rows(multiindex.near_duplicates(df)) == brute(data)
    assert multiindex.near_duplicates(df.limit(0)).count() == 0
    assert rows(multiindex.near_duplicates(df.where("label is null"))) == brute([r for r in data if r[1] is None])


def test_the_walk_is_nearest_first_and_ends_at_its_reach():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 12))
    grid = multiindex.Grid(list(x), 6, 0.93, 0.99)
    flat = grid.flat(list(x[:50]))
    at, cells, own = grid.walk(flat)
    (first, second), _ = grid.gaps(flat)
    for k in range(50):
        sums = (first[k][:, None] + second[k][None, :]).ravel()
        mine = cells[at == k]
        assert mine[0] == own[k] and sorted(mine) == np.flatnonzero(sums <= grid.reach).tolist()
        assert (np.diff(sums[mine]) >= 0).all()
