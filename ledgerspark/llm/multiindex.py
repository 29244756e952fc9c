"""Near-duplicate vectors by an inverted multi-index: a product grid of two codebooks, walked from the nearest cell on, then verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base, graph
from ledgerspark.llm.topk import centres

COSINE = 0.93
#: Share of pairs at the very threshold that the walk must reach; pairs above it are reached more often.
RECALL = 0.999
#: Vectors (by hash) that the codebooks and the walk's end are fitted on; rows that a cell should hold; most centres of a codebook.
SAMPLE, CELL, CENTRES = 4096, 32, 256
#: Residents and visitors of a block of a cell, and visitors that are compared at once.
RESIDENTS, VISITORS, TILE = 2048, 8192, 1024


def raw(lists: pa.ChunkedArray | pa.ListArray) -> list[np.ndarray]:
    """The vectors as they are, in single or double precision."""
    return [np.asarray(value.values.to_numpy(zero_copy_only=False)) for value in lists]


def units(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, safe from overflow; every row is worked out in the same way wherever it stands."""
    x = np.ascontiguousarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Grid:
    """The cells of two codebooks. ``gaps`` says how far a vector is from each cell's border in either half."""

    def __init__(self, sample: list[np.ndarray], per_side: int, cosine: float, recall: float):
        """sample: vectors that are not null or zero. Longer vectors than all of them are placed by their first components."""
        self.width = max([2, *(len(x) for x in sample)])
        self.half = self.width // 2
        known = self.flat(sample)
        self.books = [np.unique(centres(part, per_side), axis=0) for part in (known[:, : self.half], known[:, self.half :])]
        self.apart = [np.sqrt(np.maximum(((b[:, None, :] - b[None, :, :]) ** 2).sum(axis=2), 1e-300)) for b in self.books]
        self.reach = self._calibrated(known, cosine, recall)

    def flat(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Unit vectors as rows of one width."""
        out = np.zeros((len(vectors), self.width))
        for k, x in enumerate(vectors):
            out[k, : min(len(x), self.width)] = units(x[None, :])[0, : self.width]
        return out

    def gaps(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per half the squared distances to the border of every cell (0 for the own one), and the number of the own cell."""
        found, own = [], []
        for part, book, apart in zip((x[:, : self.half], x[:, self.half :]), self.books, self.apart):
            far = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            near = far.argmin(axis=1)
            gap = np.maximum(far - far[np.arange(len(far)), near][:, None], 0) / (2 * apart[near])
            gap[np.arange(len(gap)), near] = 0
            found.append(gap**2)
            own.append(near)
        return found, own[0] * len(self.books[1]) + own[1]

    def need(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How far the walk of each vector has to go to come to a given cell."""
        (first, second), _ = self.gaps(x)
        rows, side = np.arange(len(x)), len(self.books[1])
        return first[rows, cell // side] + second[rows, cell % side]

    def _calibrated(self, known: np.ndarray, cosine: float, recall: float) -> float:
        """The reach at which the share ``recall`` of partners at the very threshold is found from either end. Partners are made from
        the sample: moved in a random direction, and (as data may fill few directions only) towards another vector."""
        if not len(known):
            return 0.0
        rng = np.random.default_rng(7)
        most = 0.0
        for way in (rng.normal(size=known.shape) * (known != 0).any(axis=0), np.roll(known, 1, axis=0)):
            across = way - (way * known).sum(axis=1)[:, None] * known
            size = np.sqrt((across**2).sum(axis=1))[:, None]
            across = np.where(size > 1e-9, across / np.maximum(size, 1e-9), 0)
            other = cosine * known + np.sqrt(1 - cosine**2) * across
            there, here = self.gaps(other)[1], self.gaps(known)[1]
            most = max(most, float(np.quantile(np.minimum(self.need(known, there), self.need(other, here)), recall)))
        return most

    def walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, cells, own cell of each row): the cells within reach of every row, nearest first.

        Multi-sequence traversal of all rows side by side: both halves' cells are sorted by their gaps; of each cell of the
        first half the next unvisited partner is remembered, and the least sum of all of them is the next stop.
        """
        (first, second), own = self.gaps(x)
        order = [np.argsort(g, axis=1, kind="stable") for g in (first, second)]
        first, second = (np.take_along_axis(g, o, axis=1) for g, o in zip((first, second), order))
        side, n = second.shape[1], len(x)
        second = np.concatenate([second, np.full((n, 1), np.inf)], axis=1)
        next_ = np.zeros(first.shape, np.int64)
        front = first + second[:, :1]
        rows, cells, open_ = [], [], np.arange(n)
        while len(open_):
            at = front[open_].argmin(axis=1)
            within = front[open_, at] <= self.reach
            open_, at = open_[within], at[within]
            partner = next_[open_, at]
            rows.append(open_)
            cells.append(order[0][open_, at] * side + order[1][open_, partner])
            next_[open_, at] = partner + 1
            front[open_, at] = first[open_, at] + second[open_, partner + 1]
        return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(cells or [np.zeros(0, int)]), own


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) with the cosine; what lies at the very threshold is summed again in one fixed order."""
    near = a @ b.T
    i, j = np.nonzero(near >= cosine - 1e-9)
    close = np.flatnonzero(np.abs(near[i, j] - cosine) < 1e-9)
    if len(close):
        keep = np.ones(len(i), bool)
        keep[close] = (a[i[close]] * b[j[close]]).sum(axis=1) >= cosine
        i, j = i[keep], j[keep]
    return i, j


def merged(part: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Parts (each named by its smallest member) after the members a and b were linked pairwise."""
    a, b = part[a], part[b]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
    if not pairs.size:
        return part
    name = np.arange(len(part))
    while True:
        before = name.copy()
        np.minimum.at(name, pairs[1], name[pairs[0]])
        np.minimum.at(name, pairs[0], name[pairs[1]])
        name = name[name]
        if (name == before).all():
            return name[part]


def compare(residents: pa.Table, visitors: pa.Table, cosine: float, kind: str = "f8") -> pa.Table:
    """(class_id, links, root) of one block: links that are counted here, and the smallest class of the block's component.

    A link is counted for the visitor; also for the resident where the resident's own walk does not come to the visitor's cell.
    """
    schema = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    ids, theirs = residents["class_id"].to_numpy(), visitors["class_id"].to_numpy()
    nodes = np.unique(np.concatenate([ids, theirs]))
    at, from_ = np.searchsorted(nodes, ids), np.searchsorted(nodes, theirs)
    weight, other = residents["copies"].to_numpy(), visitors["copies"].to_numpy()
    walks = residents["cells"].to_pylist()
    base_ = 1 + max([0, *(max(w, default=0) for w in walks), *visitors["own"].to_pylist()])
    walked = np.unique(np.array([k * base_ + c for k, w in enumerate(walks) for c in w], np.int64))
    own = visitors["own"].to_numpy().astype(np.int64)
    links, part = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    left, right = residents["vector"].to_pylist(), visitors["vector"].to_pylist()
    sizes = [np.array([len(u) for u in side], np.int64) for side in (left, right)]
    for size in np.intersect1d(*sizes):
        mine, all_ = (np.flatnonzero(s == size) for s in sizes)
        r = units(np.frombuffer(b"".join(left[k] for k in mine), kind).reshape(len(mine), -1))
        for start in range(0, len(all_), TILE):
            some = all_[start : start + TILE]
            v = units(np.frombuffer(b"".join(right[k] for k in some), kind).reshape(len(some), -1))
            i, j = linked(v, r, cosine)
            i, j = some[i], mine[j]
            apart = theirs[i] != ids[j]
            i, j = i[apart], j[apart]
            np.add.at(links, from_[i], weight[j])
            key = j * base_ + own[i]
            place = np.minimum(np.searchsorted(walked, key), max(0, len(walked) - 1))
            unseen = walked[place] != key if len(walked) else np.ones(len(key), bool)
            np.add.at(links, at[j[unseen]], other[i[unseen]])
            part = merged(part, from_[i], at[j])
    met = np.zeros(len(nodes), bool)
    met[part != np.arange(len(nodes))] = True
    met[part[met]] = True
    return pa.table([nodes[met], links[met], nodes[part[met]]], schema=schema)


def fit(classes: DataFrame, cosine: float, recall: float) -> Grid:
    """Codebooks and reach from up to ``SAMPLE`` vectors. The number of centres grows with the largest label, so that a cell
    holds about ``CELL`` of its vectors."""
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    per_side = min(CENTRES, max(1, round((largest / CELL) ** 0.5)))
    drawn = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("embedding").toArrow()
    return Grid(raw(drawn.column("embedding")), per_side, cosine, recall)


def near_duplicates(table: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (columns vec_id, label, embedding).

    Rows of one label (not null) are linked where the cosine of their vectors, of equal length, is at least ``cosine`` and one
    of the two comes to the other's cell; every found pair is verified in double precision. n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable, kept says whether that is the row's own. Null, empty and zero
    vectors, those with null or non-finite components, and rows without id or label link with nothing (component_id is their
    vec_id, kept is true). Every row stands for itself, also where ids or vectors repeat; columns of other names are not read; no rows give none.

    Equal vectors of a label are one class with a number of copies, so copies are never paired. A cell above ``RESIDENTS`` is cut
    into blocks, each met by all its visitors in blocks of their own. A block returns one row per class, no pairs.
    """
    spark = table.sparkSession
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    flat = ~F.exists("embedding", lambda v: v.cast("double") != 0)
    use = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & ~flat, F.lit(False))
    rows = base.bounded_batches(table).select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", use.alias("use"))
    taken = rows.where("use")
    classes = base.materialize(taken.groupBy("label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies")), "classes")
    grid = fit(classes, cosine, recall)
    number = "f4" if classes.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8"

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            vectors = raw(batch.column(2))
            if not vectors:
                continue
            at, cells, own = grid.walk(grid.flat(vectors))
            order = np.argsort(at, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(vectors)))]).astype(np.int32)
            walks = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells[order].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.astype(number).tobytes() for x in vectors], pa.binary()), pa.array(own.astype(np.int32)), walks, batch.column(3)],
                names=["class_id", "copies", "vector", "own", "cells", "label"])

    kind = classes.schema["label"].dataType.simpleString()
    placed = base.materialize(classes.select("class_id", "copies", "embedding", "label").mapInArrow(
        place, f"class_id long, copies long, vector binary, own int, cells array<int>, label {kind}"), "placed")
    visits = placed.select(F.explode("cells").alias("cell"), *(F.col(c).alias(c) for c in ("label", "class_id", "copies", "vector", "own")))
    sizes = placed.groupBy("label", F.col("own").alias("cell")).agg(F.count("*").alias("here")).join(
        visits.groupBy("label", "cell").agg(F.count("*").alias("coming")), ["label", "cell"])
    sizes = base.materialize(sizes.select("label", "cell", F.ceil(F.col("here") / RESIDENTS).cast("int").alias("blocks"), F.ceil(F.col("coming") / VISITORS).cast("int").alias("chunks")), "cells")

    def of(count: str):
        return F.pmod(F.xxhash64("class_id", F.lit(count)), F.col(count)).cast("int")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    residents = placed.withColumn("cell", F.col("own")).join(sizes, ["label", "cell"]).withColumn("block", of("blocks")).withColumn("chunk", every("chunks"))
    visitors = visits.join(sizes, ["label", "cell"]).withColumn("chunk", of("chunks")).withColumn("block", every("blocks"))
    keys = ["label", "cell", "block", "chunk"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return compare(left, right, cosine, number)

    found = base.materialize(
        residents.select(*keys, "class_id", "copies", "vector", "cells").groupBy(*keys)
        .cogroup(visitors.select(*keys, "class_id", "copies", "vector", "own").groupBy(*keys)).applyInArrow(meet, "class_id long, links long, root long"), "links")
    parts = graph.components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    named = classes.join(counts, "class_id", "left").join(parts.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    joined = taken.join(named, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("use")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op13_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_duplicates(base.table(spark, folder, "embeddings"))
