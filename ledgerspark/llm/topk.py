"""Exact top-k search by inner product: block-at-a-time pruning over document-range blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm import base

K, QUERY_EVERY, UNIT = 20, 20, 64
#: Documents per block, and blocks that a query scores before it looks at its bounds again (doubled each time).
BLOCK, FIRST = 64, 2
#: Sample (by hash) that the order of documents is fitted on and that gives each query its first bound; its clusters.
SAMPLE, CLUSTERS = 2048, 48
#: A cell of the search holds up to so many documents and queries.
CELL_ROWS, CELL_QUERIES, LEAST_QUERIES = 1 << 18, 1 << 16, 256
_BLOCKS = "place long, ids binary, forward binary, width int, terms int, upper binary, lower binary"


def vectors(table: DataFrame, unit: int = UNIT) -> DataFrame:
    """(vec_id, x array<long>): floor(unit * component) of every usable vector, one row per id.

    Left out: null ids, null vectors, vectors with a null or non-finite component. An id that is there more than once keeps
    its smallest vector. Shorter vectors lack terms, which counts as 0; an empty vector scores 0 with every query.
    """
    scaled = F.transform("embedding", lambda v: F.floor(v.cast("double") * unit))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    good = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))


def matrix(lists: pa.ChunkedArray | pa.ListArray, terms: int | None = None) -> np.ndarray:
    """Rows of whole numbers; missing terms are 0."""
    arrays = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64) for x in lists]
    out = np.zeros((len(arrays), max([terms or 0, *(len(a) for a in arrays)])), np.int64)
    for k, a in enumerate(arrays):
        out[k, : len(a)] = a
    return out


def _wide(a: np.ndarray, terms: int) -> np.ndarray:
    return a if a.shape[1] == terms else np.pad(a, ((0, 0), (0, terms - a.shape[1])))


def exact(a: np.ndarray, b: np.ndarray) -> type:
    """A number type in which every inner product of rows of a and b, and every bound, is exact."""
    most = [max(1, abs(int(x.min())), abs(int(x.max()))) if x.size else 1 for x in (a, b)]
    size = most[0] * most[1] * max(1, a.shape[1]) * 2
    return np.float32 if size < 1 << 24 else np.float64 if size < 1 << 53 else object


def centres(sample: np.ndarray, clusters: int = CLUSTERS, rounds: int = 8) -> np.ndarray:
    """k-means on the sample. It only decides the order of documents, never a result."""
    x = sample.astype(np.float64)
    found = x[:: max(1, len(x) // clusters)][:clusters].copy()
    for _ in range(rounds):
        near = (x @ found.T - 0.5 * (found**2).sum(axis=1)).argmax(axis=1) if len(x) else np.zeros(0, int)
        for c in range(len(found)):
            if (near == c).any():
                found[c] = x[near == c].mean(axis=0)
    return found


def blocks(rows: DataFrame, centre: np.ndarray) -> DataFrame:
    """Document-range blocks of ``rows``: documents are ordered by nearest centre and id in ranges; a block is a run of up to
    ``BLOCK`` of one centre, with its forward index and the largest and smallest value of each term."""

    def near(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = matrix(batch.column(1), centre.shape[1])[:, : centre.shape[1]].astype(np.float64)
            at = (x @ centre.T - 0.5 * (centre**2).sum(axis=1)).argmax(axis=1).astype(np.int32) if len(centre) else np.zeros(len(x), np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=["vec_id", "x", "centre"])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(ids, x, centre):
            start = 0
            while start < len(ids):
                end = min(start + BLOCK, int(np.searchsorted(centre, centre[start], "right")))
                part = x[start:end]
                width = 2 if not part.size or max(abs(int(part.min())), abs(int(part.max()))) < 1 << 15 else 8
                yield (int(ids[start]), ids[start:end].tobytes(), part.astype(f"i{width}").tobytes(), width, x.shape[1],
                       part.max(axis=0).astype(np.int64).tobytes(), part.min(axis=0).astype(np.int64).tobytes())
                start = end

        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary(), "int": pa.int32()}[k]) for n, k in (c.split() for c in _BLOCKS.split(", "))])
        for batch in it:
            yield from base.batches(out(batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy()), schema)

    ordered = rows.mapInArrow(near, "vec_id long, x array<long>, centre int").repartitionByRange("centre", "vec_id").sortWithinPartitions("centre", "vec_id")
    return ordered.mapInArrow(cut, _BLOCKS)


def search_cell(blocks: pa.Table, queries: pa.Table, k: int = K) -> Iterator[tuple[int, int, int]]:
    """(query_id, vec_id, score): per query the k best documents of the cell's blocks, ties to smaller ids.

    Per query: blocks in order of their bounds (the sum over terms of the best that the block's largest or smallest value
    can give), scored through their forward indexes until the next bound falls below the k-th score so far. The k-th score
    starts at ``floor``, which k documents of the whole table are known to reach.
    """
    terms = max(blocks.column("terms").to_pylist())
    x = matrix(queries.column("x"))
    terms = max(terms, x.shape[1])
    x = _wide(x, terms)
    ids, rows, upper, lower, starts = [], [], [], [], [0]
    for place in range(blocks.num_rows):
        b = {n: blocks.column(n)[place] for n in blocks.column_names}
        own, width = b["terms"].as_py(), b["width"].as_py()
        ids.append(np.frombuffer(b["ids"].as_py(), np.int64))
        n = len(ids[-1])
        rows.append(_wide(np.frombuffer(b["forward"].as_py(), f"i{width}").reshape(n, own), terms))
        upper.append(np.pad(np.frombuffer(b["upper"].as_py(), np.int64), (0, terms - own)))
        lower.append(np.pad(np.frombuffer(b["lower"].as_py(), np.int64), (0, terms - own)))
        starts.append(starts[-1] + n)
    ids, forward = np.concatenate(ids), np.concatenate(rows)
    upper, lower, starts = np.stack(upper), np.stack(lower), np.array(starts)
    wide = np.stack([upper.max(axis=0), lower.min(axis=0)])
    kind = exact(x, wide)
    forward, upper, lower, x = (a.astype(kind) for a in (forward, upper, lower, x))
    floors, keys = queries.column("floor").to_pylist(), queries.column("vec_id").to_pylist()
    for start in range(0, len(keys), 512):
        part = x[start : start + 512]
        bounds = np.maximum(part, 0) @ upper.T + np.minimum(part, 0) @ lower.T
        for own, q, bound, floor in zip(keys[start : start + 512], part, bounds, floors[start : start + 512]):
            order = np.argsort(-bound, kind="stable")
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, kind)
            least, at, step = floor, 0, FIRST
            while at < len(order):
                chosen = order[at : at + step]
                if least is not None:
                    chosen = chosen[: int((bound[chosen] >= least).sum())]  # bounds fall along the order
                if not len(chosen):
                    break
                if 4 * len(chosen) > len(starts):
                    lo, hi = int(chosen.min()), int(chosen.max()) + 1  # most blocks: one contiguous stretch
                    inside = np.zeros(len(starts) - 1, bool)
                    inside[chosen] = True
                    rows = np.flatnonzero(np.repeat(inside[lo:hi], np.diff(starts[lo : hi + 1]))) + starts[lo]
                    scores = (forward[starts[lo] : starts[hi]] @ q)[rows - starts[lo]]
                else:
                    rows = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in chosen.tolist()])
                    scores = forward[rows] @ q
                keep = ids[rows] != own
                if least is not None:
                    keep &= scores >= least
                best_ids, best = np.concatenate([best_ids, ids[rows[keep]]]), np.concatenate([best, scores[keep]])
                if len(best) > k:
                    first = np.lexsort((best_ids, -best))[:k]
                    best_ids, best = best_ids[first], best[first]
                if len(best) >= k:
                    least = best.min() if least is None else max(least, best.min())
                at, step = at + step, step * 2
            for vec, score in zip(best_ids.tolist(), best.tolist()):
                yield own, vec, min(max(int(score), -(2**63)), 2**63 - 1)


def top_k(table: DataFrame, queries: DataFrame | None = None, k: int = K, unit: int = UNIT) -> DataFrame:
    """(query_id, rank int, vec_id, score): the k documents with the largest inner products for each query, but not itself.

    table and queries have the columns vec_id and embedding; queries (the rows whose vec_id is divisible by
    ``QUERY_EVERY`` by default) meet all documents in cells of a block range and a chunk of queries, each of bounded size.
    The result is exact: a bounded sample only gives the documents an order and the queries a first bound that k
    documents reach. Ties go to the smaller vec_id; scores beyond a long are cut to it. Fewer than k documents: all of them.
    """
    spark = table.sparkSession
    rows = base.materialize(vectors(base.bounded_batches(table), unit), "vectors")
    asked = rows.where(F.col("vec_id") % QUERY_EVERY == 0) if queries is None else base.materialize(vectors(queries, unit), "queries")
    n, m = rows.count(), asked.count()
    out = "query_id long, rank int, vec_id long, score long"
    if not n or not m:
        return spark.createDataFrame([], out)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    known, known_ids = matrix(drawn.column("x")), drawn.column("vec_id").to_numpy()

    def bounded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's k-th best score within the sample."""
        for batch in it:
            x, own = matrix(batch.column(1), known.shape[1]), batch.column(0).to_numpy()
            wide = _wide(known, x.shape[1])
            kind = exact(x, wide)
            floors = []
            for q, key in zip(x.astype(kind), own):
                scores = (wide.astype(kind) @ q)[known_ids != key]
                floors.append(max(int(np.sort(scores)[-k]), -(2**63)) if len(scores) >= k and int(np.sort(scores)[-k]) < 2**63 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(floors, pa.int64())], names=["vec_id", "x", "floor"])

    ranges = -(-n // CELL_ROWS)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(-(-m // CELL_QUERIES), min(-(-m // LEAST_QUERIES), -(-tasks // ranges)))
    every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    left = blocks(rows, centres(known)).withColumn("range", F.pmod(F.xxhash64("place"), F.lit(ranges))).withColumn("chunk", every)
    right = asked.mapInArrow(bounded, "vec_id long, x array<long>, floor long").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int"))
    right = right.withColumn("range", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ranges - 1).cast("long"))))

    def cell(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        found = list(search_cell(blocks, queries, k)) if blocks.num_rows and queries.num_rows else []
        return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] or [[], [], []], schema=schema)

    found = left.groupBy("range", "chunk").cogroup(right.groupBy("range", "chunk")).applyInArrow(cell, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best rows for every row whose vec_id is divisible by 20."""
    return top_k(base.table(spark, folder, "embeddings"))
