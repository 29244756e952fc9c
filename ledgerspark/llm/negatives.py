"""Hard-negative mining: exact integer scores by Strassen's multiplication, merged heaps of positives and of the windows below them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm import base

UNIT, ANCHOR_EVERY, POSITIVES, NEGATIVES = 256, 100, 5, 5
#: A negative's score is at least this share (in hundredths) of the positive's, and at most all of it.
LEAST, WHOLE = 80, 100
#: A cell holds up to so many candidates and anchors; below that, candidates are dealt out to all tasks in parts of ``LEAST_ROWS``.
CELL_ROWS, CELL_ANCHORS, LEAST_ROWS = 1 << 16, 1 << 13, 1 << 12
#: Anchors and candidates of a score tile; sides up to ``LEAF`` are multiplied directly.
TILE, LEAF = (256, 4096), 32
LOW, HIGH = -(2**63), 2**63 - 1


def _most(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The plain product; float64 holds it exactly where every sum stays below 2**53, else it is made in the numbers given."""
    if a.dtype != object and _most(a) * _most(b) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _padded(a: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if a.shape == (rows, columns):
        return a
    out = np.zeros((rows, columns), a.dtype)  # of objects: whole numbers, where np.pad would put numpy's own
    out[: a.shape[0], : a.shape[1]] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` by seven half-size products and exact additions, odd sides padded with a row or column of zeros.

    int64 sums may wrap on the way: the result is right modulo 2**64, and so right wherever it fits. Object arrays (whole
    numbers of any size) go the same way.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return _leaf(a, b)
    a, b = _padded(a, m + m % 2, k + k % 2), _padded(b, k + k % 2, n + n % 2)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * l), p1.dtype)
    out[:i, :l], out[:i, l:], out[i:, :l], out[i:, l:] = p1 + p4 - p5 + p7, p3 + p5, p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b as int64; products beyond a long are worked out in whole numbers of any size and cut to it."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = _padded(a, len(a), width), _padded(b, len(b), width)
    if _most(a) * _most(b) * width <= HIGH:
        return strassen(a, np.ascontiguousarray(b.T))
    return np.clip(strassen(a.astype(object), b.T.astype(object)), LOW, HIGH).astype(np.int64)


def dense(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of whole numbers; shorter rows end with zeros."""
    rows = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int64) for x in lists]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


class Heaps:
    """The ``k`` best (score, id) per key, ties to smaller ids. Heaps of parts merge into the heap of the whole."""

    def __init__(self, k: int):
        self.k = k
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def push(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        key, score, ids = np.concatenate([self.key, key]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, ~score, key))  # ~ turns the order round and cannot overflow
        key = key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        self.key, self.score, self.id = key[place < self.k], score[order][place < self.k], ids[order][place < self.k]

    def push_tile(self, key: np.ndarray, tile: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows of a tile whose columns rise in id: of a row only its k best can enter."""
        if tile.shape[1] > self.k:
            shown = np.where(allowed, tile, LOW)
            least = np.partition(shown, -self.k, axis=1)[:, -self.k][:, None]
            tie = allowed & (tile == least)
            allowed = allowed & (tile > least) | tie & (np.cumsum(tie, axis=1) <= self.k)
        row, column = np.nonzero(allowed)
        if len(row):
            self.push(key[row], tile[row, column], ids[column])


def usable(table: DataFrame, unit: int = UNIT) -> DataFrame:
    """(vec_id, label as text, x array<long>): floor(unit * component) of every row that takes part, one row per id."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    good = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    scaled = F.transform("embedding", lambda v: F.floor(v.cast("double") * unit))
    rows = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("string").alias("label"), scaled.alias("x")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.x")


def _sorted(candidates: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    candidates = candidates.sort_by("vec_id")
    return candidates["vec_id"].to_numpy(), dense(candidates["x"]), candidates["label"].to_pylist()


def _tiles(anchors: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    for i in range(0, len(anchors), TILE[0]):
        for j in range(0, len(candidates), TILE[1]):
            rows, columns = slice(i, i + TILE[0]), slice(j, j + TILE[1])
            yield rows, columns, scores(anchors[rows], candidates[columns])


def _positives(candidates: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    """A cell of one label: per anchor its k best other rows."""
    ids, x, _ = _sorted(candidates)
    own, q = anchors["vec_id"].to_numpy(), dense(anchors["x"])
    heaps = Heaps(k)
    for rows, columns, tile in _tiles(q, x):
        heaps.push_tile(own[rows], tile, ids[columns], own[rows][:, None] != ids[columns][None, :])
    return pa.table({"anchor_id": heaps.key, "vec_id": heaps.id, "score": heaps.score})


def _negatives(candidates: pa.Table, anchors: pa.Table, k: int, positives: int) -> pa.Table:
    """A cell of all labels: per anchor and place of a positive, the k best rows of other labels within the positive's window."""
    ids, x, labels = _sorted(candidates)
    own, q, found = anchors["vec_id"].to_numpy(), dense(anchors["x"]), anchors["found"].to_pylist()
    codes = {label: c for c, label in enumerate(dict.fromkeys(labels + anchors["label"].to_pylist()))}
    theirs, mine = (np.array([codes[c] for c in part], np.int64) for part in (labels, anchors["label"].to_pylist()))
    tops = np.array([[p[place] if place < len(p) else -1 for place in range(positives)] for p in found], np.int64).reshape(len(own), positives)
    heaps = [Heaps(k) for _ in range(positives)]
    for rows, columns, tile in _tiles(q, x):
        other = mine[rows][:, None] != theirs[columns][None, :]
        for place in range(positives):
            top = tops[rows, place][:, None]  # a negative top has no window: four fifths of it are above it
            inside = other & (tile <= top) & (tile >= LEAST * (top // WHOLE) - -LEAST * (top % WHOLE) // WHOLE) & (top >= 0)
            if inside.any():
                heaps[place].push_tile(own[rows], tile, ids[columns], inside)
    keys = np.concatenate([h.key for h in heaps])
    place = np.concatenate([np.full(len(h.key), p) for p, h in enumerate(heaps)]).astype(np.int32)
    return pa.table({"anchor_id": keys, "place": place, "vec_id": np.concatenate([h.id for h in heaps]), "score": np.concatenate([h.score for h in heaps])})


def mine(table: DataFrame, anchors: DataFrame | None = None, unit: int = UNIT) -> DataFrame:
    """(anchor_id, positive_id, rank int, negative_id, positive_score, negative_score): the hardest negatives of each anchor and positive.

    table has the columns vec_id, label and embedding. anchors (a column vec_id; the rows whose vec_id is divisible by
    ``ANCHOR_EVERY`` by default) names the rows that are mined for. Scores are inner products of floor(unit * component).
    An anchor's positives are its ``POSITIVES`` best other rows of the same label; its negatives for a positive are the
    ``NEGATIVES`` best rows of other labels with 80 to 100 hundredths of the positive's score. Ties go to the smaller vec_id.

    Null ids, labels and vectors, and vectors with null or non-finite components take no part; of rows with one id the smallest
    (label, vector) counts; missing components count as 0; scores beyond a long are cut to it; columns of other names are
    not read; no rows, or no anchors, give no rows. Candidates are dealt out by a hash of the id, so neither a common label nor a
    common vector is one task's; every cell keeps at most the first few per anchor, and the heaps of all cells are merged.
    """
    spark = table.sparkSession
    rows = base.materialize(usable(base.bounded_batches(table), unit), "candidates")
    asked = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    if anchors is not None:
        asked = rows.join(anchors.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))
    n, m = rows.count(), asked.count()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n or not m:
        return spark.createDataFrame([], out)
    ranges = max(-(-n // CELL_ROWS), min(-(-n // LEAST_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    chunks = -(-m // CELL_ANCHORS)

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    dealt = rows.withColumn("range", F.pmod(F.xxhash64("vec_id"), F.lit(ranges)).cast("int")).withColumn("chunk", every(chunks))
    cut = F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.lit(chunks)).cast("int")
    spread = asked.withColumn("chunk", cut).withColumn("range", every(ranges))

    def positive(left: pa.Table, right: pa.Table) -> pa.Table:
        return _positives(left, right, POSITIVES)

    def negative(left: pa.Table, right: pa.Table) -> pa.Table:
        return _negatives(left, right, NEGATIVES, POSITIVES)

    near = dealt.groupBy("label", "range", "chunk").cogroup(spread.groupBy("label", "range", "chunk")).applyInArrow(positive, "anchor_id long, vec_id long, score long")
    best = W.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(best) - 1).where(F.col("place") < POSITIVES)
    near = base.materialize(near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "place"), "positives")
    tops = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"]).alias("found"))
    ready = base.materialize(asked.join(tops, "vec_id"), "anchors").withColumn("chunk", cut).withColumn("range", every(ranges))
    hard = dealt.groupBy("range", "chunk").cogroup(ready.groupBy("range", "chunk")).applyInArrow(negative, "anchor_id long, place int, vec_id long, score long")
    first = W.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    hard = hard.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    return hard.join(near, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives for every hundredth vector, after the labels of every seventh were moved on by one."""
    rows = base.table(spark, folder, "embeddings")
    return mine(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
