"""Toxic passages: maximum-scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base

#: Labelled documents that the classifier is fitted on at most (those with the smallest hashes of their ids).
SAMPLE = 16_000
#: A quarter of them calibrates; the others give the token counts.
CALIBRATE_EVERY = 4
#: Tokens with their own weight at most, and the z-score they need.
VOCABULARY, MIN_Z = 20_000, 2.5
#: Strength of the Dirichlet prior: so many words with the pooled frequencies, as a share of the sample's words.
PRIOR = 0.05
#: Taken off every other word's weight, so that a passage ends where toxic words get rare.
DRIFT = 0.02
#: Passages are significant up to this chance of one as good in a clean document of the same length.
ALPHA = 0.05
CUT = 0.3
PREFIXES = range(3, 7)
_WORD = re.compile(r"\w+")
PASSAGES = "array<struct<start:int,end:int,score:double,p:double>>"


def tokens_of(word: str) -> list[str]:
    """A word counts as itself and by its first 3 to 6 letters, which words of one stem share."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


@dataclass
class Model:
    """Weights of tokens; ``rest`` is that of any other word. rate and scale are lambda and K of the extreme-value law."""

    weights: dict[str, float] = field(default_factory=dict)
    rest: float = -1.0
    rate: float = 1.0
    scale: float = 1.0
    curve: tuple[float, float, float] = (0.0, 0.0, -20.0)


class Words(dict):
    """Weight by word, worked out at its first sight: that of its token with the largest weight."""

    def __init__(self, model: Model) -> None:
        self.known, self.rest = model.weights, model.rest

    def __missing__(self, word: str) -> float:
        if len(self) > 100_000:
            self.clear()
        self[word] = found = max((self.known[t] for t in tokens_of(word) if t in self.known), default=self.rest)
        return found


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in one pass over the positive weights (linear time)."""
    sums = np.cumsum(weights)
    hits = np.flatnonzero(weights > 0)
    before, after = (sums[hits] - weights[hits]).tolist(), sums[hits].tolist()
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, the last one below that starts lower
    for at, low, high in zip(hits.tolist(), before, after):
        start, j = at, len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= low:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= high:
                break
            start, low = stack[j][0], stack[j][2]
            del stack[j:]
            j -= 1
        stack.append((start, at + 1, low, high, j))
    return [(s, e, high - low) for s, e, low, high, _ in stack]


def evidence(model: Model, words: Words, text: str) -> tuple[float, float, list[tuple]]:
    """Sum of the significant passages' normalised scores, their share of the words, and the passages by characters."""
    found = _WORD.findall(text.lower())
    if not found:
        return 0.0, 0.0, []
    weights = np.fromiter(map(words.__getitem__, found), np.float64, len(found))
    if not (weights > 0).any():
        return 0.0, 0.0, []
    base_line = math.log(model.scale * len(found))
    total, covered, kept = 0.0, 0.0, []
    for start, end, score in segments(weights):
        bits = model.rate * score - base_line
        p = -math.expm1(-math.exp(min(-bits, 50.0)))
        if p <= ALPHA:
            total += bits
            covered += float((weights[start:end] > 0).sum())
            kept.append((start, end, score, p))
    if not kept:
        return 0.0, 0.0, []
    places = [m.span() for m in _WORD.finditer(text.lower())] if len(text.lower()) == len(text) else None
    if places is None or len(places) != len(found):
        places = [m.span() for m in _WORD.finditer(text)]
    last = len(places) - 1
    return total, covered / len(found), [(places[min(s, last)][0], places[min(e - 1, last)][1], x, p) for s, e, x, p in kept]


def chance(model: Model, total: float, share: float) -> float:
    a, b, c = model.curve
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, a * math.log1p(total) + b * math.log1p(100 * share) + c))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from the labelled rows outside the held-out part: at most ``sample`` of them, chosen by a hash of the id.

    Rows without an id or label are left out; of several labels of an id the largest counts. Without both labels among
    the rows nothing can be learned, and every score is near 0.
    """
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~base.held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATE_EVERY)) == 0
    rows = base.materialize(
        base.bounded_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select((F.col("label") > 0).cast("int").alias("label"), fold.alias("aside"), F.coalesce("text", F.lit("")).alias("text")), "labelled")

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("token", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def out():
            of: dict[str, list[int]] = {"": [0, 0]}
            for k in (0, 1):
                for word, n in seen[k].items():
                    of[""][k] += n
                    for token in tokens_of(word):
                        of.setdefault(token, [0, 0])[k] += n
                seen[k].clear()
            return ((token, toxic, clean) for token, (clean, toxic) in of.items())

        for batch in it:
            for label, text in zip(batch.column(0).to_pylist(), base.texts(batch)):
                seen[label].update(set(_WORD.findall(text.lower())))  # a document counts once
            if len(seen[0]) + len(seen[1]) > 150_000:
                yield from base.batches(out(), schema, at_once=20_000)
        yield from base.batches(out(), schema, at_once=20_000)

    counts = base.materialize(
        rows.where("not aside").select("label", "text").mapInArrow(count, "token string, toxic long, clean long")
        .groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "tokens")
    whole = counts.where("token = ''").first()
    if whole is None or not whole["toxic"] or not whole["clean"]:
        return Model()
    n1, n0 = float(whole["toxic"]), float(whole["clean"])
    y1, y0 = F.col("toxic").cast("double"), F.col("clean").cast("double")
    prior, strength = (y1 + y0) * PRIOR, PRIOR * (n1 + n0)
    a1, a0 = y1 + prior, y0 + prior
    odds = F.log(a1 / (n1 + strength - a1)) - F.log(a0 / (n0 + strength - a0))
    best = (
        counts.where("token <> ''").select("token", odds.alias("odds"), (odds / F.sqrt(1 / a1 + 1 / a0)).alias("z"), a0.alias("a0"), "toxic", "clean")
        .where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "token").limit(VOCABULARY).collect()
    )
    weights = {r["token"]: r["odds"] for r in best}
    words = [r for r in best if not r["token"].endswith("*")]
    mass1 = min(0.5, sum(r["toxic"] for r in words) / n1)
    mass0 = min(0.5, sum(r["clean"] for r in words) / n0)
    model = Model(weights, min(math.log((1 - mass1) / (1 - mass0)), 0.0) - DRIFT)
    model.rate = _rate([(r["a0"] / (n0 + strength), r["odds"]) for r in words], model.rest)
    base.discard(counts)
    _calibrate(model, rows.where("aside").select("label", "text"))
    base.discard(rows)
    return model


def _rate(odds: list[tuple[float, float]], rest: float) -> float:
    """The positive lambda with mean exp(lambda * weight) = 1 under the clean documents' word frequencies."""
    left = 1 - sum(p for p, _ in odds)

    def excess(x: float) -> float:
        return left * math.exp(x * rest) + sum(p * math.exp(min(x * s, 300.0)) for p, s in odds) - 1

    low, high = 0.0, 8.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 0.05)


def _calibrate(model: Model, rows: DataFrame) -> None:
    """K from the passages of clean documents, then a logistic curve of the evidence, moved so that its best cut is CUT."""

    def clean_hits(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in it:
            n = expected = 0.0
            for text in base.texts(batch):
                found = _WORD.findall(text.lower())
                n += len(found)
                weights = np.fromiter(map(words.__getitem__, found), np.float64, len(found))
                expected += float(sum(1 for _, _, s in segments(weights) if model.rate * s >= 3.0)) if len(found) else 0.0
            yield pa.RecordBatch.from_pydict({"words": [n], "hits": [expected]})

    seen = rows.where("label = 0").select("text").mapInArrow(clean_hits, "words double, hits double").agg(F.sum("words"), F.sum("hits")).first()
    if seen[0]:
        model.scale = min(1.0, max(1e-3, (seen[1] + 1) / seen[0] * math.exp(3.0)))

    def features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in it:
            got = [evidence(model, words, text)[:2] for text in base.texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([g[k] for g in got], pa.float64()) for k in (0, 1))], names=["label", "total", "share"])

    held = rows.mapInArrow(features, "label int, total double, share double").collect()  # a quarter of the sample
    if not held:
        return
    y = np.array([r["label"] for r in held], float)
    x = np.array([[math.log1p(r["total"]), math.log1p(100 * r["share"]), 1.0] for r in held])
    w = np.zeros(3)
    for _ in range(50):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(3), x.T @ (y - p) - 0.05 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    order = np.argsort(-(x @ w), kind="stable")
    z, hit = (x @ w)[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + max(y.sum(), 1))
    f1[:-1][z[:-1] == z[1:]] = -1  # a cut lies between different values only
    k = int(np.argmax(f1))
    cut = (z[k] + (z[k + 1] if k + 1 < len(z) else z[k] - 2)) / 2
    model.curve = (w[0], w[1], w[2] - cut + math.log(CUT / (1 - CUT)))


def toxic_passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score double, passages) of every whole text: the passages' places in characters, scores and chances.

    Null and empty texts have no passage and the score of a text without any. Repeated rows are scored each; a null id
    stays null; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p", pa.float64())]))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in it:
            got = [evidence(model, words, text) for text in base.texts(batch, text_col)]
            scores = [chance(model, total, share) for total, share, _ in got]
            found = [[{"start": s, "end": e, "score": x, "p": p} for s, e, x, p in places] for *_, places in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(found, item)], names=[id_col, "score", "passages"])

    return base.bounded_batches(docs).select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {kind}, score double, passages {PASSAGES}")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose whole text scores below ``cut``, with all their columns."""
    at = docs.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        for batch in it:
            keep = [chance(model, *evidence(model, words, text.as_py() or "")[:2]) < cut for text in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return base.bounded_batches(docs).mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score and prediction of every document, with the number of its significant passages."""
    docs = base.table(spark, folder, "documents")
    model = fit(docs, base.table(spark, folder, "labels"))
    found = toxic_passages(docs, model)
    return found.select("doc_id", base.held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
