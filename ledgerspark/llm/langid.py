"""Language identification: averaged embeddings of hashed subwords and a linear softmax, fitted by SGD in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base

#: Labelled documents per language that the model is fitted on (about; chosen by a hash of the id), and languages at most.
SAMPLE_PER_LANGUAGE, LANGUAGES = 700, 300
#: Windows of whole sample texts that a document gives at most, and their lengths in letters.
WINDOWS, LENGTHS = 12, (8, 24, 60, 160)
#: Windows that reach the driver at most, whatever the number of languages.
WINDOWS_IN_ALL = 50_000
SIZES = (2, 3, 4)
BUCKETS, DIMENSIONS = 1 << 16, 16
EPOCHS, STEP, MINIBATCH = 4, 0.5, 32
#: Share of rightly predicted calibration texts that rejection may cost, and the highest score that is ever rejected.
REJECT_SHARE, REJECT_BELOW = 0.0005, 0.4
UNKNOWN = "und"
#: Letters handled at once: longer texts go through in pieces.
AT_ONCE = 1 << 18


@dataclass
class Model:
    """table: each subword's embedding already multiplied by the softmax weights (the average commutes with it)."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0


def letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank for whatever is no letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    known = np.full(0x110000, 32, np.uint32)
    for p in points.tolist():
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            known[p] = ord(low[0])
    return known


def _mixed(n: int) -> list[np.uint64]:
    """Odd multipliers by rule, one per place of a subword."""
    return [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1 + 16 * n)) % 2**64 | 1) for i in range(n)]


_FACTORS = {n: _mixed(n) for n in SIZES}


def subwords(points: np.ndarray) -> np.ndarray:
    """Buckets of all subwords of 2 to 4 signs; a word's borders count as signs, no subword reaches into the next word."""
    out = []
    wide = points.astype(np.uint64)
    blank = points == 32
    for n, factors in _FACTORS.items():
        m = len(points) - n + 1
        if m <= 0:
            continue
        mixed = wide[:m] * factors[0]
        for i in range(1, n):
            mixed += wide[i : i + m] * factors[i]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        inner = np.zeros(m, bool)
        for i in range(1, n - 1):
            inner |= blank[i : i + m]
        inner |= blank[:m] & blank[n - 1 : n - 1 + m] if n == 2 else False
        out.append((mixed >> np.uint64(48)).astype(np.int32)[~inner])
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def signs(text: str, known: np.ndarray) -> np.ndarray:
    """The text's letters in lower case between blanks."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([[32], known[points], [32]]).astype(np.uint32)


def average(text: str, known: np.ndarray, table: np.ndarray) -> np.ndarray | None:
    """Mean table row of a whole text's subwords; None without a letter."""
    total, n = np.zeros(table.shape[1]), 0
    for part in base.pieces(text, AT_ONCE, lambda t, i: t[i] == " "):
        for start in range(0, max(len(part), 1), AT_ONCE):  # a longer word is cut
            points = signs(part[start : start + AT_ONCE], known)
            if (points != 32).any():
                found = subwords(points)
                seen = np.bincount(found, minlength=BUCKETS) if len(found) > 4 * BUCKETS else None
                total += seen @ table if seen is not None else table[found].sum(axis=0, dtype=np.float64)
                n += len(found)
    return total / n if n else None


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def predict(model: Model, text: str, known: np.ndarray) -> tuple[str, float]:
    mean = average(text, known, model.table) if model.languages else None
    if mean is None:
        return UNKNOWN, 0.0
    p = softmax((mean + model.bias) / model.temperature)
    best = int(p.argmax())
    return model.languages[best], float(p[best])


def fit(docs: DataFrame, seed: int = 7) -> Model:
    """Learns from text and lang of rows with a language outside the held-out part.

    A bounded sample: about ``SAMPLE_PER_LANGUAGE`` documents of each of the ``LANGUAGES`` most frequent languages, of each
    up to ``WINDOWS`` windows from anywhere in the whole text. A quarter of the documents is set aside to fit the
    temperature and the score below which a prediction is rejected. No rows, or one language: it is predicted for every
    text with letters (``und`` if there is none).
    """
    labelled = base.bounded_batches(docs).select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~base.held_out())
    per = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    languages = sorted(r["lang"] for r in per)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    chance = F.element_at(F.create_map(*[F.lit(x) for r in per for x in (r["lang"], min(1.0, 1.3 * SAMPLE_PER_LANGUAGE / r["count"]))]), F.col("lang"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)

    def windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("aside", pa.bool_()), ("text", pa.string())])

        def rows():
            for batch in it:
                for lang, aside, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), base.texts(batch)):
                    rng = np.random.default_rng(key % 2**63)
                    for k in range(min(WINDOWS, 1 + len(text) // 40)):
                        length = LENGTHS[k % len(LENGTHS)]
                        start = int(rng.integers(0, max(1, len(text) - length)))
                        start = text.rfind(" ", 0, start) + 1 if start else 0
                        yield lang, aside, text[start : start + length]

        yield from base.batches(rows(), schema)

    taken = (
        labelled.where(drawn < chance).where(F.col("lang").isin(languages))
        .select("lang", (F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4)) == 0).alias("aside"), "doc_id", "text")
        .mapInArrow(windows, "lang string, aside boolean, text string")
        .orderBy(F.xxhash64("text"), "text", "lang").limit(WINDOWS_IN_ALL).collect()
    )
    known = letters()
    place = {x: i for i, x in enumerate(languages)}
    rows = [(place[r["lang"]], r["aside"], subwords(points)) for r in taken if ((points := signs(r["text"], known)) != 32).any()]
    train = [(y, x) for y, aside, x in rows if not aside]
    aside = [(y, x) for y, aside, x in rows if aside] or train
    table, bias = _sgd(train, len(languages), seed)
    model = Model(languages, table, bias)
    if aside:
        _calibrate(model, aside)
    return model


def _sgd(rows: list[tuple[int, np.ndarray]], classes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    embed = (rng.random((BUCKETS, DIMENSIONS), np.float32) - 0.5) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, classes), np.float32), np.zeros(classes, np.float32)
    share = np.bincount([y for y, _ in rows], minlength=classes).astype(np.float32)
    scale = (share.sum() / np.maximum(share, 1) / classes).astype(np.float32)  # all languages weigh the same
    steps, total = 0, max(1, EPOCHS * -(-len(rows) // MINIBATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), MINIBATCH):
            part = [rows[i] for i in order[start : start + MINIBATCH]]
            y = np.array([a for a, _ in part])
            n = np.array([len(x) for _, x in part])
            at = np.concatenate([x for _, x in part])
            mean = np.add.reduceat(embed[at], np.append(0, np.cumsum(n)[:-1]), axis=0) / n[:, None]
            error = softmax(mean @ weights + bias)
            error[np.arange(len(y)), y] -= 1
            error *= scale[y][:, None]
            step = STEP * (1 - steps / total)
            back = error @ weights.T / n[:, None]
            weights -= step * mean.T @ error
            bias -= step * 0.1 * error.sum(axis=0)
            order_at = np.argsort(at, kind="stable")
            places, first = np.unique(at[order_at], return_index=True)
            embed[places] -= step * 4 * np.add.reduceat(np.repeat(back, n, axis=0)[order_at], first, axis=0)
            steps += 1
    return (embed @ weights).astype(np.float32), bias.astype(np.float64)


def _calibrate(model: Model, rows: list[tuple[int, np.ndarray]]) -> None:
    """The temperature that gives the held-back windows the highest likelihood, then the rejected share of right ones."""
    y = np.array([a for a, _ in rows])
    z = np.stack([model.table[x].mean(axis=0) + model.bias for _, x in rows]).astype(np.float64)
    best = None
    for temperature in np.geomspace(0.2, 5, 40):
        p = softmax(z / temperature)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
        if best is None or loss < best:
            best, model.temperature = loss, float(temperature)
    p = softmax(z / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    model.threshold = min(REJECT_BELOW, float(np.quantile(right, REJECT_SHARE))) if len(right) else 0.0


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, accepted) of every whole text.

    ``und`` with score 0 for null texts and texts without a letter (and where nothing was learned). accepted is false for
    those and for scores below the calibrated threshold. Repeated rows are judged each, a null id stays null.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = letters()
        for batch in it:
            got = [predict(model, text, known) for text in base.texts(batch, text_col)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[0] != UNKNOWN and g[1] >= model.threshold for g in got], pa.bool_())],
                names=[id_col, "lang_pred", "score", "accepted"])

    return base.bounded_batches(docs).select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, accepted boolean")


def drop_rejected(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is recognised, with all their columns."""
    at = docs.columns.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = letters()
        for batch in it:
            got = (predict(model, text.as_py() or "", known) for text in batch.column(at))
            yield batch.filter(pa.array([lang != UNKNOWN and score >= model.threshold for lang, score in got], pa.bool_()))

    return base.bounded_batches(docs).mapInArrow(run, docs.schema)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    docs = base.table(spark, folder, "documents")
    found = identify(docs, fit(docs))
    return found.select("doc_id", base.held_out().alias("held_out"), "lang_pred", "score", "accepted")
