"""Benchmark decontamination: pairs of near words lead from texts to test items, alignment scores the passages around them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerspark.llm import base

MATCH, MISMATCH, GAP = 2, -1, -1
#: A passage counts from half of the full score of its item; from 40 matching words on in any case.
CUT, LONG = 0.5, 40
#: Two matched words next to each other in an alignment add MATCH, less the errors between them: with so many words between
#: them, in the item or in the text, they add nothing.
ERROR = -max(MISMATCH, GAP)
FAR = -(-MATCH // ERROR)
#: Words of a text whose hits are held at once.
WORDS_AT_ONCE = 1 << 16
#: Words of test items that one pass over the corpus looks for; a larger benchmark takes several passes.
SLICE_WORDS = 1_500_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _firsts(code: np.ndarray, item: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Places of distinct (code, item) in this order, each with its smallest ``between``."""
    order = np.lexsort((between, item, code))
    code, item = code[order], item[order]
    return order[np.append(True, (np.diff(code) != 0) | (np.diff(item) != 0))[: len(order)]]


def least_score(n: int) -> float:
    """The score from which a passage leaks an item of n words."""
    return MATCH * min(CUT * n, LONG)


class Items:
    """A bounded slice of the benchmark: vocabulary, items as word numbers, and the word pairs that lead to them.

    An alignment of m matched words scores MATCH + the sum of MATCH - errors over its m - 1 steps from a match to the next.
    So the steps with less than ``FAR`` words between the matches add up to the least score - MATCH at least: that sum is
    what ``passages_of`` asks for (``need``), and no alignment at the cut has less. A step starts at most once at a word of
    the item, so the words that start the most common pairs of the benchmark are left out, as many as bring half of the sum
    at most, and the sum asked for is less by what they can bring. Items without need are led to by each of their words.
    """

    def __init__(self, rows: list[tuple]) -> None:
        self.vocabulary: dict[str, int] = {}
        number = self.vocabulary.setdefault
        self.words = [np.array([number(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64) for _, text in rows]
        self.base = len(self.vocabulary) + 1
        self.length = np.array([len(w) for w in self.words], np.int64)
        score = [math.ceil(least_score(n)) for n in self.length.tolist()]
        self.need = np.array([max(1, t - MATCH) for t in score], np.int64)
        # words of a text from the first to the last match of an alignment at the cut, or more.
        self.reach = self.length + np.array([max(0, MATCH * n - t) // ERROR for n, t in zip(self.length.tolist(), score)], np.int64)
        single = [t <= MATCH for t in score]
        starts = np.append(0, np.cumsum(self.length))
        parts = [(i, k, self.pairs(w, k)) for i, w in enumerate(self.words) if not single[i] for k in range(FAR)]
        none = [np.zeros(0, np.int64)]
        code = np.concatenate(none + [c for _, _, c in parts])
        item, between = (np.repeat(np.array([p[x] for p in parts], np.int64), [len(c) for _, _, c in parts]) for x in (0, 1))
        at = np.concatenate(none + [starts[i] + np.arange(len(c)) for i, _, c in parts])
        distinct, items = np.unique(code[_firsts(code, item, between)], return_counts=True)
        cost = np.bincount(at, items[np.searchsorted(distinct, code)], starts[-1])
        owner = np.repeat(np.arange(len(self.words)), self.length)
        startable = np.flatnonzero(np.arange(starts[-1]) < starts[owner + 1] - 1)
        ranked = startable[np.lexsort((startable, -cost[startable], owner[startable]))]
        rank = np.arange(len(ranked)) - np.searchsorted(owner[ranked], owner[ranked])
        out = np.where(single, 0, self.need // (2 * MATCH))
        left_out = np.zeros(starts[-1], bool)
        left_out[ranked[rank < out[owner[ranked]]]] = True
        self.need -= MATCH * out
        ones = [np.unique(w) * self.base if one else w[:0] for w, one in zip(self.words, single)]
        code = np.concatenate([code[~left_out[at]], *ones])
        item = np.concatenate([item[~left_out[at]], np.repeat(np.arange(len(ones)), [len(w) for w in ones])])
        between = np.append(between[~left_out[at]], np.zeros(len(code) - np.count_nonzero(~left_out[at]), np.int64))
        first = _firsts(code, item, between)
        self.item, self.between = item[first], between[first]
        self.codes, self.first, self.count = np.unique(code[first], return_index=True, return_counts=True)
        self.bits = max(10, (8 * len(self.codes)).bit_length())
        self.known = np.zeros(1 << self.bits, bool)
        self.known[self.short(self.codes)] = True
        self.singles = any(one and len(w) for one, w in zip(single, self.words))

    def short(self, codes: np.ndarray) -> np.ndarray:
        """A few bits of each code, for a first look."""
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def pairs(self, numbers: np.ndarray, between: int) -> np.ndarray:
        """One code for each word and the word after it, with so many words between them; 0 where either is of no item."""
        a, b = numbers[: max(0, len(numbers) - between - 1)], numbers[between + 1 :]
        return np.where((a > 0) & (b > 0), a * self.base + b, 0)

    def numbers(self, text: str) -> np.ndarray:
        """The text's words as numbers, 0 for words of no item."""
        known, parts = self.vocabulary.get, []
        for part in base.pieces(text.lower(), 1 << 20, lambda t, i: t[i].isspace()):
            parts.append(np.array([known(w, 0) for w in _WORD.findall(part)], np.int64))
        return np.concatenate(parts)

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in the text, what a step from there can add), in this order, of all pairs that both have."""
        out = []
        for between in [*range(FAR), *([-1] if self.singles else [])]:
            seen = self.pairs(numbers, between) if between >= 0 else numbers * self.base
            at = np.flatnonzero(seen)
            at = at[self.known[self.short(seen[at])]]
            k = np.minimum(np.searchsorted(self.codes, seen[at]), len(self.codes) - 1)
            same = self.codes[k] == seen[at]
            at, k = at[same], k[same]
            count = self.count[k]
            found = np.repeat(self.first[k] - np.append(0, np.cumsum(count)[:-1])[: len(k)], count) + np.arange(count.sum())
            adds = MATCH - ERROR * np.maximum(self.between[found], between) if between >= 0 else np.ones(len(found), np.int64)
            out.append((self.item[found], np.repeat(at, count), adds))
        item, place, adds = (np.concatenate(c) for c in zip(*out))
        order = np.lexsort((place, item))
        return item[order], place[order], adds[order]


def passages_of(items: Items, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, first word, word after the last) of passages that hold all alignments at the cut: around hits of an item that
    bring its need within its reach."""
    spans, most = [], int(items.reach.max(initial=0))
    for start in range(0, len(numbers), WORDS_AT_ONCE):
        item, place, adds = items.hits(numbers[start : start + WORDS_AT_ONCE + most + FAR + 1])
        if not len(item):
            continue
        reach, width = items.reach[item], len(numbers) + most + 1
        at = item * width + place
        last = np.searchsorted(at, at + reach, "right")
        total = np.append(0, np.cumsum(adds))
        here = np.flatnonzero(total[last] - total[:-1] >= items.need[item])
        spans.append((item[here], start + place[here] - reach[here], start + place[here] + 2 * reach[here] + FAR))
    if not spans:
        return
    item, low, high = (np.concatenate(c) for c in zip(*spans))
    order = np.lexsort((low, item))
    item, low, high = item[order], low[order], high[order]
    # reach, and so the width of a span, is the same for all spans of an item: the last one ends last
    cuts = np.flatnonzero((np.diff(item) != 0) | (low[1:] > high[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(item)]) if len(item) else ():
        yield int(item[a]), max(0, int(low[a])), min(len(numbers), int(high[b - 1]))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman: the best local score of two word sequences and the place after its last word in the passage.
    0 in the passage is a word that no item has."""
    width = len(passage)
    ramp = -GAP * np.arange(width + 1)
    row, best, end = np.zeros(width + 1, np.int64), 0, 0
    for word in item.tolist():
        step = np.empty_like(row)
        step[0] = 0
        np.maximum(row[:-1] + np.where(passage == word, MATCH, MISMATCH), row[1:] + GAP, out=step[1:])
        np.maximum(step, 0, out=step)
        row = np.maximum.accumulate(step + ramp) - ramp
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
    return best, end


def leaks_of(items: Items, numbers: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, first word, word after the last) of the best alignment of each item that the text leaks, as a share of
    the item's full score; of equal ones the first."""
    best: dict[int, tuple[int, int, int]] = {}
    for i, a, b in passages_of(items, numbers):
        own, part = items.words[i], numbers[a:b]
        score, end = align(own, part)
        if score >= least_score(len(own)) and score > best.get(i, (0,))[0]:
            best[i] = score, a + end - align(own[::-1], part[:end][::-1])[1], a + end
    for i, (score, start, end) in best.items():
        yield i, min(1.0, score / (MATCH * len(items.words[i]))), start, end


def leaked(docs: DataFrame, items: Items, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_key, row, item, score, start, end, passage): what each row of ``docs`` leaks. text_key is a hash of the
    whole text, row numbers the rows of ``docs``, start and end count characters."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = pa.schema([
        (id_col, to_arrow_type(docs.schema[id_col].dataType)), ("text_key", pa.int64()), ("row", pa.int64()), ("item", pa.int32()), ("score", pa.float64()),
        ("start", pa.int32()), ("end", pa.int32()), ("passage", pa.string())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in it:
                for key, text_key, row, text in zip(batch.column(0), batch.column(1), batch.column(2), base.texts(batch)):
                    found = list(leaks_of(items, items.numbers(text)))
                    if found:
                        low = text.lower()
                        shown = text if len(low) == len(text) else low
                        needed = {p for _, _, a, b in found for p in (a, b - 1)}
                        spans = {k: m.span() for k, m in enumerate(_WORD.finditer(low)) if k in needed}
                        for i, score, a, b in found:
                            start, end = spans[a][0], spans[b - 1][1]
                            yield key.as_py(), text_key.as_py(), row.as_py(), i, score, start, end, shown[start:end]

        yield from base.batches(rows(), schema, bytes_at_once=4 << 20)

    frame = base.bounded_batches(docs).select(docs[id_col], F.xxhash64(docs[text_col]).alias("text_key"), F.monotonically_increasing_id().alias("row"), docs[text_col].alias("text"))
    return frame.mapInArrow(run, f"`{id_col}` {kind}, text_key long, row long, item int, score double, start int, end int, passage string")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_key, item_id, score, start, end, passage): the best passage of each document for each item it leaks.

    One pass over the corpus per slice of the benchmark (one slice up to ``SLICE_WORDS`` words) finds the passages that can
    reach the cut and aligns them. Null or empty texts and items without words match nothing; repeated rows are reported
    each; a null item id is an item like others. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    slices, out = -(-size // SLICE_WORDS), None
    for k in range(slices):
        rows = [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text").collect()]
        own = Items(rows)
        if not len(own.codes):
            continue
        numbered = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(rows)], "item int, item_id " + items.schema["item_id"].dataType.simpleString())
        found = base.materialize(leaked(docs, own, id_col, text_col), "leaks")
        part = found.join(numbered, "item").select(id_col, "text_key", "row", "item_id", "score", "start", "end", "passage")
        out = part if out is None else out.unionByName(part)
    if out is None:
        kinds = docs.schema[id_col].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kinds[0]}, text_key long, item_id {kinds[1]}, score double, start int, end int, passage string")
    best = F.max_by(F.struct("score", "start", "end", "passage"), F.struct("score", -F.col("start"))).alias("best")
    return out.groupBy("row", id_col, "text_key", "item_id").agg(best).select(id_col, "text_key", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, with all their columns. What a text leaks depends on the text alone, so rows
    are told apart by a hash of the whole text."""
    key = base.unused(docs.columns, "text_key")
    leaks = base.materialize(contaminated(docs, benchmark, id_col, text_col).select(F.col("text_key").alias(key)).distinct(), "leaks")
    return docs.withColumn(key, F.xxhash64(docs[text_col])).join(leaks, key, "left_anti").select(*docs.columns)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every leaked item of every document."""
    return contaminated(base.table(spark, folder, "documents"), base.table(spark, folder, "benchmark")).drop("text_key")
