"""Full-text search through word posting lists: an index that is built once, grows by appended batches and is merged now and then.

An index is a folder of generations. A generation has three tables: ``postings`` (word, id, positions), partitioned by ranges of
words and sorted by (word, id), so that a search reads the row groups of its words only; a common word is cut into several ranges;
``terms`` (word, documents); and ``ids``, written last, which makes the generation count. ``base-<n>`` holds everything up to
batch n, ``batch-<n>`` one appended batch. A document that is appended again replaces its earlier text.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import check_word

#: Words are runs of letters, marks and digits, lower-cased.
BETWEEN_WORDS = r"[^\p{L}\p{M}\p{N}]+"
#: Words that a task lists at once; documents that the ranges of a generation are drawn from.
WORDS_AT_ONCE, SAMPLE = 500_000, 2000


def postings(df: DataFrame, key: str, text: str, bounds: list[tuple[str, int]] | None = None) -> DataFrame:
    """(word, id, positions, range): where each word stands in each document, counted in words from 0. NULL texts have no words.

    The task that reads a document makes its rows, so nothing is shuffled here. ``bounds`` are the sorted beginnings (word, hash
    of the id) of the ranges from the second on; the rows of a common word fall into several of them.
    """
    words = F.filter(F.split(F.lower(F.col(text)), BETWEEN_WORDS), lambda w: w != "")
    kind = df.schema[key].dataType.simpleString()
    bound_words, bound_hashes = [b[0] for b in bounds or []], np.array([b[1] for b in bounds or []], np.int64)

    def rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ends = batch.column(2).offsets.to_numpy()
            at = 0
            while at < batch.num_rows:  # so many documents at once that their words stay within a bound, one at least
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + WORDS_AT_ONCE, "right")) - 1)
                yield from listed(batch.slice(at, min(to, batch.num_rows) - at))
                at = to

    def listed(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = part.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        if not sizes.sum():
            return
        coded = lists.flatten().dictionary_encode()
        code, known = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        doc = np.repeat(np.arange(part.num_rows), sizes)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        group = doc * len(known) + code
        order = np.argsort(group, kind="stable")
        first = np.flatnonzero(np.diff(group[order], prepend=-1))
        code, doc = code[order][first], doc[order][first]
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)).astype(np.int32)), pa.array(place[order].astype(np.int32)))
        low = np.array([bisect.bisect_left(bound_words, w) for w in known.to_pylist()], np.int32)
        high = np.array([bisect.bisect_right(bound_words, w) for w in known.to_pylist()], np.int32)
        number, mixed = low[code], part.column(1).to_numpy()[doc]
        for cut in np.flatnonzero(high > low):  # a word that bounds stand in: by the hash of the document
            own = code == cut
            number[own] = low[cut] + np.searchsorted(bound_hashes[low[cut] : high[cut]], mixed[own], "right")
        yield pa.RecordBatch.from_arrays(
            [known.take(pa.array(code)), part.column(0).take(pa.array(doc)), positions, pa.array(number)], names=["word", "id", "positions", "range"])

    prepared = df.select(F.col(key).alias("id"), F.xxhash64(key).alias("mixed"), F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    return prepared.mapInArrow(rows, f"word string, id {kind}, positions array<int>, `range` int")


def range_bounds(df: DataFrame, key: str, text: str, ranges: int) -> list[tuple[str, int]]:
    """Beginnings of ``ranges`` ranges of (word, hash of the id) with about as many rows each, from up to ``SAMPLE`` documents. They
    only decide how even the files are, never a result."""
    drawn = df.orderBy(F.xxhash64(key)).limit(SAMPLE)
    found = postings(drawn, key, text).select("word", F.xxhash64("id").alias("mixed")).orderBy(F.xxhash64("word", "id")).limit(SAMPLE * 50)
    known = sorted((r["word"], r["mixed"]) for r in found.collect())
    return sorted({known[k * len(known) // ranges] for k in range(1, ranges)}) if known else []


class TextIndex:
    """Posting lists of a document table in ``path``, a folder that the driver and the executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- writing

    @classmethod
    def build(cls, df: DataFrame, key: str, text: str, path: str) -> TextIndex:
        """Index of all rows of ``df``; ``key`` is unique and not NULL."""
        index = cls(df.sparkSession, path)
        if index._generations():
            raise ValueError(f"{path} already holds an index")
        index._index("base-0", df, key, text)
        return index

    def append(self, df: DataFrame, key: str, text: str) -> None:
        """Index one more batch; documents whose id is already there are replaced."""
        number = max(n for _, n in self._generations()) + 1
        self._index(f"batch-{number}", df, key, text)

    def merge(self) -> None:
        """Write one generation in place of all, without the documents that were replaced. Readers that already planned keep the old files."""
        live = self._live()
        if len(live) < 2:
            return
        ids = reduce(DataFrame.unionByName, [self._read(g, "ids") for g in live]).distinct()
        self._write(f"base-{live[-1][1]}", self._valid(lambda rows: rows).repartitionByRange("word", "id"), ids)

    def drop_merged(self) -> None:
        """Delete the generations that a merged one stands for, once nothing reads them any more."""
        live = self._live()
        for kind, number in self._generations():
            if (kind, number) not in live:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}-{number}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _index(self, name: str, df: DataFrame, key: str, text: str) -> None:
        ranges = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        found = postings(df, key, text, range_bounds(df, key, text, ranges))
        self._write(name, found.repartitionById(ranges, F.col("range")).drop("range"), df.select(F.col(key).alias("id")))

    def _write(self, name: str, found: DataFrame, ids: DataFrame) -> None:
        where = f"{self.path}/{name}"
        found.sortWithinPartitions("word", "id").write.mode("overwrite").parquet(f"{where}/postings")
        counts = self.spark.read.parquet(f"{where}/postings").groupBy("word").agg(F.count(F.lit(1)).alias("documents"))
        counts.repartitionByRange("word").sortWithinPartitions("word").write.mode("overwrite").parquet(f"{where}/terms")
        ids.write.mode("overwrite").parquet(f"{where}/ids")

    # ---- generations

    def _generations(self) -> list[tuple[str, int]]:
        """All finished generations, a base before the batch of the same number."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        names = [status.getPath().getName() for status in files.listStatus(root)]
        done = [n for n in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/ids/_SUCCESS"))]
        return sorted(((kind, int(number)) for kind, _, number in (n.partition("-") for n in done)), key=lambda g: (g[1], g[0]))

    def _live(self) -> list[tuple[str, int]]:
        """The newest base and the batches after it, oldest first."""
        every = self._generations()
        if not every:
            raise ValueError(f"{self.path} holds no index")
        base = max(number for kind, number in every if kind == "base")
        return [("base", base), *[g for g in every if g[0] == "batch" and g[1] > base]]

    def _read(self, generation: tuple[str, int], table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{generation[0]}-{generation[1]}/{table}")

    def _valid(self, chosen) -> DataFrame:
        """``chosen`` rows of the postings of every generation, without those of documents that a later one replaced."""
        live, parts = self._live(), []
        for place, generation in enumerate(live):
            rows = chosen(self._read(generation, "postings"))
            for later in live[place + 1 :]:
                rows = rows.join(self._read(later, "ids"), "id", "left_anti")
            parts.append(rows.select("word", "id", "positions"))
        return reduce(DataFrame.unionByName, parts)

    # ---- reading

    def documents_of(self, words: list[str]) -> dict[str, int]:
        """Number of documents per word, replaced ones included: what the order of a search goes by."""
        parts = [self._read(g, "terms").filter(F.col("word").isin(words)) for g in self._live()]
        rows = reduce(DataFrame.unionByName, parts).groupBy("word").agg(F.sum("documents").alias("n")).collect()
        return dict.fromkeys(words, 0) | {r["word"]: r["n"] for r in rows}

    def terms(self) -> DataFrame:
        """(word, documents), replaced documents left out."""
        live = self._live()
        if len(live) == 1:
            return self._read(live[0], "terms")
        return self._valid(lambda rows: rows).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))

    def search(self, words: list[str]) -> DataFrame:
        """(id) of the documents that hold every word. The rarest word's list is read first and semi-joined with the others."""
        wanted = list(dict.fromkeys(check_word(w) for w in words))
        if not wanted:
            raise ValueError("no words")
        often = self.documents_of(wanted)
        first, *others = sorted(wanted, key=lambda w: (often[w], w))
        hits = self._lists(first).select("id")
        for word in others:
            hits = hits.join(self._lists(word).select("id"), "id", "left_semi")
        return hits

    def phrase(self, words: list[str]) -> DataFrame:
        """(id, starts) of the documents that hold the words one after the other; ``starts`` are the places of the first word.

        From the rarest word on, each list leaves only the starts that it confirms.
        """
        wanted = [check_word(w) for w in words]
        if not wanted:
            raise ValueError("no words")
        often = self.documents_of(list(dict.fromkeys(wanted)))
        order = sorted(range(len(wanted)), key=lambda k: (often[wanted[k]], k))
        hits = self._lists(wanted[order[0]]).select("id", _starts("positions", order[0]).alias("starts"))
        for k in order[1:]:
            more = self._lists(wanted[k]).select("id", _starts("positions", k).alias("_more"))
            hits = hits.join(more, "id").select("id", F.array_intersect("starts", "_more").alias("starts")).filter(F.size("starts") > 0)
        return hits.filter(F.size("starts") > 0).select("id", F.array_sort("starts").alias("starts"))

    def _lists(self, word: str) -> DataFrame:
        return self._valid(lambda rows: rows.filter(F.col("word") == word))


def _starts(positions: str, place: int) -> Column:
    """Where a phrase would start whose word number ``place`` stands at the positions."""
    return F.filter(F.transform(positions, lambda p: p - F.lit(place)), lambda p: p >= 0)
