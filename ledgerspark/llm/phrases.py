"""Phrase collocation mining by SON partitioning: every shard mined completely at its share of the support, the union counted exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerspark.llm import base

SUPPORT, LONGEST, FIRST, COVERED = 10, 3, 2000, 50
#: Shards of the corpus. A shard's local support is its share of ``SUPPORT``, so fewer shards prune more.
SHARDS = 3
#: Bytes of text that a task counts at once; entries of a bucket that is merged at once.
CHUNK_BYTES, BUCKET_ENTRIES = 4 << 20, 1_500_000
#: Parts of a language that are ranked before their first rows are ranked together.
PARTS = 16
#: Bits of the filter of candidates per candidate, at least and at most (64 MB): a fuller filter lets more through, nothing is lost.
BITS_EACH, LEAST_BITS, MOST_BITS, SEGMENT_BITS = 16, 1 << 16, 1 << 29, 1 << 19
ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
#: What a byte is: 0 part of a word, 1 blank, 2 end of a piece.
_KIND = np.array([2 if b in ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)
_WORDS = r"[^ \t.,;:!?\n\x0B\f\r]+"


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """The words of some texts of one language: distinct words, the number of each word in order, and whether the next one follows in its piece."""

    def __init__(self, lang: str, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts).lower(), np.uint8)  # on bytes, lower() changes A-Z only
        kind = _KIND[data]
        inside = np.concatenate([[False], kind == 0, [False]])
        starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        letters = data[kind == 0]
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        self.lang, self.n = lang, len(starts)
        self.words, self.code = words.dictionary, words.indices.to_numpy().astype(np.int64)
        piece = np.searchsorted(np.flatnonzero(kind == 2), starts)
        self.follows = piece[1:] == piece[:-1]
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hash = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words.to_pylist()], np.uint64)

    def phrases(self, longest: int = LONGEST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length the places where a phrase starts and the phrase's hash there (equal phrases have equal hashes)."""
        at, hashes = np.arange(self.n), self.hash[self.code] if self.n else np.zeros(0, np.uint64)
        yield 1, at, _mixed(hashes)
        for length in range(2, longest + 1):
            keep = (at + length - 1 < self.n) & np.append(self.follows, False)[np.minimum(at + length - 2, max(0, self.n - 1))]
            at = at[keep]
            hashes = _mixed(hashes[keep] + np.uint64(length)) ^ self.hash[self.code[at + length - 1]]
            yield length, at, _mixed(hashes)

    def distinct(self, length: int, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The phrases that start at the given places as texts, each once, and how often: keys are exact, not hashed."""
        key, size = self.code[at], max(1, len(self.words))
        for step in range(1, length):
            key = np.unique(key, return_inverse=True)[1] * size + self.code[at + step]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        parts = [self.words.take(pa.array(self.code[at[first] + step])) for step in range(length)]
        text = parts[0] if length == 1 else pc.binary_join_element_wise(*parts, b" ")
        return text.cast(pa.string()), count


def _slices(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in slices of ``limit`` bytes or a little more, cut at ends of pieces only; without any it stays whole."""
    start = 0
    while len(text) - start > limit:
        tail = np.frombuffer(text, np.uint8, offset=start + limit)
        cut = next((int(found[0]) + at for at in range(0, len(tail), 1 << 16) if len(found := np.flatnonzero(_KIND[tail[at : at + (1 << 16)]] == 2))), None)
        if cut is None:
            break
        yield text[start : start + limit + cut]
        start += limit + cut
    yield text[start:] if start else text


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Chunk]]:
    """(shard, chunk) of rows (lang, shard, text), each about ``limit`` bytes of one language and shard; what is left over comes at the end."""
    held: dict[tuple[str, int], list[bytes]] = {}
    sizes: dict[tuple[str, int], int] = {}
    for batch in batches:
        langs, shards = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, shard, text in zip(langs, shards, base.texts(batch, "text")):
            key = (lang, shard)
            for part in _slices(text.encode("utf-8", "surrogatepass"), limit):
                held.setdefault(key, []).append(part)
                sizes[key] = sizes.get(key, 0) + len(part) + 1
            while sizes[key] >= limit or sum(sizes.values()) >= 3 * limit:
                full = max(sizes, key=sizes.get)
                yield full[1], Chunk(full[0], held.pop(full))
                del sizes[full]
                if full == key:
                    sizes[key] = 0
            if not sizes[key]:
                del sizes[key]
    for (lang, shard), texts in held.items():
        yield shard, Chunk(lang, texts)


def _add(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, int)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def _tokens(docs: DataFrame, shards: int) -> DataFrame:
    """(lang, shard, text): null languages are ``und``, the shard is by a hash of the text."""
    rows = base.bounded_batches(docs).select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.select("lang", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int").alias("shard"), "text")


def totals(tokens: DataFrame) -> DataFrame:
    """(lang, shard, n): number of words."""
    return tokens.groupBy("lang", "shard").agg(F.sum(F.regexp_count("text", F.lit(_WORDS)).cast("long")).alias("n"))


def locally_frequent(tokens: DataFrame, sizes: DataFrame, buckets: int, support: int = SUPPORT) -> DataFrame:
    """(hash): every phrase that reaches, in some shard, the shard's share of the support.

    A phrase with ``support`` occurrences reaches its share in one shard at least, so none is lost; two phrases of one hash are
    counted as one, which only lets more through. Each task counts its chunks and deals sorted blocks of (hash, count) out to the
    buckets of the hash; a bucket of a shard is merged by one task and holds about ``BUCKET_ENTRIES`` entries, however common a phrase is.
    """

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, chunk in chunks(it):
            found = [np.unique(hashes, return_counts=True) for _, _, hashes in chunk.phrases()]
            hashes, counts = _add(*(np.concatenate(c) for c in zip(*found)))
            bucket = (hashes >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1).astype(np.uint64)).tolist()
            rows = ((chunk.lang, shard, b, hashes[order[i:j]].tobytes(), counts[order[i:j]].astype(np.uint32).tobytes())
                    for b, (i, j) in enumerate(zip(ends, ends[1:])) if i < j)
            yield from base.batches(rows, pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("bucket", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    def merge(blocks: pa.Table) -> pa.Table:
        need = blocks["need"][0].as_py()
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, size = [], 0
        for own, often in zip(blocks["hashes"], blocks["counts"]):
            held.append((np.frombuffer(own.as_py(), np.uint64), np.frombuffer(often.as_py(), np.uint32).astype(np.int64)))
            size += len(held[-1][0])
            if size > BUCKET_ENTRIES:
                hashes, counts = _add(*(np.concatenate(c) for c in zip((hashes, counts), *held)))
                held, size = [], 0
        hashes, counts = _add(*(np.concatenate(c) for c in zip((hashes, counts), *held)))
        return pa.table({"hash": hashes[counts >= need].view(np.int64)})

    sizes = sizes.where("n > 0")
    whole = sizes.groupBy("lang").agg(F.sum("n").alias("all"))
    need = sizes.join(whole, "lang").select("lang", "shard", F.greatest(F.lit(1), F.ceil(F.lit(support) * F.col("n") / F.col("all") - 1e-9)).cast("long").alias("need"))
    dealt = tokens.mapInArrow(count, "lang string, shard int, bucket long, hashes binary, counts binary")
    return dealt.join(need, ["lang", "shard"]).groupBy("lang", "shard", "bucket").applyInArrow(merge, "hash long").distinct()


def candidate_filter(hashes: DataFrame) -> np.ndarray:
    """The union of the candidates as bits, of a size that grows with them up to ``MOST_BITS``; made in segments by tasks."""
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * max(1, n) - 1).bit_length()))
    width = min(bits, SEGMENT_BITS)

    def segment(places: pa.Table) -> pa.Table:
        at = places["place"].to_numpy()
        marks = np.zeros(width, np.uint8)
        marks[at % width] = 1
        return pa.table({"segment": [int(at[0]) // width], "bits": [np.packbits(marks, bitorder="little").tobytes()]})

    places = hashes.select(F.col("hash").bitwiseAND(F.lit(bits - 1)).alias("place")).distinct()
    made = places.groupBy(F.floor(F.col("place") / width)).applyInArrow(segment, "segment long, bits binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in made.toLocalIterator():
        out[row["segment"] * width // 8 : (row["segment"] + 1) * width // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def counted(tokens: DataFrame, candidates: np.ndarray, support: int = SUPPORT) -> DataFrame:
    """(lang, phrase, words, f): exact counts of every phrase of 1 to 3 words that occurs ``support`` times or more."""
    mask = np.uint64(len(candidates) * 8 - 1)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in chunks(it):
            for length, at, hashes in chunk.phrases():
                place = hashes & mask
                known = (candidates[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                text, often = chunk.distinct(length, at[known])
                for start in range(0, len(text), 1 << 16):
                    some = text.slice(start, 1 << 16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk.lang] * len(some), pa.string()), some, pa.array([length] * len(some), pa.int32()), pa.array(often[start : start + (1 << 16)], pa.int64())],
                        names=["lang", "phrase", "words", "f"])

    one_shard = tokens.select("lang", F.lit(0).alias("shard"), "text")
    found = one_shard.mapInArrow(count, "lang string, phrase string, words int, f long")
    return found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= support)


def collocations(docs: DataFrame, first: int = FIRST, support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """(lang, rank int, phrase, a, l, r, n, score): the ``first`` best phrases of 2 and 3 words of each language.

    docs has the columns text and lang. A-Z are lowered, texts fall into
    pieces at ``.,;:!?`` and line ends, a phrase lies within a piece, f counts all its occurrences, a = f(phrase) is at least ``support``;
    of its cuts into two parts with counts l and r the one with the smallest floor(10**6 * a * a / (l * r)) counts, ties to the
    shorter first part; a phrase is dropped where a phrase one word longer (of at most three) around it has half of its count.

    Null texts count as empty, null languages as ``und``; repeated rows count as often as they are there; columns of other names are
    not read; very long texts are counted in slices between pieces; no rows, or no phrase of that support, give no rows. Products are decimals
    of 38 digits, exact up to counts of 10**16 (beyond that the job stops).
    """
    tokens = _tokens(docs, shards)
    sizes = base.materialize(totals(tokens), "totals")
    most = sizes.agg(F.max("n")).first()[0] or 0
    hashes = base.materialize(locally_frequent(tokens, sizes, max(1, -(-3 * most // BUCKET_ENTRIES)), support), "candidates")
    counts = base.materialize(counted(tokens, candidate_filter(hashes), support), "counts")
    base.discard(hashes)
    phrases = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("word"))
    cut = phrases.select("*", F.explode(F.sequence(F.lit(1), F.size("word") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("word", F.lit(1), F.col("k"))).alias("left"),
                     F.concat_ws(" ", F.slice("word", F.col("k") + 1, F.size("word"))).alias("right"))
    part = counts.select("lang", "phrase", "f")
    cut = cut.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(1000000 * cast(a AS decimal(16,0)) * cast(a AS decimal(16,0))) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("at"))
    longer = phrases.where(F.size("word") == LONGEST).select(
        "lang", "a", F.explode(F.array(*(F.concat_ws(" ", F.slice("word", s, LONGEST - 1)) for s in (1, 2)))).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("around") < F.lit(COVERED) * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", F.col("at.l").alias("l"), F.col("at.r").alias("r"), F.col("at.score").alias("score"))
    # the first rows of a language are among the first of each of its parts, so the last step gets a bounded number of rows
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    few = kept.withColumn("part", part).withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
    few = few.where(F.col("rank") <= first).drop("part", "rank")
    top = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    n = sizes.groupBy("lang").agg(F.sum("n").alias("n"))
    return top.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of every language."""
    return collocations(base.table(spark, folder, "documents"))
