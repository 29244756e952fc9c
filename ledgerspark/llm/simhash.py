"""SimHash near-duplicates: fingerprints of word shingles, linked by way of tables of distances to reference fingerprints."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base, graph

WORDS_PER_SHINGLE = 3
MAX_BITS = 2
#: Reference fingerprints (pivots) of the distance tables.
PIVOTS = 32
#: Buckets up to this size are compared through the distance tables; larger ones by looking up every neighbour.
BUCKET = 8192
GROUPS, GROUP_BITS = 4, 16
#: Two different bits touch two of the four 16-bit groups at most, so the other two are equal: one table per two groups.
TABLES = list(combinations(range(GROUPS), GROUPS - MAX_BITS))
_BLANK = re.compile(rb"[\x09-\x0d\x20]")


def words_of(data: bytes, at_once: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text in UTF-8, A-Z lower-cased, in lists of bounded size. (bytes.lower and bytes.split know ASCII only.)"""
    start = 0
    while start < len(data):
        end = start + at_once
        if end < len(data):
            blank = _BLANK.search(data, end)
            end = blank.start() if blank else len(data)
        yield data[start:end].lower().split()
        start = end


def fingerprint(text: str | None, size: int = WORDS_PER_SHINGLE) -> int:
    """A bit is set if over half of the shingles' hashes have it; no word gives zero; fewer words than ``size``: one shingle."""
    hashed, counts, n, carry = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for words in words_of((text or "").encode()):
        words = carry + words
        if len(words) >= size:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
            values = np.fromiter((hashed(s, 42) for s in shingles), np.uint64, len(words) - size + 1)
            counts += _ones(values)
            n += len(values)
        carry = words[-(size - 1):] if size > 1 else []
    if not n and carry:
        return hashed(b" ".join(carry), 42)
    return int(((2 * counts > n).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


_PLACE = (np.arange(8) * 256).astype(np.uint16)
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def _ones(values: np.ndarray) -> np.ndarray:
    """How many values have each bit, by a histogram of each of their bytes."""
    seen = np.bincount((values.astype("<u8").view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048)
    return (seen.reshape(8, 256) @ _BITS).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS_PER_SHINGLE, name: str = "fp") -> DataFrame:
    """(id_col, fp long) of every row: the 64 bits as a signed number. Null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            values = np.array([fingerprint(t, size) for t in base.texts(batch, text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=[id_col, name])

    return base.bounded_batches(docs).select(docs[id_col], docs[text_col]).mapInArrow(run, f"`{id_col}` {kind}, `{name}` long")


def references(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints by rule: hashes of 0, 1, 2, ..."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), 42) for i in range(n)], np.uint64)


def _key(table: int):
    """Table number and the bits of its two groups as one number."""
    i, j = TABLES[table]
    part = [F.shiftrightunsigned("fp", GROUP_BITS * g).bitwiseAND(F.lit(0xFFFF)) for g in (i, j)]
    return F.lit(table << 32) + part[0] * (1 << 16) + part[1]


def _masks(table: int) -> list[int]:
    """All ways to flip one or two bits outside the table's groups."""
    free = [1 << (GROUP_BITS * g + k) for g in range(GROUPS) if g not in TABLES[table] for k in range(GROUP_BITS)]
    return [x - (1 << 64) if x >> 63 else x for x in free + [x | y for x, y in combinations(free, 2)]]


def links(classes: DataFrame, bucket: int = BUCKET, pivots: int = PIVOTS) -> DataFrame:
    """(a, b) between distinct fingerprints (column ``fp``): edges whose components are those of all links of at most
    ``MAX_BITS`` differing bits.

    Every fingerprint goes to six buckets by two of its four 16-bit groups; any link shares a bucket. Buckets of up to
    ``bucket`` members are sorted next to each other in a partition: the distances of all members to the reference fingerprints are
    computed once, a pair is discarded as soon as one of these coordinates differs by more than ``MAX_BITS`` (then the
    pair differs by more bits, too), and survivors are verified. A bucket's links come out as stars, at most one row per member.
    In larger buckets every member looks up all fingerprints that are its own with one or two bits of the other two
    groups flipped: the same links at a cost in proportion to the members.
    """
    keyed = base.bounded_batches(classes).select("fp", F.explode(F.array(*[_key(t) for t in range(len(TABLES))])).alias("key"))
    large = base.materialize(keyed.groupBy("key").count().where(F.col("count") > bucket).select("key"), "buckets")
    small = keyed
    found = None
    if large.head(1):
        small = keyed.join(large, "key", "left_anti")
        table = F.shiftright("key", 32)
        flips = F.element_at(F.array(*[F.array(*map(F.lit, _masks(t))) for t in range(len(TABLES))]), table.cast("int") + 1)
        near = keyed.join(large, "key", "left_semi").select(F.col("fp").alias("a"), F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("b")).where("a < b")
        found = near.join(classes.select(F.col("fp").alias("b")), "b").select("a", "b")
    marks = references(pivots)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Takes rows sorted by key; the last key's members wait for the next batch."""
        keys, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in it:
            keys = np.concatenate([keys, batch.column(1).to_numpy()])
            values = np.concatenate([values, batch.column(0).to_numpy().view(np.uint64)])
            end = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            yield from _stars(keys[:end], values[:end], marks)
            keys, values = keys[end:], values[end:]
        yield from _stars(keys, values, marks)

    compared = small.select("fp", "key").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")
    return compared if found is None else compared.unionByName(found)


def _stars(keys: np.ndarray, values: np.ndarray, marks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges from each member that has a link to the first member it is connected to within its bucket."""
    same = keys[1:] == keys[:-1]
    keep = np.append(same, False) | np.insert(same, 0, False) if len(keys) else np.zeros(0, bool)
    keys, values = keys[keep], values[keep]
    if not len(keys):
        return
    table = np.stack([np.bitwise_count(values ^ m).astype(np.int8) for m in marks])
    left, lag, first, second = np.arange(len(keys)), 1, [], []
    while True:
        left = left[left + lag < len(keys)]
        left = left[keys[left + lag] == keys[left]]
        if not len(left):
            break
        near = left
        for distances in table:
            near = near[np.abs(distances[near] - distances[near + lag]) <= MAX_BITS]
        near = near[np.bitwise_count(values[near] ^ values[near + lag]) <= MAX_BITS]
        first.append(near)
        second.append(near + lag)
        lag += 1
    if not (a := np.concatenate(first)).size:
        return
    b, label = np.concatenate(second), np.arange(len(keys))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(keys)))
    for start in range(0, len(moved), 1 << 16):
        part = moved[start : start + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(values[label[part]].view(np.int64)), pa.array(values[part].view(np.int64))], names=["a", "b"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS_PER_SHINGLE) -> DataFrame:
    """(id_col, fp long, component_id): one row per row of ``docs``; component_id is the smallest id reachable over links.

    Equal fingerprints are one class before anything is compared, so a group of copies costs one row. Null ids take part
    but never name a component unless all its ids are null. Repeated rows are copies. Empty tables give an empty result,
    other columns are not read.
    """
    found = base.materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = found.groupBy("fp").agg(F.min(id_col).alias("least"))
    parts = graph.components(links(classes), "a", "b")
    named = classes.join(parts, classes["fp"] == parts["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    named = base.materialize(named, "classes")
    smallest = named.groupBy("part").agg(F.min("least").alias("component_id"))
    by_class = named.join(smallest, "part").select(F.col("fp").alias("class"), "component_id")
    return found.join(by_class, found["fp"] == by_class["class"]).select(found[id_col], "fp", "component_id")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document."""
    found = near_duplicates(base.table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, but of each component only that with the smallest id (null ids last, then
    by a hash of the text); of equal rows of that kind one is left."""
    key, name = base.unused(docs.columns, "text_key"), base.unused(docs.columns, "winner")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            values = np.array([fingerprint(t) for t in base.texts(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values.view(np.int64))], names=["id", "text_key", "fp"])

    rows = base.bounded_batches(docs).select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))
    found = base.materialize(rows.mapInArrow(run, f"id {kind}, text_key long, fp long"), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
    classes = found.groupBy("fp").agg(first.alias("first"))
    parts = graph.components(links(classes.select("fp")), "a", "b")
    named = classes.join(parts, classes["fp"] == parts["node"], "left").select("first", F.coalesce("component", "fp").alias("part"))
    winners = named.groupBy("part").agg(F.min("first").alias("first")).select(F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key"))
    counted = found.groupBy("id", "text_key").count().select(F.col("id").alias("i"), F.col("text_key").alias("k"), "count")
    winners = winners.join(counted, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k"))).select(F.col("id").alias(name), F.col("text_key").alias(f"{name}_key"), "count")
    winners = base.materialize(winners, "winners")
    keyed = docs.withColumn(key, F.xxhash64(docs[text_col]))

    def chosen(part: DataFrame) -> DataFrame:
        part = part.select(name, f"{name}_key")
        return keyed.join(part, keyed[id_col].eqNullSafe(part[name]) & (keyed[key] == part[f"{name}_key"]), "left_semi")

    kept = chosen(winners.where("count = 1"))
    repeated = winners.where("count > 1")
    if repeated.head(1):
        kept = kept.unionByName(chosen(repeated).dropDuplicates([id_col, key]))
    return kept.select(*docs.columns)
