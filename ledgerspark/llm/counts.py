"""Token counts: pieces are counted once per distinct pre-token and summed over the documents' pre-token frequencies."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerspark.llm import base

TOKENIZER = "byte_bpe_50k.json"
#: A block of documents is closed at so many pairs of document and pre-token or so many documents.
PAIRS, DOCUMENTS = 750_000, 1 << 13
#: A task keeps the sums of so many blocks (64 KB each) before it passes them on.
BLOCKS_HELD = 256
#: From this letter on, the library's character classes may be of another Unicode version than those of ``regex``.
NEWER = regex.compile("[԰-\U0010ffff]")

_ROW = "block long, piece string, data binary"
_SCHEMA = pa.schema([("block", pa.int64()), ("piece", pa.string()), ("data", pa.binary())])


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file, read once on the driver and sent along (a vocabulary: 2 MB, whatever the corpus)."""
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        return f.read()


def plain(tokenizer_file: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones; threads hold memory of their own
    tokenizer = Tokenizer.from_str(tokenizer_file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class PreTokens:
    """Splits texts as the tokenizer does: first at its special strings, which are tokens by themselves, then by its pattern."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.added = added
        self.fast = regex.compile(public_tokenizers.PATTERN).findall
        self.slow = tokenizer.pre_tokenizer.pre_tokenize_str

    def __call__(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens and the number of special strings."""
        parts = self.special.split(text) if any(x in text for x in self.added) else [text]
        out: list[str] = []
        for part in parts:
            if part.isascii() or not NEWER.search(part):
                out += self.fast(part)
            else:
                out += [part[a:b] for _, (a, b) in self.slow(part)]
        return out, len(parts) - 1


def piece_counts(tokenizer: Tokenizer, pieces: list[str]) -> list[int]:
    """Tokens of each pre-token. Each is encoded on its own; none holds a special string."""
    counts: list[int] = []
    for start in range(0, len(pieces), 1024):
        counts += [len(e) for e in tokenizer.encode_batch_fast(pieces[start : start + 1024], add_special_tokens=False)]
    return counts


def known_pieces(tokenizer: Tokenizer) -> dict[str, int]:
    """Counts of the pre-tokens that are entries of the vocabulary, which bounds their number."""
    texts = [t for t in tokenizer.decode_batch([[i] for i in range(tokenizer.get_vocab_size(False))]) if t and "�" not in t]
    return dict(zip(texts, piece_counts(tokenizer, texts)))


class Block:
    """Documents of one block with the frequencies of the pre-tokens that the vocabulary does not hold."""

    def __init__(self) -> None:
        self.documents: list[tuple] = []
        self.index: dict[str, int] = {}
        self.at, self.which, self.times = array("H"), array("i"), array("H")

    def add(self, key, n_bytes: int, total: int, rare: dict[str, int]) -> None:
        index, here = self.index, len(self.documents)
        for piece, n in rare.items():
            code = index.setdefault(piece, len(index))
            while n:
                part = min(n, 65_535)
                self.at.append(here)
                self.which.append(code)
                self.times.append(part)
                n -= part
        self.documents.append((key, n_bytes, total))

    def full(self) -> bool:
        return len(self.at) >= PAIRS or len(self.documents) >= DOCUMENTS

    def rows(self, number: int, id_type: pa.DataType) -> Iterator[tuple]:
        """The documents (as an Arrow stream) without a pre-token, then a row for each pre-token: the places of its documents as
        two bytes each; unless all are 1, their frequencies as well, and an odd byte that says so."""
        names, types = ["id", "n_bytes", "n_tokens"], (id_type, pa.int64(), pa.int64())
        held = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.documents), types)], names=names)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.schema) as writer:
            writer.write_batch(held)
        yield number, None, sink.getvalue().to_pybytes()
        which = np.frombuffer(self.which, np.int32)
        order = np.argsort(which, kind="stable")
        at, often = np.frombuffer(self.at, np.uint16)[order], np.frombuffer(self.times, np.uint16)[order]
        ends = np.cumsum(np.bincount(which, minlength=len(self.index)))
        several = np.maximum.reduceat(often, np.append(0, ends[:-1])) > 1 if len(ends) else ends
        at, times, start = at.tobytes(), often.tobytes(), 0
        for piece, end, more in zip(self.index, (2 * ends).tolist(), several.tolist()):
            yield number, piece, at[start:end] + times[start:end] + b"+" if more else at[start:end]
            start = end


class Sums:
    """Tokens by block and document, for the blocks that a task has met."""

    def __init__(self) -> None:
        self.places: dict[int, int] = {}
        self.total = np.zeros(0, np.int64)

    def add(self, blocks: np.ndarray, data: pa.Array, counts: np.ndarray) -> None:
        for block in np.unique(blocks).tolist():
            self.places.setdefault(block, len(self.places))
        if (need := len(self.places) * DOCUMENTS) > len(self.total):
            self.total = np.concatenate([self.total, np.zeros(2 * need - len(self.total), np.int64)])
        ends = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1].astype(np.int64)
        raw, size = np.frombuffer(data.buffers()[2], np.uint8), np.diff(ends)
        several = size % 2 == 1
        n = np.where(several, size // 4, size // 2)
        step = 2 * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        at = np.repeat(ends[:-1], n) + step
        places = raw[at] | raw[at + 1].astype(np.int64) << 8
        times = np.ones(len(at), np.int64)
        more = np.flatnonzero(np.repeat(several, n))
        after = at[more] + 2 * np.repeat(n, n)[more]
        times[more] = raw[after] | raw[after + 1].astype(np.int64) << 8
        first = np.array([self.places[b] * DOCUMENTS for b in blocks.tolist()], np.int64)
        np.add.at(self.total, np.repeat(first, n) + places, times * np.repeat(counts, n))

    def out(self) -> Iterator[tuple]:
        """A block's documents with tokens: their places as two bytes each, then their sums as eight."""
        for block, place in self.places.items():
            own = self.total[place * DOCUMENTS : (place + 1) * DOCUMENTS]
            where = np.flatnonzero(own)
            yield block, "", where.astype(np.uint16).tobytes() + own[where].tobytes()
        self.__init__()


def count_tokens(docs: DataFrame, tokenizer_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every whole text, as the tokenizer's library counts it.

    1. Documents are split into pre-tokens; a block of documents (bounded by ``PAIRS``) keeps the frequencies of each
       pre-token by document. Pre-tokens that are entries of the vocabulary are counted by a table of the vocabulary's size.
    2. The other pre-tokens meet by a shuffle, one row per block: each distinct one is counted once and the count
       multiplied into its frequencies; a task adds up what it has for a block's documents. A pre-token of very many
       documents is salted by groups of 256 input partitions, so that no task gets more of its rows.
    3. The tasks' sums of a block meet and are added to the documents. No ids are kept anywhere.

    Null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each, a null id stays null, other columns
    are not read.
    """
    file = tokenizer_json() if tokenizer_file is None else tokenizer_file
    kind = docs.schema[id_col].dataType.simpleString()

    def frequencies(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = plain(file)
        known, split = known_pieces(tokenizer), PreTokens(tokenizer)

        def rows():
            number, block, id_type = TaskContext.get().partitionId() << 32, Block(), None
            for batch in it:
                id_type = batch.column(0).type
                for key, text in zip(batch.column(0), base.texts(batch)):
                    found, total = split(text)
                    rare: dict[str, int] = {}
                    for piece in found:
                        if (tokens := known.get(piece)) is not None:
                            total += tokens
                        else:
                            rare[piece] = rare.get(piece, 0) + 1
                    block.add(key.as_py(), len(text.encode()), total, rare)
                    if block.full():
                        yield from block.rows(number, id_type)
                        number, block = number + 1, Block()
            if block.documents:
                yield from block.rows(number, id_type)

        yield from base.batches(rows(), _SCHEMA, at_once=8192)

    def counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Takes rows sorted by pre-token; rows of documents pass."""
        tokenizer, sums = plain(file), Sums()
        last, last_count = None, 0
        for batch in it:
            is_document = batch.column(1).is_null()
            if documents := is_document.true_count:
                yield batch.filter(is_document)
            if documents < batch.num_rows:
                batch = batch.filter(is_document.to_numpy(zero_copy_only=False) ^ True) if documents else batch
                found = batch.column(1).dictionary_encode()
                names = found.dictionary.to_pylist()
                counts = piece_counts(tokenizer, names[1:] if names[0] == last else names)
                counts = [last_count, *counts] if names[0] == last else counts
                last, last_count = names[-1], counts[-1]
                sums.add(batch.column(0).to_numpy(), batch.column(2), np.array(counts, np.int64)[found.indices.to_numpy()])
                if len(sums.places) >= BLOCKS_HELD:
                    yield from base.batches(sums.out(), _SCHEMA)
        yield from base.batches(sums.out(), _SCHEMA)

    def added(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Takes rows sorted by block, the documents of a block first."""
        rows, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(total), pa.array(total > limit)],
                                              names=[id_col, "n_bytes", "n_tokens", "over_limit"])

        for batch in it:
            for piece, data in zip(batch.column(1), batch.column(2)):
                if piece.is_valid:
                    n = len(data.as_buffer()) // 10
                    total[np.frombuffer(data.as_buffer(), np.uint16, n)] += np.frombuffer(data.as_py()[2 * n :], np.int64)
                    continue
                if rows is not None:
                    yield out()
                rows = pa.ipc.open_stream(data.as_py()).read_next_batch()
                total = rows.column(2).to_numpy().copy()
        if rows is not None:
            yield out()

    spread = F.xxhash64("piece", F.when(F.col("piece").isNull(), F.col("block")).otherwise(F.shiftright("block", 40)))
    return (
        base.bounded_batches(docs).select(docs[id_col], docs[text_col].alias("text"))
        .mapInArrow(frequencies, _ROW)
        .repartition(spread).sortWithinPartitions("piece")
        .mapInArrow(counted, _ROW)
        .repartition("block").sortWithinPartitions("block", "piece")
        .mapInArrow(added, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return count_tokens(base.table(spark, folder, "documents"))
