"""Byte-level BPE by a local rank file: encoding, decoding, and what identifies the result."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import base

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Texts above this many characters are encoded in pieces.
PIECE = 1 << 16


def rank_bytes(path: str | None = None) -> bytes:
    """The rank file, read once on the driver and sent along (a vocabulary: 1 MB, whatever the corpus)."""
    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        return f.read()


def encoding(ranks: bytes, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})


def safe_cut(text: str, i: int) -> bool:
    """No match of the pattern reaches over a cut between a letter or digit and a blank followed by a letter.

    The blank opens the next match (`` ?\\p{L}+``), whose letter also keeps it from joining a run of white space.
    """
    a, b, c = text[i - 1], text[i], text[i + 1 : i + 2]
    return b == " " and a.isascii() and a.isalnum() and c.isascii() and c.isalpha()


def encode(docs: DataFrame, ranks: bytes | None = None, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """(id_col, ids array<int>): the token ids of every whole text, in the order of the text, without special tokens.

    Null and empty texts give an empty list. Long texts are cut where the pattern's matches end anyway (:func:`safe_cut`),
    so the ids are those of the whole text. Repeated rows give repeated rows, a null id stays null, other columns of
    ``docs`` are not read.
    """
    ranks = rank_bytes() if ranks is None else ranks
    kind = docs.schema[id_col].dataType.simpleString()
    frame = base.bounded_batches(docs).select(docs[id_col], docs[text_col])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        for batch in it:
            keys = batch.column(0)
            schema = pa.schema([pa.field(id_col, keys.type), pa.field("ids", pa.list_(pa.int32()))])
            yield from base.batches(
                ((key.as_py(), [t for part in base.pieces(text, piece, safe_cut) for t in enc.encode_ordinary(part)])
                 for key, text in zip(keys, base.texts(batch, text_col))),
                schema, bytes_at_once=1 << 20)

    return frame.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes | None = None, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the raw bytes that its ids stand for (null ids: null). Bytes need not be whole
    characters: any list of ids can be decoded."""
    ranks = rank_bytes() if ranks is None else ranks
    name = base.unused(encoded.columns, name)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        for batch in it:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [None if x.as_py() is None else enc.decode_bytes(x.values.to_numpy()) for x in part.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, type=pa.binary())], names=[*part.schema.names, name])

    return base.bounded_batches(encoded).mapInArrow(run, f"{fields}, `{name}` binary")


def digests(encoded: DataFrame, ranks: bytes | None = None, ids_col: str = "ids", id_col: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of encoded rows, with the ids after id_col if wanted. For the first digest
    the ids are joined by commas, the second is that of the bytes they decode to. Null ids count as none."""
    ranks = rank_bytes() if ranks is None else ranks
    kind = encoded.schema[id_col].dataType.simpleString()
    frame = encoded.select(id_col, ids_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks)
        written: list[str] = [str(i) for i in range(1 << 16)]
        for batch in it:
            rows = []
            for ids in batch.column(1):
                numbers = ids.values.to_numpy().tolist() if ids.is_valid else []
                top = max(numbers, default=0)
                if top >= len(written):
                    written.extend(str(i) for i in range(len(written), top + 1))
                joined = ",".join(map(written.__getitem__, numbers)).encode()
                rows.append((len(numbers), hashlib.sha256(joined).hexdigest(), hashlib.sha256(enc.decode_bytes(numbers)).hexdigest()))
            columns = list(zip(*rows)) or [(), (), ()]
            kept = batch.columns[: 2 if keep_ids else 1]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                names=[*(id_col, ids_col)[: len(kept)], "n_tokens", "ids_sha256", "decoded_sha256"])

    ids = f"`{ids_col}` array<int>, " if keep_ids else ""
    return base.bounded_batches(frame).mapInArrow(run, f"`{id_col}` {kind}, {ids}n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded, decoded again, and the digests of both."""
    return codec_report(base.table(spark, folder, "documents"))


def codec_report(docs: DataFrame) -> DataFrame:
    """Both directions in two passes: each pass of a task has a Python worker of its own."""
    ranks = rank_bytes()
    return digests(encode(docs, ranks), ranks)
