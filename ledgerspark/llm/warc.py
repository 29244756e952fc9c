"""WARC archives: records written by Spark, segments of long records reassembled on reading, chunked framing decoded."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base

VERSION = b"WARC/1.1"
#: A record's block is cut into segments of so many bytes; a chunk of the transfer framing has so many at most.
SEGMENT, CHUNK = 16 << 10, 4 << 10
#: Payloads below this many bytes are always written in full.
REVISIT_FROM = 1000
RECORDS_PER_FILE = 4096
DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("record_id string, kind string, origin string, segment int, total long, page_id string, refers_to string, digest string, "
          "target string, file string, offset long, block binary")


def decided(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(page_id, row, url, payload, digest, n, writer, writer_row): the record that an equal payload is written by.

    Of equal payloads of at least ``revisit_from`` bytes it is the row with the largest page_id (of those, the last row);
    a smaller payload is written by its own row. Only digests are grouped, and a hot digest has one row on the grouped side.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", F.monotonically_increasing_id().alias("row"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    large = F.col("n") >= revisit_from
    last = F.max_by(F.struct(F.col("page_id").alias("writer"), F.col("row").alias("writer_row")), F.struct("page_id", "row"))
    writers = rows.where(large).groupBy(F.col("digest").alias("same"), F.col("n").alias("length")).agg(last.alias("by"))
    joined = rows.join(writers, (F.col("digest") == F.col("same")) & (F.col("n") == F.col("length")), "left")
    return joined.select("page_id", "row", "url", "payload", "digest", "n", F.when(large, F.col("by.writer")).otherwise(F.col("page_id")).alias("writer"), F.coalesce("by.writer_row", "row").alias("writer_row"))


def chunked(payload: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """Transfer framing: the length of each chunk in hex, the chunk; a chunk of length 0 ends it."""
    for start in range(0, len(payload), size):
        part = payload[start : start + size]
        yield b"%x\r\n" % len(part) + part + b"\r\n"
    yield b"0\r\n\r\n"


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as bytes; the line end of the file's rows is the last of the two that close it."""
    lines = "".join(f"{name}: {_line(value)}\r\n" for name, value in headers if value is not None)
    return b"%s\r\n%sContent-Length: %d\r\n\r\n%s\r\n" % (VERSION, lines.encode(), len(block), block)


def _line(value: object) -> str:
    """A header's value stays on its line."""
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def _target(url: str) -> list[tuple[str, object]]:
    """The URL as it is, for any reader; in a field of its own, escaped, where a header's line would change it."""
    exact = url == url.strip() and _line(url) == url
    return [("WARC-Target-URI", url), ("X-Page-Url", None if exact else quote(url))]


def _number(text: str, bits: int) -> int | None:
    """A whole number in decimal digits that fits into so many bits with sign, else None."""
    return int(text) if text.isascii() and text.isdecimal() and len(text) < 20 and int(text) < 1 << bits - 1 else None


def record_id(page_id: object, row: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{row}>"


def records(rows: DataFrame, segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """(data binary): records of the rows of :func:`decided`; a block above ``segment`` bytes becomes a first record and
    continuation records that name it as their origin, the last with the total length."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in it:
                columns = [batch.column(k) for k in range(batch.num_columns)]
                for k in range(batch.num_rows):
                    page_id, row, url, payload, digest, n, writer, writer_row = (c[k].as_py() if i != 3 else c[k].as_buffer() for i, c in enumerate(columns))
                    own = record_id(page_id, row)
                    head = [("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE), *_target(url or ""),
                            ("X-Page-Id", "" if page_id is None else quote(str(page_id))), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
                    if writer_row != row:
                        head[0] = ("WARC-Type", "revisit")
                        more = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", record_id(writer, writer_row))]
                        yield (record(head + more, _HTTP + b"\r\n"),)
                        continue
                    block = b"".join([_HTTP, b"Transfer-Encoding: chunked\r\n\r\n", *chunked(payload.to_pybytes(), chunk)])
                    if len(block) <= segment:
                        yield (record(head, block),)
                        continue
                    for number, start in enumerate(range(0, len(block), segment), 1):
                        part = block[start : start + segment]
                        if number == 1:
                            yield (record([*head, ("WARC-Segment-Number", 1)], part),)
                            continue
                        last = start + segment >= len(block)
                        yield (record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", own),
                                       ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", len(block) if last else None)], part),)

        yield from base.batches(out(), pa.schema([("data", pa.binary())]), bytes_at_once=8 << 20)

    return base.bounded_batches(rows).mapInArrow(run, "data binary")


def write(pages: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK) -> None:
    """Archives under ``path``, gzip files of up to ``RECORDS_PER_FILE`` records: Spark's text writer puts out the bytes as they are."""
    rows = records(decided(pages), segment, chunk).select(F.col("data").cast("string").alias("value"))
    rows.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_MEMBER = re.compile(rb"\x1f\x8b\x08[\x00-\x1f]")


def inflated(data, step: int = 1 << 18) -> Iterator[bytes | None]:
    """The content of a file in pieces: that of all members of a gzip file, any other file as it is. None stands where a
    member is damaged; the next member that follows its start goes on."""
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield from (bytes(view[at : at + step]) for at in range(0, len(view), step))
        return
    at, start, member = 0, 0, zlib.decompressobj(31)
    while at < len(view):
        piece, failed = view[at : at + step], False
        try:
            out = member.decompress(piece, 4 * step)
        except zlib.error:
            failed = True
        else:
            used = len(piece) - len(member.unused_data if member.eof else member.unconsumed_tail)
            at += used
            yield out
            if member.eof:
                start, member = at, zlib.decompressobj(31)
                continue
            if at >= len(view):
                yield member.flush()
            failed = not member.eof and (at >= len(view) or not used and not out)
        if failed:
            yield None
            found = _MEMBER.search(view, start + 1)
            if not found:
                return
            at = start = found.start()
            member = zlib.decompressobj(31)


def parse(pieces: Iterator[bytes | None], damaged: bool = False) -> Iterator[tuple[int, dict[str, str] | None, bytes | int]]:
    """(offset, headers, block) of every record, by the lengths they state; one record is held at a time. After bytes that are
    no record, or a record whose length is wrong, the next line that starts with WARC/ goes on; if ``damaged``, the range
    left out is given as (offset, None, bytes)."""
    before, pieces, more = 0, iter(pieces), True
    while more:
        held, cut, skip = bytearray(), False, 0

        def reach(find) -> int:
            """The place that ``find`` gives, reading on until there is one; -1 at the end of the file or at damage."""
            nonlocal cut, more
            while (place := find()) < 0:
                piece = b"" if cut else next(pieces, _END)
                if cut or piece is None or piece is _END:
                    cut, more = True, more and piece is not _END
                    return -1
                held.extend(piece)
            return place

        def start() -> int:
            return held.find(b"WARC/") if not skip else held.find(b"\nWARC/", skip) + 1 or -1

        while (at := reach(start)) >= 0:
            end = reach(lambda: held.find(b"\r\n\r\n", at))
            lines = held[at : max(at, end)].decode("utf-8", "replace").split("\r\n")[1:]
            headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
            size = headers.get("content-length", "")
            stop = end + 4 + int(size) if end >= 0 and size.isdecimal() and size.isascii() and len(size) < 19 else -1
            if stop < 0 or reach(lambda: stop if len(held) >= stop else -1) < 0 or not _ends(held, stop, reach):
                skip = at + 5
                continue
            if damaged and held[:at].strip():
                yield before, None, at
            yield before + at, headers, bytes(held[end + 4 : stop])
            del held[:stop]
            before, skip = before + stop, 0
        if damaged and held.strip():
            yield before, None, len(held)
        before += len(held)


_END = object()


def _ends(held: bytearray, stop: int, reach) -> bool:
    """True if a record can end there: before an empty line, the next record or the end."""
    reach(lambda: stop if len(held) >= stop + 9 else -1)
    rest = bytes(held[stop : stop + 9]).lstrip(b"\r\n")
    return held[stop : stop + 4] == b"\r\n\r\n" or b"WARC/".startswith(rest[:5])


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path`` (columns of ``RECORD``), and a row of kind ``damaged`` for every range that is
    no whole record, whose total is its number of bytes, as far as they could be inflated. Files are read by Spark, each by one task, which holds the
    file as it is stored (2 GB at most) and one record."""
    schema = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in RECORD.split(", "))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for batch in it:
                for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for offset, h, block in parse(inflated(content.as_buffer()), damaged=True):
                        if h is None:
                            yield None, "damaged", None, None, min(block, 2**31 - 1), None, None, None, None, file, offset, b""
                            continue
                        number, total = h.get("warc-segment-number", ""), h.get("warc-segment-total-length", "")
                        own = h.get("warc-record-id")
                        yield (own, h.get("warc-type"), h.get("warc-segment-origin-id") or own, _number(number, 32), _number(total, 64),
                               unquote(h["x-page-id"]) if "x-page-id" in h else None, h.get("warc-refers-to"), (h.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                               unquote(h["x-page-url"]) if "x-page-url" in h else h.get("warc-target-uri", ""), file, offset, block)

        yield from base.batches(out(), schema, bytes_at_once=8 << 20)

    return base.bounded_batches(spark.read.format("binaryFile").load(path)).select("path", "content").mapInArrow(run, RECORD)


#: A chunk's size and what may follow it on its line, which has less than ``LINE`` bytes.
_SIZE, LINE = re.compile(rb"[ \t]*([0-9A-Fa-f]{1,15})[ \t]*(?:;|\Z)"), 8192


class Body:
    """A record's payload, fed with its block in pieces: skips the HTTP head, decodes chunked framing, keeps what is asked for.
    Where the framing is broken (a size that is no hexadecimal number, a chunk without its line end) the payload ends: not whole."""

    def __init__(self, keep: bool = True) -> None:
        self.head, self.framed, self.left, self.ended, self.broken, self.rest = True, False, 0, False, False, b""
        self.fed = self.n = 0
        self.sha, self.kept = hashlib.sha1(), [] if keep else None

    def feed(self, data: bytes) -> None:
        self.fed += len(data)
        data = self.rest + data
        at = 0
        if self.head:
            end = data.find(b"\r\n\r\n")
            if end < 0:
                self.rest = data
                return
            self.head, at = False, end + 4
            self.framed = any(line.partition(b":")[0].strip() == b"transfer-encoding" and b"chunked" in line for line in data[:end].lower().split(b"\r\n")[1:])
        while at < len(data) and not self.ended and not self.broken:
            if not self.framed:
                self._add(data[at:])
                at = len(data)
            elif self.left > 2:  # the chunk and the line end after it
                part = data[at : at + self.left - 2]
                self._add(part)
                at, self.left = at + len(part), self.left - len(part)
                if self.left > 2:
                    break
            elif self.left:
                take = min(self.left, len(data) - at)
                self.broken = data[at : at + take] != b"\r\n"[2 - self.left :][:take]
                at, self.left = at + take, self.left - take
            else:
                end = data.find(b"\r\n", at)
                line = data[at : at + LINE if end < 0 else end]
                said = _SIZE.match(line)
                if end < 0 and len(line) < LINE:
                    break
                if end < 0 or not said:
                    self.broken = True
                    break
                size = int(said[1], 16)
                at, self.ended, self.left = end + 2, size == 0, size + 2 if size else 0
        self.rest = b"" if self.ended or self.broken else data[at:]

    def _add(self, part: bytes) -> None:
        self.n += len(part)
        self.sha.update(part)
        if self.kept is not None:
            self.kept.append(part)

    def whole(self, total: int | None) -> bool:
        return not self.head and not self.broken and (self.ended or not self.framed) and (total is None or total == self.fed)


def reassemble(found: DataFrame, keep: bool = True) -> DataFrame:
    """(record_id, kind, page_id, refers_to, digest, target, n, sha1, valid, payload) of every record but continuations that
    follow a first record. Those without one, and damaged ranges, are rows that are not valid.

    Continuation records are grouped with their origin by its identifier, ordered by segment number and fed one after the
    other into one decoder, so that a task holds one segment at a time (and the payload, if ``keep``). valid: numbers run
    from 1 without a gap, the total length agrees, the framing is complete, and the stated digest is that of the payload.
    A segment that is there twice counts once. Only records with segments are shuffled.
    """
    ddl = "record_id string, kind string, page_id string, refers_to string, digest string, target string, n long, sha1 string, valid boolean, payload binary"
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(n, types[k]) for n, k in (x.split() for x in ddl.split(", "))])
    names = ["record_id", "kind", "origin", "segment", "total", "page_id", "refers_to", "digest", "target"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            first, body, number, total, whole = None, None, 0, None, True

            def done():
                own, kind, _, segment, _, page_id, refers_to, digest, target = first
                sha = body.sha.hexdigest()
                good = whole and own is not None and kind not in ("continuation", "damaged") and (kind == "revisit" or body.whole(total) and (digest in (None, sha)) and (segment is None or total is not None))
                return own, kind, page_id, refers_to, digest, target, body.n, sha, good, b"".join(body.kept) if keep else None

            for batch in it:
                rows = zip(*(batch.column(n).to_pylist() for n in names))
                for head, block in zip(rows, batch.column("block")):
                    same = first is not None and head[3] is not None and head[2] == first[2] and first[3] is not None
                    if not same:
                        if first is not None:
                            yield done()
                        first, body, number, total, whole = head, Body(keep), 0, None, head[3] in (None, 1)
                    elif head[3] == number:
                        continue
                    else:
                        whole = whole and head[3] == number + 1
                    number = head[3] or 0
                    total = head[4] if head[4] is not None else total
                    body.feed(block.as_buffer().to_pybytes())
            if first is not None:
                yield done()

        yield from base.batches(out(), schema, bytes_at_once=8 << 20)

    wanted = [*names, "block"]
    single = base.bounded_batches(found).where("segment IS NULL AND kind IN ('response', 'revisit', 'resource', 'continuation', 'damaged')").select(*wanted).mapInArrow(run, ddl)
    parts = found.where("segment IS NOT NULL").select(*wanted).repartition("origin").sortWithinPartitions("origin", "segment").mapInArrow(run, ddl)
    return single.unionByName(parts)


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as it is read back from the archives it was written to."""
    return round_trip(base.table(spark, folder, "pages"))


def round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, valid), one row per page row.

    Null html is the empty payload; a null page_id is written as an empty field and read as null. Equal rows are records
    of their own. A revisit's length is that of the response it refers to.
    """
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    path = base.scratch_path(spark, "warc")
    write(pages, path, segment)
    back = base.materialize(reassemble(read(spark, path), keep=False).drop("payload", "target"), "records")
    own = F.nullif(F.col("page_id"), F.lit("")).cast(kind)
    responses = back.where("kind = 'response'")
    at = responses.select(F.col("record_id").alias("at"), F.col("n").alias("at_n"), F.col("valid").alias("at_valid"), own.alias("at_page"))
    plain = responses.select(own.alias("page_id"), F.col("n").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast(kind).alias("refers_to"), "valid")
    revisits = back.where("kind = 'revisit'").join(at, F.col("refers_to") == F.col("at"), "left").select(
        own.alias("page_id"), F.col("at_n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"),
        F.col("at_page").alias("refers_to"), F.coalesce(F.col("valid") & F.col("at_valid"), F.lit(False)).alias("valid"))
    return plain.unionByName(revisits)
