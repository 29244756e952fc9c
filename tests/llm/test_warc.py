import gzip
import hashlib
import re

import pytest
from helpers import rows, table

from ledgerspark.llm import base, warc

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
ODD = [(1, None), (2, ""), (3, "x" * 999), (4, "x" * 999), (5, "é" * 500), (6, "é" * 500), (7, "WARC/1.1\r\n\r\n" * 20_000), (8, "WARC/1.1\r\n\r\n" * 20_000), (9, "a\r\n" * 100_000),
       (None, "q" * 2000), (10, "\r\n" + "z" * 40_000 + "\r\n\r\n"), (11, "日本" * 9000), (12, "0\r\n\r\n")]


def brute(data):
    best = {}
    for key, html in data:
        if len(b := (html or "").encode()) >= 1000:
            best[b] = max(best.get(b, -1), -1 if key is None else key)
    out = []
    for key, html in data:
        b = (html or "").encode()
        again = len(b) >= 1000 and best[b] != (-1 if key is None else key)
        out.append((key, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best[b] if again else None))
    return sorted(out, key=repr)


def test_given_pages(spark, small):
    got = warc.op6_warc(spark, small)
    assert rows(got, *COLUMNS) == brute(table(small, "pages")[["page_id", "html"]].values.tolist())
    assert got.where("NOT valid").count() == 0


@pytest.mark.parametrize("segment", [16_384, 700, 10**7])
def test_odd_pages(spark, segment):
    df = spark.createDataFrame([(i, None if i == 2 else f"u\n%\r{i}", h) for i, h in ODD], "page_id long, url string, html string").selectExpr("*", "1 as row", "'d' as digest", "'k' as kind")
    got = warc.round_trip(df, segment)
    assert rows(got, *COLUMNS) == brute(ODD) and got.where("NOT valid").count() == 0
    assert warc.round_trip(df.limit(0)).count() == 0


def test_repeated_rows_are_records_of_their_own(spark):
    df = spark.createDataFrame([(1, "u", "y" * 1500)] * 3 + [(2, "u", "s")] * 2, "page_id long, url string, html string")
    got = rows(warc.round_trip(df, 400), "page_id", "record_type", "refers_to", "valid")
    assert got == sorted([(1, "response", None, True)] + [(1, "revisit", 1, True)] * 2 + [(2, "response", None, True)] * 2, key=repr)


def test_payloads_and_targets_come_back(spark):
    df = spark.createDataFrame([(i, f"u\r\n%0A{i}", h) for i, h in ODD], "page_id long, url string, html string")
    path = base.scratch_path(spark, "warc-test")
    warc.write(df, path, 900, 64)
    back = warc.reassemble(warc.read(spark, path)).where("kind = 'response'").collect()
    want = {str(i): (h or "").encode() for i, h in ODD if i is not None}
    assert all(bytes(r["payload"]) == want[r["page_id"]] and r["target"] == f"u\r\n%0A{r['page_id']}" for r in back if r["page_id"])


def records(*items):
    return b"".join(warc.record(head, block) + b"\r\n" for head, block in items)


def segments(own, parts, total, numbers=None):
    head = [("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Segment-Number", 1)]
    out = [(head, parts[0])]
    for k, part in enumerate(parts[1:], 2):
        n = numbers[k - 2] if numbers else k
        out.append(([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own}{k}"), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n),
                     ("WARC-Segment-Total-Length", total if k == len(parts) else None)], part))
    return out


def test_damaged_and_scattered_segments(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n"
    cuts = [body[:20], body[20:50], body[50:]]
    good = segments("<a>", cuts, len(body))
    files = {
        "1.warc": records(good[2], good[0]), "2.warc.gz": gzip.compress(records(good[1])) + gzip.compress(records(good[1])),  # out of order, one twice
        "3.warc": records(*segments("<gap>", cuts, len(body), [2, 4]), *segments("<len>", cuts, len(body) + 1), *segments("<end>", cuts[:2], len(cuts[0] + cuts[1]))),
        "4.warc": records(([("WARC-Type", "response"), ("WARC-Record-ID", "<plain>")], b"HTTP/1.0 200 OK\r\n\r\nraw\xff")) + b"WARC/1.1\r\nContent-Length: 99\r\n\r\ncut",
        "5.warc": b"", "6.warc": b"no archive",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = {r["record_id"]: r for r in warc.reassemble(warc.read(spark, str(tmp_path))).collect()}
    assert bytes(got["<a>"]["payload"]) == b"abcde" and got["<a>"]["valid"]
    assert bytes(got["<plain>"]["payload"]) == b"raw\xff" and got["<plain>"]["valid"]
    assert not any(got[k]["valid"] for k in ("<gap>", "<len>", "<end>"))


def test_many_members_and_small_pieces():
    data = [records(([("WARC-Type", "response"), ("WARC-Record-ID", f"<{i}>")], b"x" * (i * 37))) for i in range(200)]
    packed = b"".join(map(gzip.compress, data))
    for step in (64, 1000, 1 << 18):
        assert b"".join(warc.inflated(packed, step)) == b"".join(data)
        got = list(warc.parse(warc.inflated(packed, step)))
        assert [(h["warc-record-id"], len(b)) for _, h, b in got] == [(f"<{i}>", i * 37) for i in range(200)]
        assert [at for at, _, _ in got] == [sum(map(len, data[:i])) for i in range(200)]
    assert len(list(warc.parse(warc.inflated(packed[:-200])))) < 200
    bomb = gzip.compress(b"\0" * 50_000_000)
    assert max(map(len, warc.inflated(bomb))) <= 1 << 20


def test_reading_goes_on_after_damage(spark, tmp_path):
    one = lambda i: records(([("WARC-Type", "response"), ("WARC-Record-ID", f"<{i}>")], b"HTTP/1.0 200 OK\r\n\r\n" + bytes(str(i), "ascii") * 300))
    packed = [gzip.compress(one(i)) for i in range(5)]
    broken = bytearray(packed[2])
    broken[len(broken) // 2] ^= 0xFF
    plain = [one(i) for i in range(10, 16)]
    size = re.search(rb"Content-Length: (\d+)", plain[1])[1]
    plain[1] = plain[1].replace(size, b"999999")
    plain[2] = plain[2].replace(size, b"none")
    plain[4] = plain[4].replace(size, b"7")
    late = segments("<orphan>", [b"a", b"b", b"c"], 3)[1:]
    files = {"1.warc.gz": b"".join([*packed[:2], bytes(broken), *packed[3:]]), "2.warc": b"".join(plain), "3.warc": records(*late), "4.warc.gz": packed[0][:-30] + packed[1]}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = warc.reassemble(warc.read(spark, str(tmp_path))).collect()
    assert {r["record_id"] for r in found if r["valid"]} >= {"<0>", "<1>", "<3>", "<4>", "<10>", "<13>", "<15>"}
    assert not {r["record_id"] for r in found if r["valid"]} & {"<11>", "<12>", "<14>"}
    assert sum(r["kind"] == "damaged" for r in found) >= 2 and sum(r["kind"] == "continuation" for r in found) == 1
    assert not any(r["valid"] for r in found if r["kind"] in ("continuation", "damaged"))


def test_malformed_framing_and_numbers_are_rows(spark, tmp_path):
    """Each case is one record that is not valid; the records around it are read."""
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    bad = {"letters": b"zz\r\nabc\r\n0\r\n\r\n", "negative": b"-5\r\nabcde\r\n0\r\n\r\n", "blank": b"\r\nabc", "prefix": b"0x3\r\nabc\r\n0\r\n\r\n", "huge": b"f" * 40 + b"\r\nabc",
           "no line end": b"3\r\nabcde\r\n0\r\n\r\n", "endless": b"1" * 20_000, "cut": b"3\r\nab"}
    one = lambda own, block, *more: ([("WARC-Type", "response"), ("WARC-Record-ID", own), *more], block)
    good = http + b"3;x=y\r\nabc\r\n00A \r\n0123456789\r\n0\r\n\r\n"
    numbers = {"²": None, "99999999999": None, "-1": None, "٣": None, "1" * 5000: None}
    items = [one("<first>", good), *[one(f"<{k}>", http + b) for k, b in bad.items()],
             *[([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<n{i}>"), ("WARC-Segment-Origin-ID", "<x>"), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", n)], b"part") for i, n in enumerate(numbers)],
             one("<last>", good)]
    (tmp_path / "1.warc").write_bytes(records(*items))
    got = {r["record_id"]: r for r in warc.reassemble(warc.read(spark, str(tmp_path))).collect()}
    assert len(got) == len(items)
    assert {k for k, r in got.items() if r["valid"]} == {"<first>", "<last>"}
    assert bytes(got["<first>"]["payload"]) == b"abc0123456789"
    body = warc.Body()
    for k in range(len(good)):  # the same in pieces of one byte
        body.feed(good[k : k + 1])
    assert body.whole(len(good)) and b"".join(body.kept) == b"abc0123456789"


def test_targets_are_those_of_the_pages_and_of_foreign_archives(spark, tmp_path):
    urls = ["http://a/%2520x", "http://a/%0A", "http://a/b c", " lead", "line\r\nend%0D", "", None]
    df = spark.createDataFrame([(f"id %41\n{i}", u, "h" * (2000 if i < 2 else 5)) for i, u in enumerate(urls)], "page_id string, url string, html string")
    path = base.scratch_path(spark, "warc-urls")
    warc.write(df, path)
    found = warc.read(spark, path)
    assert {r["page_id"]: r["target"] for r in found.collect()} == {f"id %41\n{i}": u or "" for i, u in enumerate(urls)}
    data = b"".join(gzip.decompress(bytes(r[0])) for r in spark.read.format("binaryFile").load(path).select("content").collect())
    assert b"WARC-Target-URI: http://a/%2520x\r\n" in data
    assert rows(warc.round_trip(df), "page_id", "refers_to", "valid") == sorted([(f"id %41\n{i}", "id %41\n1" if i == 0 else None, True) for i in range(len(urls))], key=repr)
    (tmp_path / "1.warc").write_bytes(records(([("WARC-Type", "response"), ("WARC-Record-ID", "<a>"), ("WARC-Target-URI", "http://a/%2520x")], b"HTTP/1.0 200 OK\r\n\r\nx")))
    assert [r["target"] for r in warc.read(spark, str(tmp_path)).collect()] == ["http://a/%2520x"]
