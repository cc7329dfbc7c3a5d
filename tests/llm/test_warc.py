"""Archives: exact round trip, revisits by brute force, what the reader skips."""

import base64
import gzip
import hashlib
import io
import random
import time
from collections import Counter

import pytest

from tidemark.llm import warc

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (5, "http://b/5", "same"), (3, None, ""), (4, "", None),
         (6, "http://b/6 x\ny", "ünï" * 5000), (6, "http://b/6", "other"), (6, "http://b/6", "other"),
         (None, "http://c", "same"), (None, "http://c", "alone"), (None, "http://d", "alone"), (7, "http://e", "x\r\n\r\ny")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 1, 2) for p in PAGES],
                                 "page_id long, url string, html string, sha long, revisit long").repartition(3)


@pytest.fixture(scope="module")
def archive(spark, pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archive")
    warc.write_archives(warc.planned_records(pages), path)
    return path


def test_records_equal_brute_force(spark, archive):
    want = Counter()
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        last = max((p for p, _, h in PAGES if p is not None and (h or "") == (html or "")), default=None)
        revisit = last is not None and page_id != last
        want[page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
             "revisit" if revisit else "response", last if revisit else None, None if revisit else payload] += 1
    rows = warc.read_archives(spark, archive, verify=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in rows) == want
    assert {r.url for r in rows} == {None, "", "http://b/6 x%0Ay"} | {u for _, u, _ in PAGES if u and "\n" not in u}
    narrow = warc.read_archives(spark, archive, "payload_bytes long, page_id long").collect()
    assert Counter((r.page_id, r.payload_bytes) for r in narrow) == Counter((r.page_id, r.payload_bytes) for r in rows)


def test_small_payloads_are_never_revisits(spark, pages):
    rows = warc.planned_records(pages, min_bytes=5).collect()
    assert not any(r.revisit for r in rows if len(r.payload) < 5)
    assert any(r.revisit for r in warc.planned_records(pages).collect())


def test_filters_are_taken_over(spark, archive, plan):
    everything = warc.read_archives(spark, archive)
    found = everything.filter("record_type = 'response' and url like 'http://b%'")
    assert sorted(r.page_id for r in found.collect()) == [5, 6, 6, 6]
    assert "record_type" not in plan(found).split("Filter")[1].split("BatchScan")[0].replace("isnotnull(record_type", "")
    assert everything.filter("page_id in (1, 2)").count() == 2
    assert everything.filter("page_id = 1 and record_type = 'response'").count() == 0


def test_unwanted_payloads_are_not_unpacked():
    unpacked = []
    data = b"".join(warc.member(warc.record(i, "u", bytes([i]) * 10 + __import__("os").urandom(300_000), None, False, "d"))
                    for i in range(4))
    class Spy(io.BytesIO):
        def read(self, n=-1):
            found = super().read(n)
            unpacked.append(len(found))
            return found
    rows = list(warc.records(Spy(data), len(data), lambda r: r["page_id"] == 2, True, True))
    assert [r["page_id"] for r in rows] == [2] and len(rows[0]["payload"]) == 300_010
    assert sum(unpacked) < len(data) / 2


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress])
def test_archives_of_others(pack):
    """Without lengths in gzip headers, or not packed; with records of other kinds."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    data = pack(info) + b"".join(pack(warc.record(i, "u", b"p" * i * 9000, None, False, "d")) for i in range(4))
    rows = list(warc.records(io.BytesIO(data), len(data), lambda r: True, True, True))
    assert [(r["record_type"], r["page_id"], len(r["payload"])) for r in rows] == [
        ("warcinfo", None, 5), *[("response", i, i * 9000) for i in range(4)]]
    skipped = list(warc.records(io.BytesIO(data), len(data), lambda r: r["page_id"] == 3, False, False))
    assert [(r["page_id"], r["payload_bytes"]) for r in skipped] == [(3, 27000)]


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", None, False, "d").replace(b"payload\r\n\r\n", b"PAYLOAD\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data), len(data), lambda r: True, True, True))


def test_empty_table(spark, pages, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(warc.planned_records(pages.filter("false")), path)
    assert warc.read_archives(spark, path).count() == 0


def test_a_large_payload_is_read_in_linear_time():
    taken = []
    for size in (4 << 20, 64 << 20):
        body = random.Random(size).randbytes(1 << 20) * (size >> 20)
        packed = warc.member(warc.record(1, "u", body, None, False, "2024-01-01T00:00:00Z"))
        start = time.perf_counter()
        (row,) = warc.records(io.BytesIO(packed), len(packed), lambda _: True, True, True)
        taken.append(time.perf_counter() - start)
        assert row["payload"] == body
    # Sixteen times the bytes; a quadratic reader takes 256 times as long.
    assert taken[1] < 64 * taken[0]
