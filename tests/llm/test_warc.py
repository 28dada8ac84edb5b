import gzip
import hashlib
import random

import pytest

from pageloom.llm import warc
from pageloom.llm.scratch import Scratch
from pageloom.llm.warc import Unchunker, chunked, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, sha string, first_id long"


def trip(spark, rows, segment):
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)
    path = Scratch(spark, "test-warc").new_path("warc")
    write_archives(df, path, segment)
    return path, read_archives(spark, path, payloads=True).collect()


ROWS = [
    (1, "http://a/1", "é" * 5000), (2, None, None), (3, "u\r\nX: y", "same " * 40), (4, "http://a", "same " * 40), (5, "http://b", "small"), (6, "", "small"),
    (7, "http://c", "WARC/1.1\r\n\r\n0\r\n\r\n" * 50), (None, "http://n", "same " * 40), (9, "http://c", ""), (10, "http://long", "0123456789" * 20_000),
]


@pytest.mark.parametrize("segment", [1, 97, 32 << 10])
def test_round_trip(spark, segment):
    rows = ROWS if segment > 1 else ROWS[1:7]
    _, got = trip(spark, rows, segment)
    assert len(got) == len(rows)
    found = {r["page_id"]: r for r in got}
    for page_id, _, html in rows:
        payload, r = (html or "").encode(), found[page_id]
        revisit = html == "same " * 40 and page_id != 3
        assert r["problem"] is None
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert revisit or bytes(r["payload"]) == payload


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    path = Scratch(spark, "test-warc").new_path("warc")
    write_archives(df, path)
    assert read_archives(spark, path).count() == 0


def test_repeated_rows(spark):
    _, got = trip(spark, [(1, "u", "z" * 200)] * 3, 64)
    assert [(r["record_type"], r["payload_bytes"], r["problem"]) for r in got] == [("response", 200, None)] * 3


def test_faults(spark, tmp_path):
    block = warc.HTTP_HEAD + chunked(b"payload" * 30)
    row = {"page_id": 1, "url": "u", "html": "payload" * 30, "sha": hashlib.sha256(b"payload" * 30).hexdigest(), "first_id": None, "first_url": None}
    records = list(warc.records_of(row, "t-0", 64))
    assert len(records) == -(-len(block) // 64)
    end = b"\r\n\r\n"
    for name, kept in {"gap": records[:1] + records[2:], "no-end": records[:-1], "twice": records[:2] + records[1:], "cut": [*records[:-1], records[-1][:-3]]}.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(end.join(kept) + (b"" if name == "cut" else end)))
        got = read_archives(spark, str(tmp_path / f"{name}.warc.gz")).collect()
        assert len(got) == 1 and got[0]["problem"], name


def record(page_id, html):
    row = {"page_id": page_id, "url": "u", "html": html, "sha": hashlib.sha256(html.encode()).hexdigest(), "first_id": None, "first_url": None}
    return list(warc.records_of(row, f"t-{page_id}"))[0] + b"\r\n\r\n"


def test_damaged_archives(spark, tmp_path):
    """Damage is named in its record or file; what stands before it, and after it where records can be told apart, is read."""
    noise = random.Random(2)
    first, second = (record(i, "".join(chr(noise.randrange(33, 127)) for _ in range(3000))) for i in (1, 2))
    third = record(3, "third")
    whole = gzip.compress(first + second + third)
    flipped = bytearray(whole)
    flipped[-6] ^= 1  # the check sum
    cases = {
        "cut-gzip": (whole[: len(whole) * 3 // 4], {1: None, 2: "cut record"}),
        "no-trailer": (whole[:-8], {1: None, 2: None, 3: None, None: "cut file"}),
        "check-sum": (bytes(flipped), {1: None, 2: None, 3: None, None: "damaged file"}),
        "not-gzip": (b"\x1f\x8b" + b"x" * 50, {None: "damaged file"}),
        "latin-header": (gzip.compress(first.replace(b"WARC-Target-URI: u", b"WARC-Target-URI: \xe9") + third), {1: "bad header", 3: None}),
        "bad-length": (first + second.replace(b"Content-Length: ", b"Content-Length: x") + third, {1: None, 2: "bad length", 3: None}),
        "negative-length": (first.replace(b"Content-Length: ", b"Content-Length: -") + third, {1: "bad length", 3: None}),
        "no-length": (first.replace(b"Content-Length: ", b"Other: ") + third, {1: "bad length", 3: None}),
        "huge-length": (first.replace(b"Content-Length: ", b"Content-Length: 9999999") + third, {1: "cut record"}),
        "cut-header": (first + second[:60], {1: None, None: "cut record"}),
        "bad-id": (first.replace(b"Page-ID: 1", b"Page-ID: 1" + b"0" * 30) + third, {None: "bad number", 3: None}),
        "bad-segment": (first.replace(b"WARC-Type: response", b"WARC-Type: response\r\nWARC-Segment-Number: one") + third, {1: "bad number", 3: None}),
        "no-id": (first.replace(b"WARC-Type: response", b"WARC-Segment-Number: 1").replace(b"WARC-Record-ID", b"Other") + third, {1: "no record id", 3: None}),
        "other-digest": (first.replace(b"sha256:", b"sha1:") + third, {1: None, 3: None}),
        "empty": (b"", {}),
    }
    for name, (content, _) in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc.gz").write_bytes(content)
    for name, (_, expected) in cases.items():
        got = read_archives(spark, str(tmp_path / name), payloads=True).collect()
        assert {r["page_id"]: r["problem"] for r in got} == expected and len(got) == len(expected), name
        assert all(r["payload"] is None for r in got if r["problem"]) and all(r["payload"] is not None for r in got if not r["problem"]), name


def test_unchunker_takes_any_pieces():
    message = warc.HTTP_HEAD + chunked(b"ab\r\n0\r\n\r\ncd" * 9, 7)
    for step in (1, 2, 3, 1000):
        reader = Unchunker()
        for i in range(0, len(message), step):
            reader.feed(message[i : i + step])
        assert reader.fault() is None and reader.digest.hexdigest() == hashlib.sha256(b"ab\r\n0\r\n\r\ncd" * 9).hexdigest()
    broken = Unchunker()
    broken.feed(message.replace(b"7\r\nab", b"g\r\nab"))
    assert broken.fault()
