"""WARC archives: revisits, and what a salvage finds after damage."""

import base64
import hashlib
import io
import random

import pytest

from docloom.llm import warc


def payloads(n, seed):
    rng = random.Random(seed)
    return [bytes(rng.choice(b"abc <>\r\nWARC/1.1") for _ in range(rng.choice([0, 10, 500, 3000]))) for _ in range(n)]


PAYLOADS = payloads(40, 1)
RECORDS = [warc.record(str(i), f"http://x/{i}", p, len(p), warc.sha1_32(p), None) for i, p in enumerate(PAYLOADS)]


def read(data):
    rows = list(warc.rows_of(io.BytesIO(data), len(data)))
    ends = [r["offset"] + r["n_bytes"] for r in rows]
    assert [r["offset"] for r in rows] == [0, *ends[:-1]][: len(rows)]
    assert not rows or ends[-1] == len(data)
    return [r for r in rows if not r.get("reason")], [r for r in rows if r.get("reason")]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archives(packed):
    records, gaps = read(b"".join(warc.member(r) if packed else r for r in RECORDS))
    assert [r["payload"] for r in records] == PAYLOADS and not gaps


def test_a_member_of_many_records():
    data = warc.member(b"".join(RECORDS))
    records, gaps = read(data)
    assert [r["payload"] for r in records] == PAYLOADS and not gaps
    records, gaps = read(data[:-3])
    assert [r["payload"] for r in records] == PAYLOADS[:-1] and len(gaps) == 1


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "zero"])
def test_later_records_are_recovered(packed, damage):
    parts = [warc.member(r) if packed else r for r in RECORDS]
    rng = random.Random(2)
    for _ in range(60):
        k = rng.randrange(len(parts))
        data, start = bytearray(b"".join(parts)), sum(map(len, parts[:k]))
        at = start + rng.randrange(len(parts[k]))
        if damage == "flip":
            data[at] ^= 1 << rng.randrange(8)
        elif damage == "cut":
            del data[at : min(at + 30, start + len(parts[k]))]
        elif damage == "insert":
            data[start:start] = bytes(rng.randrange(256) for _ in range(25))
        else:
            data[at : at + 50] = bytes(len(data[at : at + 50]))
        records, gaps = read(bytes(data))
        got = {r["record_id"] for r in records}
        expected = {f"urn:page:{i}" for i in range(len(parts)) if i not in (k, k + (damage == "zero"))}
        if damage == "insert":
            assert len(gaps) == 1 and gaps[0]["n_bytes"] == 25 and gaps[0]["offset"] == start
        assert expected <= got
        assert all(r["payload"] in PAYLOADS for r in records)


def test_garbage_and_nothing():
    assert read(b"") == ([], [])
    records, gaps = read(b"no archive at all" * 100)
    assert not records and [g["n_bytes"] for g in gaps] == [1700]
    records, gaps = read(b"WARC/1.1\r\nContent-Length: 99999999999999\r\n\r\nabc" + RECORDS[2])
    assert len(records) == 1 and len(gaps) == 1


def test_small_chunks(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 37)
    records, gaps = read(b"junk" + b"".join(warc.member(r) for r in RECORDS[:8]) + b"\x1f\x8b\x08junk" + RECORDS[8])
    assert [r["payload"] for r in records] == PAYLOADS[:9] and len(gaps) == 2


def test_pages_round_trip(spark):
    rows = [(1, "u", "a"), (2, None, "a"), (None, "u", "a"), (3, "b d\r\nx: y", None), (4, "", ""), (None, "u", "é中"), (5, "u", "é中 ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, digest string")
    got = {r["page_id"]: r for r in warc.pages_of(warc.read(warc.write(df.where("page_id IS NOT NULL")))).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None),
    }
    for page, _, html in rows:
        if page:
            data = (html or "").encode()
            assert got[page]["payload_bytes"] == len(data)
            assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    every = warc.pages_of(warc.read(warc.write(df))).collect()
    assert len(every) == len(rows)
    assert sorted(r["record_type"] for r in every if r["page_id"] is None) == ["response", "revisit"]
    assert all(bytes(r["payload"]) == "é中 ".encode() for r in every if r["page_id"] == 5)
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_files_are_bounded_and_least_is_kept(spark):
    df = spark.createDataFrame([(i, "u", "same" if i % 2 else "longer text") for i in range(40)], "page_id bigint, url string, html string")
    files = warc.write(df, least=5, file_bytes=2000)
    assert files.count() > 3
    got = warc.pages_of(warc.read(files)).collect()
    assert {r["record_type"] for r in got if r["page_id"] % 2} == {"response"}
    assert {r["refers_to"] for r in got if not r["page_id"] % 2 and r["page_id"] < 38} == {38}


def test_repeated_page_ids_are_all_responses(spark):
    df = spark.createDataFrame([(2, "u", "a"), (2, "u", "a"), (1, "u", "a")], "page_id bigint, url string, html string")
    got = sorted((r["page_id"], r["record_type"]) for r in warc.pages_of(warc.read(warc.write(df))).collect())
    assert got == [(1, "revisit"), (2, "response"), (2, "response")]


def test_headers_of_any_length(spark):
    url = "http://a.example/" + "x" * (2 * 1024 * 1024)
    pages = spark.createDataFrame([(1, url, "<p>a</p>"), (2, "http://b.example/", "<p>b</p>")], "page_id bigint, url string, html string")
    rows = warc.read(warc.write(pages)).collect()
    assert all(r["reason"] is None for r in rows) and {r["uri"] for r in rows} == {url, "http://b.example/"}
