import hashlib
import io
import zlib

import pytest

from caseframe.llm.warc import WarcError, members, parsed, read_archives, record, round_trip, write_archives

PAGE = "page_id long, url string, html string, payload string, archive int"


def pages(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], PAGE)


ROWS = [
    (1, "http://a/\r\nX: y z", "é" * 60), (2, None, "é" * 60), (3, "http://c", None), (4, "u", ""),
    (5, "http://e", "short"), (6, "http://f", "short"), (None, "n", "é" * 60), (7, "h", "\r\n\r\n" * 50),
    (7, "h", "\r\n\r\n" * 50), (8, "big", "0123456789" * 300_000),
]


def test_edges(spark):
    found = round_trip(pages(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    by_id = {row["page_id"]: row for row in found}
    for page_id, _, html in ROWS:
        payload = (html or "").encode()
        assert by_id[page_id]["payload_bytes"] == len(payload)
        assert by_id[page_id]["payload_digest"] == hashlib.sha256(payload).hexdigest()
    assert {key: (row["record_type"], row["refers_to"]) for key, row in by_id.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("response", None),
        5: ("response", None), 6: ("response", None), None: ("revisit", 1), 7: ("response", None),
        8: ("response", None),
    }
    assert by_id[1]["url"] == "http://a/%0D%0AX:%20y%20z"
    assert round_trip(pages(spark, [])).count() == 0


def test_payloads_come_back(spark):
    archives = write_archives(pages(spark, ROWS))
    found = read_archives(archives, with_payload=True).filter("record_type = 'response'").collect()
    expected = {page_id: (html or "").encode() for page_id, _, html in ROWS}
    assert all(bytes(row["payload"]) == expected[row["page_id"]] for row in found)


def _member(content):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def test_members_are_read_one_by_one():
    records = [record(at, "u", bytes([at]) * at * 1000, hashlib.sha256(bytes([at]) * at * 1000).hexdigest(), None, False) for at in range(100)]
    stream = io.BytesIO(b"".join(map(_member, records)))
    assert [parsed(content)[0]["Content-Length"] for content in members(stream)] == [
        str(at * 1000) for at in range(100)
    ]


def test_damage_is_noticed():
    payload = b"payload"
    digest = hashlib.sha256(payload).hexdigest()
    good = record(1, "u", payload, digest, None, False)
    parsed(good)
    for bad in (
        good.replace(b"payload\r\n\r\n", b"paybad!\r\n\r\n"),
        good[:-5],
        good.replace(b"Content-Length: 7", b"Content-Length: 6"),
        good.replace(b"WARC/1.1", b"WARC/0.1"),
        record(1, "u", payload, hashlib.sha256(b"").hexdigest(), None, False),
    ):
        with pytest.raises(WarcError):
            parsed(bad)
    for bad in (_member(good)[:-3], b"no gzip at all"):
        with pytest.raises(WarcError):
            list(members(io.BytesIO(bad)))
