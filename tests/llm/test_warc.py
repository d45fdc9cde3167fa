"""Archives: round trip, index, coalesced ranges."""

import base64
import hashlib

from docstream.llm import warc

PAGES = "page_id long, url string, html string, payload string, key int"


def round_trip(pages, tmp_path, **how):
    index = warc.write_archives(warc.with_types(pages, "page_id", "url", "html", **how), f"file://{tmp_path}")
    return index, warc.read_records(index)


def test_round_trip(frame, tmp_path):
    html = ["<p>é</p>\r\n\r\nx", "", None, "<p>é</p>\r\n\r\nx", "y" * 200_000, "y" * 200_000, "WARC/1.1\r\n\r\n"]
    rows = [(k, f"http://a/ {k}\r\nX: 1", h, "clash", 9) for k, h in enumerate(html)] + [(4, "again", "y" * 200_000, None, None), (None, None, "z", None, None)]
    index, records = round_trip(frame(rows, PAGES), tmp_path)
    found = {(r["key"], r["record_type"]): r for r in records.collect()}
    assert records.count() == len(rows) == index.count()
    expected = {0: ("revisit", 3), 1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("revisit", 5), 5: ("response", None), 6: ("response", None), None: ("response", None)}
    for (key, kind), row in found.items():
        assert (kind, row["refers_to"]) == expected[key]
        payload = ("z" if key is None else html[key] or "").encode()
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert row["payload_bytes"] == len(payload)
        assert row["payload"] == (payload if kind == "response" else None)
        assert "\r" not in (row["url"] or "")


def test_small_payloads_are_all_responses(frame, tmp_path):
    rows = [(k, "u", h, None, None) for k, h in enumerate(["ab", "ab", "abcd", "abcd"])]
    _, records = round_trip(frame(rows, PAGES), tmp_path, min_bytes=3)
    assert {r["key"]: r["record_type"] for r in records.collect()} == {0: "response", 1: "response", 2: "revisit", 3: "response"}


def test_selected_records_and_foreign_index(spark, frame, tmp_path):
    rows = [(k, f"http://h/{k}", f"text {k}", None, None) for k in range(300)]
    index, _ = round_trip(frame(rows, PAGES).repartition(3), tmp_path)
    some = warc.read_records(index.filter("key % 50 = 7"))
    assert sorted(r["payload"].decode() for r in some.collect()) == sorted(f"text {k}" for k in range(300) if k % 50 == 7)
    again = warc.index_archives(spark, index.select("file").distinct())
    assert again.exceptAll(index).count() == 0 and again.count() == 300


def test_empty_table(frame, tmp_path):
    index, records = round_trip(frame([], PAGES), tmp_path)
    assert index.count() == records.count() == 0


def test_ranges():
    places = [(0, 10), (10, 5), (100, 5), (106, 4)]
    assert warc.ranges(places, gap=0, most=1000) == [(0, 2, 15), (2, 3, 105), (3, 4, 110)]
    assert warc.ranges(places, gap=100, most=1000) == [(0, 4, 110)]
    assert warc.ranges(places, gap=100, most=20) == [(0, 2, 15), (2, 4, 110)]
    assert warc.ranges([]) == []
