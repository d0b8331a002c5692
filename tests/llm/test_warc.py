"""Archives: an exact round trip of odd payloads, and records read by hand."""

import glob
import gzip
import hashlib

from shelflife.llm import warc

LONG = "<p>" + "x" * 200 + "</p>"
PAGES = [
    (5, "http://a/1", LONG), (2, "http://a/2", LONG), (9, "http://a/3", LONG),
    (3, "http://a/4", "short"), (4, None, "short"), (6, "http://a/5", None), (7, "", ""),
    (8, "http://a/\r\n6", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 30 + "été \U0001f600"),
    (10, "http://a/7", "\r\n\r\n" * 60), (11, "http://a/8", "line\nline\r" * 30 + "\x00"),
    (2, "http://a/2", LONG), (None, "http://a/9", "y" * 150), (12, "http://a/10", "y" * 99 + "é"),
    (13, "http://a/11", "z" * 2_000_000),
]


def test_round_trip(spark):
    rows = [(i, u, h, 1, "x") for i, u, h in PAGES]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n int, first string")
    found = warc.round_trip(pages, with_payload=True)
    by_payload = {}
    for i, _, h in PAGES:
        if i is not None and len((h or "").encode()) >= 100:
            by_payload[h] = min(i, by_payload.get(h, i))
    want = []
    for i, _, h in PAGES:
        first = by_payload.get(h)
        old = first is not None and first != i
        data = (h or "").encode()
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if old else "response", first if old else None))
    assert sorted(map(tuple, warc.digest(found).collect()), key=str) == sorted(want, key=str)
    for r in found.collect():
        assert r.request.record_id.startswith("<urn:capture:request:")
        assert r.metadata.headers["WARC-Concurrent-To"] == r.record_id
        if r.response.type == "response":
            assert hashlib.sha256(r.response.payload).hexdigest() == r.response.digest
        else:
            assert not r.response.payload
            assert r.original.record_id == r.response.refers_to and r.original.digest == r.response.digest
        assert (r.original is None) == (r.response.type == "response")


def test_archive_files(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:5], "page_id bigint, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/out", f"{tmp_path}/scratch")
    kinds = []
    for path in glob.glob(f"{tmp_path}/out/*.gz"):
        data = gzip.open(path).read()
        assert not data or data.endswith(b"\r\n\r\n")
        kinds += [h["WARC-Type"] for h, _ in warc.records_of(gzip.open(path))]
    assert sorted(kinds) == ["metadata"] * 5 + ["request"] * 5 + ["response"] * 3 + ["revisit"] * 2


def test_orphans_and_empty(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:2], "page_id bigint, url string, html string")
    assert warc.round_trip(pages.limit(0)).count() == 0
    warc.write_archives(pages, f"{tmp_path}/out", f"{tmp_path}/scratch")
    records = warc.read_records(spark, f"{tmp_path}/out")
    alone = warc.captures(records.where("type != 'metadata'")).collect()
    assert len(alone) == 2 and all(r.metadata is None and r.request for r in alone)


def test_every_reference_is_a_record(spark, tmp_path):
    pages = spark.createDataFrame(PAGES * 3, "page_id bigint, url string, html string").repartition(4)
    warc.write_archives(pages, f"{tmp_path}/out", f"{tmp_path}/scratch")
    kinds, refers = {}, []
    for path in glob.glob(f"{tmp_path}/out/*.gz"):
        for headers, _ in warc.records_of(gzip.open(path)):
            assert kinds.setdefault(headers["WARC-Record-ID"], headers["WARC-Type"]) == headers["WARC-Type"]
            refers += [headers["WARC-Refers-To"]] if "WARC-Refers-To" in headers else []
    assert len(kinds) == 9 * len(PAGES) and len(refers) == 6
    assert {kinds[x] for x in refers} == {"response"}
    records = warc.read_records(spark, f"{tmp_path}/out", with_payload=False)
    lost = warc.captures(records.where("type != 'response'")).collect()
    assert len(lost) == 6 and all(r.original is None and r.metadata for r in lost)
