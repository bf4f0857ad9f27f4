import hashlib

from holdfast.llm import warc

BIG = "x" * 1200


def test_round_trip(spark):
    pages = [(1, "http://a/ b\né", BIG), (7, None, BIG), (3, "u", BIG), (None, "n", BIG), (4, "e", None), (5, "s", "é" * 3), (6, "s", "é" * 3)]
    pages += [(9, "same", "y" * 1000)] * 2
    table = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    files = warc.rewrite_archives(warc.resolve(warc.write_archives(table)))
    records = warc.read_archives(files)
    got = warc.with_originals(records).collect()
    assert len(got) == len(pages)
    by_page = {}
    for row in got:
        by_page.setdefault(row["page_id"], []).append((row["record_type"], row["refers_to"], row["payload_bytes"]))
    assert by_page[7] == [("response", None, 1200)]
    assert by_page[1] == by_page[3] == by_page[None] == [("revisit", 7, 1200)]
    assert by_page[4] == [("response", None, 0)]
    assert by_page[5] == by_page[6] == [("response", None, 6)]
    assert sorted(x[0] for x in by_page[9]) == ["response", "revisit"]
    payloads = {r["page_id"]: r["payload"] for r in records.collect()}
    assert payloads[7] == BIG.encode() and payloads[1] is None and payloads[6] == ("é" * 3).encode()
    digests = {r["page_id"]: r["payload_digest"] for r in got}
    assert digests[1] == hashlib.sha1(BIG.encode()).hexdigest()


def test_empty_table(spark):
    table = spark.createDataFrame([], "page_id bigint, url string, html string")
    files = warc.rewrite_archives(warc.resolve(warc.write_archives(table)))
    assert warc.with_originals(warc.read_archives(files)).count() == 0


def test_archives_roll(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 2)
    writer_limit = warc.ARCHIVE_RECORDS
    table = spark.createDataFrame([(i, "u", BIG + str(i % 3)) for i in range(9)], "page_id bigint, url string, html string")
    headers = warc.write_archives(table)
    assert writer_limit == 2 and headers.count() == 9
    got = warc.with_originals(warc.read_archives(warc.rewrite_archives(warc.resolve(headers)))).collect()
    assert {r["page_id"]: r["refers_to"] for r in got} == {i: None if i > 5 else 6 + i % 3 for i in range(9)}
