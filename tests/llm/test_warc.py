"""Archives: what is written is read back whole, and what is broken is noticed."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from basketry.llm import common, queries, warc
from workload.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
KIND = "page_id bigint, url string, html string, digest string, response string, salt string"


def pages_by_definition(rows, least=1000):
    stored = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None:
            stored[body] = max(page, stored.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= least and body in stored and page != stored[body]
        out.append((
            page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response",
            stored[body] if again else None,
        ))
    return sorted(out, key=repr)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "d", "r", "s") for r in rows], KIND).repartition(parts)


def odd_rows():
    rng = random.Random(5)
    big = "".join(rng.choice("abc é\r\n0<>") for _ in range(70_000))
    same = "<p>same page</p>\r\n\r\nWARC/1.1\r\n" * 60
    rows = [(i, f"http://a/{i}", f"<html>page {i}</html>" * (i + 1)) for i in range(30)]
    rows += [(100 + i, f"http://b/{i} é\r\nX: y", same) for i in range(25)]
    rows += [(200, None, None), (201, "u", ""), (None, "n", None), (None, "n", same), (None, "n", "alone " * 300)]
    rows += [(None, "m", "alone " * 300), (202, "u", "tiny"), (203, "u", "tiny")]
    rows += [(300, "u", big), (301, "u", big), (301, "u", big), (301, "u", big[:-1]), (124, "twice", same)]
    rows += [(302, "u", "x" * 999), (303, "u", "x" * 999), (304, "u", "y" * 1000), (305, "u", "y" * 1000)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"segment_bytes": 300, "records_per_file": 7, "chunk_bytes": 11}])
def test_round_trip_of_odd_rows(spark, sizes):
    rows = odd_rows()
    found = warc.written_and_read(table(spark, rows), **sizes)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == pages_by_definition(rows)


def test_empty_table(spark):
    assert warc.written_and_read(table(spark, [])).count() == 0


def test_payloads_and_urls_come_back(spark):
    rows = [(1, "http://a/b c", "é" * 50_000), (2, None, "small")]
    folder = common.work_dir(spark, "archives")
    warc.write_archives(table(spark, rows, 1), folder)
    found = {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}
    assert {k: bytes(r["payload"]).decode() for k, r in found.items()} == {i: h for i, _, h in rows}
    assert found[1]["url"] == "http://a/b%20c" and found[2]["url"].startswith("urn:uuid:")
    assert all(r["problem"] is None and r["digest"] == hashlib.sha1(bytes(r["payload"])).hexdigest()
               for r in found.values())


def raw_records(spark, folder):
    """The unpacked bytes of all files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).orderBy("path").collect()
    return [gzip.decompress(bytes(r["content"])) for r in files]


def test_segments_follow_the_format(spark):
    folder = common.work_dir(spark, "archives")
    warc.write_archives(table(spark, [(1, "http://a", "x" * 1000)], 1), folder, segment_bytes=300, records_per_file=2)
    files = raw_records(spark, folder)
    assert len(files) > 2, "segments lie in several files"
    records = [r for data in files for r in warc.parse(data)]
    assert records[0].fields["warc-type"] == "warcinfo"
    first, *rest = records[1:]
    assert first.fields["warc-segment-number"] == "1" and first.fields["warc-type"] == "response"
    assert [r.fields["warc-segment-number"] for r in rest] == [str(k) for k in range(2, len(rest) + 2)]
    assert {r.fields["warc-segment-origin-id"] for r in rest} == {first.fields["warc-record-id"]}
    totals = [r.fields.get("warc-segment-total-length") for r in rest]
    assert totals == [None] * (len(rest) - 1) + [str(sum(len(r.block) for r in records[1:]))]
    assert len({r.fields["warc-record-id"] for r in records}) == len(records)


def written_by_hand(spark, records, name):
    """Records, each with its fields and block, as one file of one member per record."""
    folder = common.work_dir(spark, name)
    rows = [(warc.record(f, b).decode("latin1"),) for f, b in records]
    spark.createDataFrame(rows, "value string").coalesce(1).select(F.encode("value", "ISO-8859-1").cast("string")).write.option(
        "lineSep", warc.END
    ).option("compression", "gzip").text(folder)
    return {r["record_id"]: r for r in warc.read_archives(spark, folder).collect()}


HTTP = b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n"


def piece(origin, number, block, total=None):
    if number == 1:
        return {"WARC-Type": "response", "WARC-Record-ID": origin, "WARC-Segment-Number": 1}, block
    return {
        "WARC-Type": "continuation", "WARC-Record-ID": f"{origin}-{number}", "WARC-Segment-Origin-ID": origin,
        "WARC-Segment-Number": number, "WARC-Segment-Total-Length": total,
    }, block


def test_archives_of_others(spark):
    body = HTTP + b"4;name=v\r\nwiki\r\n5\r\npedia\r\n0\r\nTrailer: x\r\n\r\n"
    cut = len(body) - 20
    whole = {"WARC-Type": "response"}
    records = [
        (whole | {"WARC-Record-ID": "chunks"}, body),
        (whole | {"WARC-Record-ID": "plain"}, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\r\n\r\n"),
        ({"WARC-Type": "resource", "WARC-Record-ID": "thing"}, b"as it is"),
        ({"WARC-Type": "request", "WARC-Record-ID": "asked"}, b"GET / HTTP/1.1\r\n\r\n"),
        piece("late", 2, body[cut:], len(body)), piece("late", 1, body[:cut]),
        piece("gap", 1, body[:5]), piece("gap", 3, body[5:], len(body)),
        piece("open", 1, body[:5]), piece("open", 2, body[5:]),
        piece("short", 1, body[:5]), piece("short", 2, body[5:], len(body) + 1),
        piece("twice", 1, body[:5]), piece("twice", 2, body[5:], len(body)), piece("twice", 2, body[5:], len(body)),
        (whole | {"WARC-Record-ID": "bad length"}, HTTP + b"zz\r\nwiki\r\n0\r\n\r\n"),
        (whole | {"WARC-Record-ID": "bad end"}, HTTP + b"3\r\nwiki\r\n0\r\n\r\n"),
        (whole | {"WARC-Record-ID": "cut"}, HTTP + b"4\r\nwiki\r\n"),
        (whole | {"WARC-Record-ID": "no trailer"}, HTTP + b"4\r\nwiki\r\n0\r\n"),
        (whole | {"WARC-Record-ID": "no head"}, b"something else"),
        (whole | {"WARC-Record-ID": "digest", "WARC-Payload-Digest": "sha1:00"}, HTTP + b"0\r\n\r\n"),
    ]
    found = written_by_hand(spark, records, "foreign")
    good = {k: bytes(r["payload"]) for k, r in found.items() if r["problem"] is None}
    assert good == {"chunks": b"wikipedia", "plain": b"\x00\xff\r\n\r\n", "thing": b"as it is", "late": b"wikipedia"}
    assert {k: r["problem"] for k, r in found.items() if k not in good} == {
        "gap": "segments missing or repeated", "twice": "segments missing or repeated",
        "open": "last segment missing", "short": "segments do not add up to the total length",
        "bad length": "chunk length", "bad end": "chunk end", "cut": "chunk length",
        "no trailer": "chunk trailer", "no head": "HTTP head", "digest": "digest differs",
    }


def test_problems_stop_the_report(spark):
    kinds = "record_id string, record_type string, page_id bigint, url string, digest string, refers_to string, "
    frame = lambda *rows: spark.createDataFrame(list(rows), kinds + "payload binary, problem string")
    lost = frame(("a", "revisit", 1, "u", "00", "b", None, None))
    broken = frame(("a", "response", 1, "u", "00", None, None, "chunk end"))
    for df, text in ((lost, "no response"), (broken, "chunk end")):
        with pytest.raises(Exception, match=text):
            warc.page_records(df).collect()


@pytest.mark.parametrize("data", [b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n", b"HTTP\r\n\r\n", b"WARC/1.1\r\nX"])
def test_files_that_cannot_be_told_apart(data):
    with pytest.raises(ValueError):
        list(warc.parse(data))


def test_query_against_sql(spark):
    assert compare(spark, connect(FOLDER), "op12_warc", FOLDER) is None
    assert "op12_warc" in queries.ORACLES and "op12_warc" in entry_point.oracle_sql()
