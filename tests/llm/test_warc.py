import hashlib

import pytest
import zstandard

from turnloom.llm import warc

from .cases import SF

SCHEMA = "page_id bigint, url string, html string"


def check(spark, rows):
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, SCHEMA))).collect()
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html) if len(data) >= 100 and i is not None else None
        revisit = lead is not None and lead != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_round_trip(spark):
    long = "<p>é</p>" * 40
    rows = [(5, "http://a", long), (3, None, long), (9, "x\r\ny", long), (3, None, long), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (6, "u", ""), (7, "u", "z" * 100), (8, "u", "z" * 100), (None, None, long), (10, "u", "b" * 700_000)]
    check(spark, rows)


def test_real_pages_and_empty_table(spark):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()])
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], SCHEMA))).collect() == []


def test_random_access_and_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    bundle = warc.Bundle()
    for i in range(40):
        html = f"<p>{i}</p>" * 20
        bundle.add(*warc.record(i, f"http://x/{i}", html.encode(), 3 if i == 7 else None, hashlib.sha256(html.encode()).hexdigest()))
    data = bundle.close()
    reader = warc.Reader(data)
    assert len(reader.starts) > 5
    fields, body = warc.parse(warc.lookup(data, 31))
    assert fields["WARC-Target-URI"] == "http://x/31" and body == b"<p>31</p>" * 20
    fields, body = warc.parse(warc.lookup(data, 7))
    assert fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == "<urn:page:3>" and body == b""
    assert warc.lookup(data, 99) is None
    # any Zstandard reader sees the records alone: the index and the table are skippable
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1") == 40
    table = spark.createDataFrame([("a", 40, bytearray(data))], "archive_id string, n_records bigint, archive binary")
    warc.export(table, "a", str(tmp_path / "a.warc.zst"))
    assert (tmp_path / "a.warc.zst").read_bytes() == data
    with pytest.raises(KeyError):
        warc.export(table, "b", str(tmp_path / "b"))


def test_damage_is_seen():
    bundle = warc.Bundle()
    bundle.add(*warc.record(1, "u", b"payload", None, hashlib.sha256(b"other").hexdigest()))
    with pytest.raises(ValueError, match="seek table"):
        warc.Reader(bundle.close()[:-1])
