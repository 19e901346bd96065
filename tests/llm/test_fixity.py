"""Fixity audit: record bytes, tree descent and located damage."""

import hashlib

import pytest

from martforge.llm import fixity as fx
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, row int, record string, shard string, status int"


def pages(spark, n=300):
    rows = [(i, f"http://h/{i % 7}", f"<p>é{i}</p>" * (i % 50), 1, "r", "s", 2) for i in range(n)]
    if n:
        rows += [(5, "again", "x", 1, "", "", 0), (5, "again", "x", 1, "", "", 0),
                 (None, None, None, None, None, None, None), (n, "a\r\nb", "", 1, "", "", 0),
                 (n + 1, "", "long " * 50_000, 1, "", "", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(records):
    """sorted records -> (shard, offset, length, sha) with small shards"""
    out, offset = [], 0
    for i, r in enumerate(records):
        if i % fx.SHARD_RECORDS == 0:
            offset = 0
        out.append((i // fx.SHARD_RECORDS, offset, len(r), hashlib.sha256(r).hexdigest()))
        offset += len(r)
    return out


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(fx, "SHARD_RECORDS", 40)
    monkeypatch.setattr(fx, "RANGE_BYTES", 2000)
    monkeypatch.setattr(fx, "FANOUT", 3)


def test_record_bytes(spark):
    row = pages(spark).filter("page_id = 300").select(
        fx.warc_record(F.col("page_id"), F.col("url"), F.col("html"))).first()
    assert bytes(row[0]) == (
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:300>\r\n"
        b"WARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Target-URI: a%0D%0Ab\r\n"
        b"Content-Type: text/html\r\nContent-Length: 0\r\n\r\n\r\n\r\n")


def test_report_locates_all_damage(spark, small):
    archive = fx.write_archive(pages(spark))
    replica = fx.damaged_copy(archive, F.col("page_id").isin(7, 250, 301), F.col("page_id") == 90)
    rows = fx.fixity_report(archive, replica).collect()
    stored = sorted((r for r in archive.collect()),
                    key=lambda r: (r.page_id is not None, r.page_id or 0, r.row))
    want = brute([bytes(r.record) for r in stored])
    assert sorted((r.shard, r.offset, r.length, r.sha256) for r in rows) == want
    assert {(r.page_id, r.status) for r in rows if r.status != "intact"} == {
        (7, "corrupt"), (250, "corrupt"), (301, "corrupt"), (90, "missing")}


def test_report_names_added_records(spark, small):
    everything = fx.write_archive(pages(spark))
    added = F.coalesce(F.col("page_id") % 3 == 1, F.lit(True))
    archive = everything.filter(~added)
    replica = fx.damaged_copy(everything, F.col("page_id") == 3, F.col("page_id") == 9)
    rows = fx.fixity_report(archive, replica).collect()
    extra = everything.filter(added).collect()
    assert len(rows) == everything.count() and len({(r.shard, r.offset) for r in rows}) == len(rows)
    assert sorted((str(r.page_id), r.length, r.sha256) for r in rows if r.status == "extra") == sorted(
        (str(r.page_id), len(r.record), hashlib.sha256(r.record).hexdigest()) for r in extra)
    assert {(r.page_id, r.status) for r in rows if r.status not in ("intact", "extra")} == {
        (3, "corrupt"), (9, "missing")}
    assert {r.status for r in fx.fixity_report(everything.filter("false"), replica).collect()} == {"extra"}


def test_extra_records_and_descent(spark, small):
    archive = fx.write_archive(pages(spark))
    places = fx.catalogue(archive)
    form = fx.shape(places)
    assert form[1] >= 4
    full, part = fx.digests(archive, places), fx.digests(archive.filter("page_id <> 8"), places)
    a, b = fx.merkle_tree(part, form), fx.merkle_tree(full, form)
    assert len(a) == form[1] + 1 and b[-1].count() == 1
    # the NULL page fails the filter too, so two records are extra
    assert [r.status for r in fx.audit(a, b, part, full, form).collect()] == ["extra"] * 2
    assert fx.audit(b, b, full, full, form).count() == 0
    for x, y in zip(a, b, strict=True):  # at most one path per record differs
        assert x.join(y, ["node", "hash"], "left_anti").count() <= 2


def test_empty_archive(spark):
    archive = fx.write_archive(pages(spark, 0))
    assert fx.fixity_report(archive, archive).count() == 0
