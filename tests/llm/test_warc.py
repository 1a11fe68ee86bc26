"""Compressed archives: payloads that aren't wanted are not decompressed; other writers' members are read, too."""

import gzip
import io

import pytest

from vitrine.llm import warc


def pages(spark):
    rows = [(i, f"u{i}", chr(97 + i) * 200_000) for i in range(6)] + [(7, "u", "b" * 200_000), (8, "v", "s"), (8, "v", "s"), (9, "w", None), (10, "x", "k" * 300), (10, "x", "k" * 300)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


@pytest.mark.parametrize("most", [500_000, -1])
def test_members(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warc, "MOST_REPEATED", most)
    path = str(tmp_path / "w")
    warc.write_warc(warc.mark_revisits(pages(spark)), path, compression="gzip")
    rows = warc.read_warc(spark, path).collect()
    assert len(rows) == 12 and [(r["record_id"], r["refers_to"]) for r in rows if r["record_type"] == "revisit"] == [("urn:page:7", "urn:page:1")]
    assert sorted((r["record_id"], bytes(r["payload"] or b"")[:1], r["payload_length"]) for r in rows if r["record_type"] == "response" and r["payload_length"] >= 300)[:2] == [("urn:page:0", b"a", 200_000), ("urn:page:1", b"b", 200_000)]
    assert sum(r["record_id"] == "urn:page:10" and r["record_type"] == "response" for r in rows) == 2  # equal ids and payloads: both
    assert warc.read_warc(spark, path, payload=False).where("record_id = 'urn:page:3'").first()["payload_length"] == 200_000
    assert not [p for p in (tmp_path / "w").iterdir() if p.name.startswith(".")]
    for p in (tmp_path / "w").iterdir():  # any gzip reader reads them
        assert gzip.decompress(p.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_skips(tmp_path):
    """Bytes that a reader of one record among many decompresses."""
    path, seen = tmp_path / "a.warc.gz", [0]
    with open(path, "wb") as out:
        for i in range(20):
            plain = io.BytesIO()
            warc.write_record(plain, "response", f"r{i}", "u", bytes(str(i), "ascii") * 300_000, "d", 300_000, None, "t")
            out.write(warc.packed(plain.getvalue()))

    class Counting(warc.Member):
        def readinto(self, b):
            n = super().readinto(b)
            seen[0] += n
            return n

    reader = warc.WarcReader({"path": str(path)})
    reader.wanted = {"record_id": {"r3"}}
    before, warc.Member = warc.Member, Counting
    try:
        with open(path, "rb") as raw:
            rows = list(reader._members(raw, str(path)))
    finally:
        warc.Member = before
    assert [(r[1], len(r[7]), r[7][:1]) for r in rows] == [("r3", 300_000, b"3")] and seen[0] < 300_000 + 20 * 8192


def test_members_of_others(spark, tmp_path):
    (tmp_path / "w").mkdir()
    record = io.BytesIO()
    warc.write_record(record, "response", "x", "u", b"hello", "d", 5, None, "t")
    (tmp_path / "w/a.warc.gz").write_bytes(warc.packed(record.getvalue()) + gzip.compress(record.getvalue()) + gzip.compress(record.getvalue() * 2))
    assert [bytes(r["payload"]) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()] == [b"hello"] * 4


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    for options in ({}, {"compression": "gzip"}):
        warc.write_warc(warc.mark_revisits(pages(spark).limit(0)), path, **options)
    assert warc.read_warc(spark, path).count() == 0
