from __future__ import annotations

import hashlib
import random
import struct

import pytest
import zstandard

from riskmart.llm import archives

from .conftest import prose

PAGES = "page_id long, url string, html string"


def build(spark, rows):
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS digest", "1 AS size", "2 AS body", "3 AS first")


def round_trip(spark, tmp_path, rows):
    folder = f"file://{tmp_path}/warc"
    listed = archives.write_archives(build(spark, rows), folder)
    return archives.read_archives(spark, folder, listed).collect(), [r.archive for r in listed.collect()], folder


def test_records_and_revisits(spark, tmp_path):
    long, short = "<p>é</p>" + "a" * 120, "<p>short</p>"
    rows = [(5, "http://a/", long), (3, "http://b/\r\nX: y", long), (9, None, long), (1, "u", short), (2, "u", short), (4, "u", None), (6, "u", ""), (7, "u", "b" * 99), (8, "u", "b" * 99)]
    found, _, _ = round_trip(spark, tmp_path, rows)
    got = {int(r.page_id): r for r in found}
    assert len(found) == len(rows)
    for page, _, html in rows:
        body = (html or "").encode()
        assert got[page].payload_digest == hashlib.sha256(body).hexdigest() and got[page].payload_bytes == len(body)
        revisit = html == long and page != 3
        assert (got[page].record_type, got[page].refers_to) == (("revisit", "3") if revisit else ("response", None))
        assert got[page].payload is None if revisit else bytes(got[page].payload) == body
    assert got[3].target_uri == "http://b/ X: y" and got[9].target_uri == ""


def test_rows_without_id_and_repeated_rows(spark, tmp_path):
    body = "z" * 200
    found, _, _ = round_trip(spark, tmp_path, [(2, "u", body), (2, "u", body), (None, "u", body), (None, "v", "w" * 300), (None, None, None)])
    kinds = sorted((r.page_id or "", r.record_type, r.refers_to or "") for r in found)
    assert kinds == [("", "response", ""), ("", "response", ""), ("", "revisit", "2"), ("2", "response", ""), ("2", "response", "")]


def test_empty_table(spark, tmp_path):
    found, names, _ = round_trip(spark, tmp_path, [])
    assert found == [] and names == []


def test_archives_are_cut_and_records_stand_alone(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/cut"
    (tmp_path / "cut").mkdir()
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", 300_000)
    monkeypatch.setattr(archives, "SAMPLE_BYTES", 200_000)
    records = [archives.record(str(i), "u", prose(i, 200).encode(), 1, "d", None, "t") for i in range(500)]
    writer, listed = archives.ArchiveWriter(folder), []
    for data in records:
        listed += writer.add(data)
    listed += writer.close()
    assert len(listed) > 1 and sum(n for _, n in listed) == 500
    assert [d for name, _ in listed for d in archives.read_archive(folder, name, block=1000)] == records
    assert not list((tmp_path / "cut").glob("*.part"))
    data = (tmp_path / "cut" / listed[0][0]).read_bytes()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 0
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert dictionary.dict_id()
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[8 + size :])
    assert first == records[0]


def test_dictionary_pays(tmp_path):
    records = [archives.record(str(i), "http://x.example/", prose(i, 60).encode(), 1, "d", None, "t") for i in range(3000)]
    dictionary = archives.build_dictionary(records)
    alone = sum(len(zstandard.ZstdCompressor(3).compress(r)) for r in records)
    assert sum(len(zstandard.ZstdCompressor(3, dict_data=dictionary).compress(r)) for r in records) < 0.8 * alone


def test_few_records_need_no_dictionary(spark, tmp_path):
    assert archives.build_dictionary([b"a"]) is None
    found, names, folder = round_trip(spark, tmp_path, [(1, "u", "x")])
    assert len(names) == 1 and bytes(found[0].payload) == b"x"


def test_damaged_archives_are_noticed(tmp_path):
    (tmp_path / "a").write_bytes(b"12345678")
    with pytest.raises(ValueError):
        list(archives.read_archive(str(tmp_path), "a"))
    frame = zstandard.ZstdCompressor().compress(random.Random(1).randbytes(1000))
    (tmp_path / "b").write_bytes(struct.pack("<II", archives.SKIPPABLE, 0) + frame[:-10])
    with pytest.raises(ValueError):
        list(archives.read_archive(str(tmp_path), "b"))


def test_folder_names_its_file_system(spark):
    assert archives.archive_folder(spark).startswith("file:///")
