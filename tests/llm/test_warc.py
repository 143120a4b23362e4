import hashlib
import io
import zipfile

import duckdb
import pytest

from termflow.llm.common import shared_folder
from termflow.llm.warc import (DATA, ORACLE_SQL, ZipDirectory, op7_warc_archives, parse_record, read_index,
                               read_records, record_bytes, write_archives)

SF = "/root/testdata/sf0.001"


def directory(raw):
    return ZipDirectory(lambda at, size: raw[at:at + size], len(raw))


@pytest.mark.parametrize("zip64", [False, True])
@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_directories_of_the_standard_writer(zip64, method):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for i in range(70_000 if zip64 else 3):
            z.writestr(zipfile.ZipInfo(f"a/ö{i}"), b"%d " % i * 5, method)
        z.comment = b"a comment"
    got = directory(out.getvalue())
    assert len(got.members) == (70_000 if zip64 else 3)
    assert got.content("a/ö2") == b"2 2 2 2 2 "


def test_sizes_beyond_32_bits():
    # A central directory whose sizes and offset stand in the ZIP64 field.
    import struct
    name = b"big"
    extra = struct.pack("<HHQQQ", 1, 24, 1 << 33, 1 << 33, 1 << 34)
    entry = (b"PK\1\2" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name),
                                     len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra)
    end64 = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), 0)
    raw = entry + end64 + b"PK\6\7" + struct.pack("<IQI", 0, len(entry), 1) + b"PK\5\6" + struct.pack(
        "<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    m = directory(raw).members["big"]
    assert (m.size, m.stored, m.header) == (1 << 33, 1 << 33, 1 << 34)


def test_damaged():
    with pytest.raises(ValueError):
        directory(b"nothing")
    with pytest.raises(ValueError):
        parse_record(b"HTTP/1.1 200 OK\r\n\r\n")


def test_record_round_trip():
    raw = record_bytes(7, "http://x/ä\r\nb", b"a\r\n\r\nb", hashlib.sha1(b"a\r\n\r\nb").hexdigest(), None, "2020-01-01T00:00:00Z")
    got = parse_record(raw)
    assert got["payload"] == b"a\r\n\r\nb" and got["page_id"] == 7 and got["target_uri"] == "http://x/ä%0D%0Ab"
    assert got["declared_digest"] == hashlib.sha1(got["payload"]).hexdigest() and got["record_type"] == "response"


def sql(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}'")
    return sorted(con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLE_SQL})")
                  .fetchall(), key=str)


def test_pages_against_sql(spark):
    got = op7_warc_archives(spark, SF).collect()
    assert sorted([tuple(r) for r in got], key=str) == sql(f"{SF}/pages.parquet")


def test_copies_nulls_and_small_archives(spark, tmp_dir):
    big, other = "x" * 999 + "é", "y" * 2000
    rows = [(1, "u", big, 0), (5, "u", big, 0), (5, "u", big, 0), (3, None, big, 0), (2, "a\nb", other, 0), (9, "v", other, 1),
            (4, "w", "small", 0), (6, "w", "small", 0), (7, "z", None, 0), (8, "z", "", 0), (None, "n", big, 0), (5, "q", "else", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    archives = write_archives(df, shared_folder(spark, "warc-test"), archive_bytes=300)
    assert archives.count() > 3 and archives.agg({"records": "sum"}).first()[0] == len(rows)
    got = read_records(read_index(archives)).collect()
    kept = {(r.page_id, r.record_type, r.refers_to, None if r.payload is None else r.payload.decode()) for r in got}
    assert len(got) == len(rows)
    assert (1, "revisit", 5, None) in kept and (3, "revisit", 5, None) in kept and (5, "response", None, big) in kept
    assert (2, "revisit", 9, None) in kept and (None, "response", None, big) in kept and (5, "response", None, "else") in kept
    assert {r.target_uri for r in got if r.page_id == 2} == {"a%0Ab"} and {r.target_uri for r in got if r.page_id == 3} == {None}
    assert sum(r.record_type == "revisit" for r in got) == 3
    with zipfile.ZipFile(archives.first()["file"].removeprefix("file:")) as z:
        assert z.testzip() is None and DATA in z.namelist()
    empty = write_archives(df.limit(0), shared_folder(spark, "warc-test"))
    assert read_records(read_index(empty)).collect() == []
