import base64
import gzip
import hashlib
import io

import pytest

from auditloom.llm import warc as op
from tests.llm.rows import ordered

SCHEMA = "page_id bigint, url string, html string, revisit string, payload string"


def pages(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i % 7}</p>" * (1 + i % 7), "a", "b") for i in range(60)]
    rows += [(100, None, None, "a", None), (101, "u\r\nX-Page-Id: 5", "", None, "b"), (102, "u", "é😀" * 50_000, "a", "b"),
             (103, "u", "é😀" * 50_000, "a", "b"), (None, "n", "<p>1</p><p>1</p>", "a", "b"), (None, "n", "only", "a", "b"),
             (59, "again", "<p>3</p>" * 4, "a", "b"), (104, "u", "line\r\n\r\nWARC/1.1\r\n", "a", "b")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def expected(rows, least=0):
    heads, sizes = {}, {}
    for i, html in rows:
        data = (html or "").encode()
        sizes[data] = sizes.get(data, 0) + 1
        if i is not None:
            heads[data] = max(heads.get(data, i), i)
    out = []
    for i, html in rows:
        data = (html or "").encode()
        head = heads.get(data)
        revisit = len(data) >= least and head is not None and i != head
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", head if revisit else None))
    return ordered(out)


@pytest.mark.parametrize("least, archive_bytes", [(0, 1 << 30), (0, 300), (20, 1 << 30)])
def test_round_trip(spark, least, archive_bytes):
    frame = pages(spark)
    rows = [(r.page_id, r.html) for r in frame.collect()]
    manifest = op.write_archives(frame, revisit_bytes=least, archive_bytes=archive_bytes)
    found = op.read_archives(manifest).collect()
    assert ordered((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected(
        rows, least)
    payloads = ordered((r.page_id, bytes(r.payload)) for r in found if r.record_type == "response")
    assert set(payloads) <= {(i, (h or "").encode()) for i, h in rows}
    assert (manifest.count() > 10) == (archive_bytes == 300)


def member(*args):
    return op._member(op.record(*args))


def test_records_are_gzip_members_of_their_own():
    data = member(1, "u", b"abc", None, False) + member(2, "v", b"abc", 1, True)
    plain = gzip.decompress(data)
    assert plain.count(b"WARC/1.1\r\n") == 2 and plain.endswith(b"\r\n\r\n")
    found = list(op.read_records(io.BytesIO(data)))
    assert [(r[0], r[2], r[4], r[5], r[6]) for r in found] == [(1, 3, "response", None, b"abc"), (2, 3, "revisit", 1, None)]


def test_small_reads_frame_like_large_ones(monkeypatch):
    data = b"".join(member(i, f"u{i}", bytes(range(256)) * i, None, False) for i in range(20))
    whole = list(op.read_records(io.BytesIO(data)))
    monkeypatch.setattr(op, "READ_BYTES", 3)
    assert list(op.read_records(io.BytesIO(data))) == whole and len(whole) == 20


@pytest.mark.parametrize("change", [
    (b"payload", b"pAyload"), (b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"),
    (b"WARC/1.1", b"WARC/9.9"), (b"payload\r\n\r\n", b"payload\r\n")])
def test_damage_is_found(change):
    plain = op.record(1, "u", b"payload", None, False)
    assert change[0] in plain
    with pytest.raises(op.CorruptArchive):
        list(op.read_records(io.BytesIO(op._member(plain.replace(*change)))))


def test_cut_file_is_found():
    with pytest.raises(op.CorruptArchive):
        list(op.read_records(io.BytesIO(member(1, "u", b"payload" * 100, None, False)[:-12])))


def test_empty_table(spark):
    manifest = op.write_archives(pages(spark).limit(0))
    assert op.read_archives(manifest).count() == 0


def test_paths_without_a_scheme_are_those_spark_resolves(spark, tmp_path):
    assert op.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert op.qualified(spark, "file:///x/y") == "file:/x/y"
    pages = spark.createDataFrame([(1, "u", "x")], "page_id bigint, url string, html string")
    manifest = op.write_archives(pages, str(tmp_path / "warc"))
    assert manifest.first().archive.startswith(f"file:{tmp_path}") and len(list((tmp_path / "warc").iterdir())) == 1
    assert op.read_archives(manifest).count() == 1
