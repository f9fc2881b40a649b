import base64
import hashlib
import io
import struct
import zipfile

import pytest

from edgeloom.llm import warc_zip as W

PAGES = "page_id long, url string, html string, digest string"


def b32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Ranges(io.BytesIO):
    """A file that counts the bytes asked for."""

    asked = 0

    def read_at(self, n, at):
        self.asked += n
        self.seek(at)
        return self.read(n)


def pages(spark):
    data = [
        (5, "http://a/1", "<p>same</p>", "x"), (3, "http://a/2", "<p>same</p>", "x"), (9, None, "", "x"), (8, "u\r\nInjected: y", None, "x"),
        (1, "http://b", "é🙂\r\n\r\nWARC/1.1", "x"), (2, "http://c", "z" * 3_000_000, "x"), (None, "n", "<p>same</p>", "x"), (None, "n", "only null", "x"),
        (7, "r", "twice", "x"), (7, "r", "twice", "x"),
    ]
    return spark.createDataFrame(data, PAGES)


def test_round_trip(spark):
    df = pages(spark)
    got = W.round_trip(spark, df).collect()
    assert len(got) == 10
    expect = sorted(
        (r.page_id or -1, len((r.html or "").encode()), b32((r.html or "").encode())) for r in df.collect()
    )
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest) for r in got) == expect
    kinds = {(r.page_id, r.payload_digest): (r.record_type, r.refers_to) for r in got}
    assert kinds[5, b32(b"<p>same</p>")] == ("revisit", 3) and kinds[3, b32(b"<p>same</p>")] == ("response", None)
    assert kinds[9, b32(b"")] == ("revisit", 8) and kinds[None, b32(b"<p>same</p>")] == ("revisit", 3)
    assert kinds[None, b32(b"only null")] == ("response", None) and kinds[7, b32(b"twice")] == ("response", None)
    assert W.round_trip(spark, df.limit(0)).collect() == []


def test_archives_roll_and_payloads_come_back(spark, tmp_path):
    df = pages(spark).repartition(2)
    made = W.write_archives(df, f"file:{tmp_path}/zips", min_bytes=8, archive_bytes=2000)
    assert made.count() > 2 and sum(r.records for r in made.collect()) == 10
    got = W.read_records(made).collect()
    assert {r.url for r in got} >= {"http://c", None, "u Injected: y"}
    assert {bytes(r.payload) for r in got if r.record_type == "response"} == {(r.html or "").encode() for r in df.collect()}
    assert sum(r.payload_digest == b32(b"") and r.record_type == "response" for r in got) == 2  # too short to be revisited
    for r in made.collect():
        with zipfile.ZipFile(r.archive.removeprefix("file:")) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}


def test_directories_of_other_writers():
    for big in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            with z.open("archive/a.warc.gz", "w", force_zip64=big) as m:
                m.write(b"abc" * 100)
            z.writestr("indexes/i.txt", "0 300\n")
            z.comment = b"with a comment PK\x05\x06 in it"
        f = Ranges(out.getvalue())
        members = W.read_directory(f, len(out.getvalue()))
        assert [(m.name, m.size) for m in members] == [("archive/a.warc.gz", 300), ("indexes/i.txt", 6)]
        assert f.read_at(300, W.data_offset(f, members[0])) == b"abc" * 100


def test_zip64_directory_beyond_four_gigabytes():
    """A sparse archive: only its ends exist, the member's offsets need 64 bits."""
    out = io.BytesIO()
    z = W.ZipWriter(out)
    z.begin("archive/x")
    z.write(b"payload")
    z.end()
    gap = 5 << 30
    z.at += gap
    z.begin("indexes/y")
    z.write(b"1 2\n")
    z.end()
    z.close()
    raw = out.getvalue()
    hole = raw.index(b"indexes/y") - 30

    class Sparse:
        def read_at(self, n, at):
            assert at + n <= hole or at >= hole + gap
            at = at if at < hole else at - gap
            return raw[at : at + n]

    members = W.read_directory(Sparse(), len(raw) + gap) if len(raw) > 70_000 else None
    if members is None:  # the tail read would cross the hole: give it only what exists

        class Tail(Sparse):
            def read_at(self, n, at):
                end = at + n
                got = b""
                if at < hole:
                    got += raw[at : min(end, hole)]
                    got += b"\0" * max(0, min(end, hole + gap) - max(at, hole)) if end > hole else b""
                if end > hole + gap:
                    lo = max(at, hole + gap)
                    got = (b"\0" * (lo - at) if at >= hole else got) + raw[lo - gap : end - gap]
                return got

        members = W.read_directory(Tail(), len(raw) + gap)
        assert W.data_offset(Tail(), members[1]) == members[1].header_offset + 30 + 9 + 20
    assert [(m.name, m.header_offset > 1 << 32) for m in members] == [("archive/x", False), ("indexes/y", True)]


def test_member_without_an_index_is_walked(spark, tmp_path):
    made = W.write_archives(pages(spark).coalesce(1), f"file:{tmp_path}/zips")
    path = made.first().archive.removeprefix("file:")
    with zipfile.ZipFile(path) as z, zipfile.ZipFile(f"{tmp_path}/bare.zip", "w") as bare:
        bare.writestr("archive/data.warc.gz", z.read(W.DATA_MEMBER))
    one = spark.createDataFrame([(f"file:{tmp_path}/bare.zip",)], "archive string")
    assert W.list_records(one).count() == 10
    assert sorted(r.payload_digest for r in W.read_records(one).collect()) == sorted(r.payload_digest for r in W.read_records(made).collect())


def test_damage_is_noticed(tmp_path):
    with pytest.raises(ValueError, match="no end of central directory"):
        W.read_directory(Ranges(b"not a zip"), 9)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", "x" * 1000)
    f = Ranges(out.getvalue())
    with pytest.raises(ValueError, match="compressed"):
        W.data_offset(f, W.read_directory(f, len(out.getvalue()))[0])
    assert struct.unpack("<I", out.getvalue()[:4])[0] == W.LOCAL


def test_records_are_read_by_as_many_tasks_as_there_are_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "RANGE_BLOCK", 4000)
    df = spark.createDataFrame([(i, f"http://x/{i}", "".join(chr(97 + (i * j) % 26) for j in range(900))) for i in range(60)], "page_id long, url string, html string")
    made = W.write_archives(df.coalesce(1), f"file:{tmp_path}/zips", archive_bytes=9000)
    stretches = sum(-(-r.bytes // 4000) for r in made.collect())
    read = W.read_records(made)
    assert read.rdd.getNumPartitions() == stretches > 4 and read.count() == 60


def test_ids_of_any_text_come_back(spark):
    ids = [" a ", "b\r\nWARC-Type: x", "50%", "é:ü", "", "c"]
    df = spark.createDataFrame([(i, "u", "same") for i in ids], "page_id string, url string, html string")
    got = {r.page_id: r.refers_to for r in W.round_trip(spark, df).collect()}
    assert set(got) == set(ids) and set(got.values()) == {None, min(ids)}
