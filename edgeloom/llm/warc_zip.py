"""WARC records in ZIP archives: writing them, and reading them by range without extraction."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm.storage import fresh_path, staged

# Fixed values of the ZIP format (APPNOTE 4.3) and of WARC 1.1.
LOCAL, CENTRAL, END, END64, LOCATOR64, DESCRIPTOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0x08074B50
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
STORED = 0
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATA_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.txt"
RANGE_BLOCK = 32 << 20


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that executors share, and the folder's path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", uri)
    return pafs.FileSystem.from_uri(uri)


class ZipWriter:
    """Stored members written one after another to a stream that cannot seek back. Sizes
    follow each member, and the directory always has its 64-bit form."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.members.append({"name": raw, "offset": self.at, "crc": 0, "size": 0})
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, STORED, 0, 0x21, 0, FULL32, FULL32, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        m = self.members[-1]
        m["crc"], m["size"] = zlib.crc32(data, m["crc"]), m["size"] + len(data)
        self._put(data)

    def end(self) -> None:
        m = self.members[-1]
        self._put(struct.pack("<IIQQ", DESCRIPTOR, m["crc"], m["size"], m["size"]))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, m["size"], m["size"], m["offset"])
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, STORED, 0, 0x21, m["crc"], FULL32, FULL32, len(m["name"]), len(extra), 0, 0, 0, 0, FULL32) + m["name"] + extra)
        size, n, end64 = self.at - start, len(self.members), self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


@dataclass
class Member:
    name: str
    method: int
    size: int
    header_offset: int


def read_directory(f, size: int) -> list[Member]:
    """The members an archive's central directory lists, from reads of its end only."""
    tail_at = max(0, size - (FULL16 + 22 + 20))
    tail = f.read_at(size - tail_at, tail_at)
    at = len(tail)
    while (at := tail.rfind(struct.pack("<I", END), 0, at)) >= 0:
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    if at < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and struct.unpack_from("<I", tail, at - 20)[0] == LOCATOR64 and (n == FULL16 or length == FULL32 or start == FULL32):
        end64 = struct.unpack_from("<Q", tail, at - 12)[0]
        signature, n, length, start = struct.unpack("<I28xQQQ", f.read_at(56, end64))
        if signature != END64:
            raise ValueError("no 64-bit end of central directory where its locator points")
    listing, p, members = f.read_at(length, start), 0, []
    for _ in range(n):
        signature, method, _crc, packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<I6xH4xIIIHHH", listing, p)
        if signature != CENTRAL:
            raise ValueError("no central directory entry where one is due")
        offset = struct.unpack_from("<I", listing, p + 42)[0]
        name = listing[p + 46 : p + 46 + n_name].decode("utf-8", "replace")
        extra, q = listing[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            tag, length64 = struct.unpack_from("<HH", extra, q)
            if tag == 1:  # 64-bit values, of those that did not fit, in this order
                r = q + 4
                if plain == FULL32:
                    plain, r = struct.unpack_from("<Q", extra, r)[0], r + 8
                if packed == FULL32:
                    packed, r = struct.unpack_from("<Q", extra, r)[0], r + 8
                if offset == FULL32:
                    offset = struct.unpack_from("<Q", extra, r)[0]
            q += 4 + length64
        members.append(Member(name, method, packed, offset))
        p += 46 + n_name + n_extra + n_comment
    return members


def data_offset(f, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != STORED:
        raise ValueError(f"{member.name} is compressed; its records cannot be read by range")
    signature, n_name, n_extra = struct.unpack("<I22xHH", f.read_at(30, member.header_offset))
    if signature != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header_offset + 30 + n_name + n_extra


def _line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def _record(row) -> bytes:
    """One gzip member holding the WARC record of a page."""
    digest = base64.b32encode(hashlib.sha1(row.payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    block = http if row.record_type == "revisit" else http + row.payload
    head = ["WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row.id}|{row.url}|{digest}')}>", "WARC-Date: 2000-01-01T00:00:00Z"]
    if row.id is not None:
        head.append(f"Page-ID: {quote(str(row.id))}")
    if row.url is not None:
        head.append(f"WARC-Target-URI: {_line(row.url)}")
    if row.record_type == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"Refers-To-Page-ID: {quote(str(row.first_id))}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(packed: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one gzip member."""
    raw = zlib.decompress(packed, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(warc["content-length"])]
    http_head, _, payload = block.partition(b"\r\n\r\n")
    http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http_head.decode("latin-1").split("\r\n")[1:])}
    return warc, http, payload


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, archive_bytes: int = 256 << 20) -> DataFrame:
    """Writes a record per row of ``pages`` to ZIP archives under ``folder`` and returns
    their list (archive, records, bytes). Of records with equal payloads of at least ``min_bytes`` bytes, the
    one with the smallest id is a response and others revisit it. Null payloads count as
    empty; a null id revisits a known one, and is a response where all are null.

    A task writes archives of its own names, streaming, so neither a retry nor a task that
    runs twice can spoil another's; the list names those of tasks that succeeded.
    """
    payload = F.encode(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"equal": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("equal").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = staged(first.where("n > 1 and first is not null").select("equal", "first"), "payloads")
    rows = rows.join(first, "equal", "left").withColumn(
        "record_type", F.when(F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first")), "response").otherwise("revisit")
    ).drop("equal")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_folder(folder)
        store.create_dir(root, recursive=True)
        out = zipped = None
        index, made = [], []

        def finish() -> None:
            zipped.end()
            zipped.begin(INDEX_MEMBER)
            zipped.write("".join(f"{o} {n}\n" for o, n in index).encode())
            zipped.end()
            zipped.close()
            out.close()
            made[-1] |= {"records": len(index), "bytes": zipped.at}

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name = f"pages-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}-{len(made):03d}.zip"
                    made.append({"archive": f"{folder}/{name}"})
                    out = store.open_output_stream(f"{root}/{name}")
                    zipped, index = ZipWriter(out), []
                    zipped.begin(DATA_MEMBER)
                packed = _record(row)
                index.append((zipped.members[-1]["size"], len(packed)))
                zipped.write(packed)
                if zipped.at >= archive_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pd.DataFrame(made, columns=["archive", "records", "bytes"])

    rows = rows.select(F.col("id").cast("string"), "url", "payload", "payload_bytes", "record_type", F.col("first").cast("string").alias("first_id"))
    return staged(rows.mapInPandas(write, "archive string, records long, bytes long"), "archives")


def _scan(f, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Offsets and lengths of the gzip members of a stored member that has no index."""
    at, unpack, began = 0, None, 0
    while at < size:
        chunk = f.read_at(min(1 << 20, size - at), start + at)
        while chunk:
            if unpack is None:
                unpack, began = zlib.decompressobj(31), at
            unpack.decompress(chunk)
            rest = unpack.unused_data
            at += len(chunk) - len(rest)
            chunk = rest
            if unpack.eof:
                yield began, at - began
                unpack = None


def list_records(archives: DataFrame) -> DataFrame:
    """(archive, offset, length) of every record: offsets count from the archive's start.
    Reads each archive's directory and index members, or walks members without an index."""

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["archive"]:
                folder, _, name = archive.rpartition("/")
                store, root = open_folder(folder)
                with store.open_input_file(f"{root}/{name}") as f:
                    members = read_directory(f, f.size())
                    stored = [m for m in members if m.name.startswith("archive/")]
                    lists = [m for m in members if m.name.startswith("indexes/")]
                    for m in stored:
                        start = data_offset(f, m)
                        if len(stored) == len(lists) == 1:
                            lines = f.read_at(lists[0].size, data_offset(f, lists[0])).decode().splitlines()
                            found = [tuple(map(int, x.split())) for x in lines]
                        else:
                            found = list(_scan(f, start, m.size))
                        yield pd.DataFrame({"archive": archive, "offset": [start + o for o, _ in found], "length": [n for _, n in found]})

    names, most = archives.select("archive"), int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(max(1, min(most, archives.count())), "archive").mapInPandas(located, "archive string, offset long, length long")


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the listed archives: page_id (text), url, record_type, payload_bytes,
    payload_digest, refers_to (text) and, if asked for, ``payload``. Tasks take stretches of
    an archive, so a large one is read by many, each record by its own range. The digest and
    length of a response are those of the bytes read (a digest that differs from the record's raises);
    a revisit has no bytes and gives what its headers say of the full payload."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, f = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(batch["archive"], batch["offset"], batch["length"]):
                if archive != name:
                    if f is not None:
                        f.close()
                    folder, _, last = archive.rpartition("/")
                    store, root = open_folder(folder)
                    name, f = archive, store.open_input_file(f"{root}/{last}")
                warc, http, payload = parse_record(f.read_at(length, offset))
                kind, digest = warc["warc-type"], warc["warc-payload-digest"].removeprefix("sha1:")
                if kind == "response":
                    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if own != digest:
                        raise ValueError(f"{archive}, offset {offset}: payload does not match its digest")
                size = len(payload) if kind == "response" else int(http["content-length"])
                own_id, first_id = (None if x is None else unquote(x) for x in (warc.get("page-id"), warc.get("refers-to-page-id")))
                row = (own_id, warc.get("warc-target-uri"), kind, size, digest, first_id)
                rows.append((*row, payload if kind == "response" else None) if with_payload else row)
            yield pd.DataFrame(rows, columns=columns)
        if f is not None:
            f.close()

    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    schema = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string" + ", payload binary" * with_payload
    block = F.floor(F.col("offset") / RANGE_BLOCK)
    # The rows that say where records lie are small: their size must not decide how many tasks read the records.
    size = F.col("bytes") if "bytes" in archives.columns else F.lit(None).cast("long")
    stretches = archives.agg(F.sum(F.ceil(F.coalesce(size, F.lit(RANGE_BLOCK)) / RANGE_BLOCK))).first()[0]
    places = list_records(archives).repartition(max(1, int(stretches or 0)), "archive", block).sortWithinPartitions("archive", "offset")
    return places.mapInPandas(read, schema)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``pages`` to archives in the shared folder, reads them back and returns a row
    per page: id, payload_bytes, payload_digest (base32 SHA-1), record_type, refers_to.
    Empty tables give no rows; repeated rows give a record each (both responses, where both
    have the smallest id); other columns are not read."""
    folder = fresh_path(spark, "warc")
    kind = dict(pages.dtypes)[id_col]
    records = read_records(write_archives(pages, folder, id_col, url_col, payload_col), with_payload=False)
    return records.select(
        F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
