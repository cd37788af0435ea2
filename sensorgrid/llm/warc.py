"""WARC records in ZIP packages, written and range-read (operator 3).

Writer.  Every page becomes a WARC 1.1 record, compressed on its own.  Of pages with equal
payloads the one with the smallest page_id is a ``response``, the others are ``revisit`` records
that name it.  Each task streams its records into one ZIP64 package: a stored member with the
records, a stored index with a JSON line per record (offset and length of the record in the
member), and a central directory.  Spark's text writer puts the bytes into files: its line
break after each row is a byte of the package, and the last one is the archive's comment.

Reader.  Nothing is extracted.  From the end of each package it reads the end record, the ZIP64
locator and directory and the central directory, then the local header of each stored member;
it reads the index, and only then the byte ranges of the records, dealt to tasks by range.
Ranges are read with ``pyarrow.fs``; a store that only Spark reads is read with ``binaryFile``,
whose bytes are then parsed in the same way.

Defined cases: a null html is an empty payload; equal pages of one page_id are all responses; a
null page_id counts as larger than all others; line breaks in a URL are percent-encoded, and a
null URL is left out; an empty table gives no package.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.llm.common import map_batches
from sensorgrid.staging import new_path

DATE = "1970-01-01T00:00:00Z"
#: Bytes that a task gathers before it hands on a row, and most that one range read fetches.
FLUSH = 1 << 20
READ = 4 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, sha: str) -> bytes:
    """One WARC record, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_name(first)}")
    lines += [
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + out.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a compressed record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(headers["content-length"])
    if len(rest) != size + 4:
        raise ValueError("a record's block has another length than its header says")
    return headers, rest[:size]


class PackageWriter:
    """A ZIP64 package as a stream: the bytes of each step are returned."""

    def __init__(self):
        self.at, self.entries, self.open_ = 0, [], None

    def _out(self, data: bytes) -> bytes:
        self.at += len(data)
        return data

    def begin(self, name: str) -> bytes:
        """Local header of a stored member whose sizes follow it (flag bit 3)."""
        self.open_ = [name.encode(), self.at, 0, 0]
        # Sizes in the ZIP64 field, as they are not known yet.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        head = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 8, 0, 0, 33, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(self.open_[0]), len(extra))
        return self._out(head + self.open_[0] + extra)

    def data(self, data: bytes) -> bytes:
        self.open_[2] = zlib.crc32(data, self.open_[2])
        self.open_[3] += len(data)
        return self._out(data)

    def end(self) -> bytes:
        name, start, crc, size = self.open_
        self.entries.append((name, start, crc, size))
        return self._out(struct.pack("<4sIQQ", b"PK\x07\x08", crc, size, size))

    def close(self) -> bytes:
        """Central directory, ZIP64 end record and locator, and end record with a comment of
        one line break, which is left to the caller."""
        start, parts = self.at, []
        for name, offset, crc, size in self.entries:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, offset)
            parts.append(
                struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 8, 0, 0, 33, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
                + name + extra
            )
        size, n = sum(map(len, parts)), len(parts)
        parts.append(struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, start))
        parts.append(struct.pack("<4sIQI", b"PK\x06\x07", 0, start + size, 1))
        parts.append(struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 1))
        return self._out(b"".join(parts))


def _packages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (page_id, url, html, first, revisit): the package of this task, cut into rows at
    line breaks, which Spark's text writer puts back."""
    writer, kept, index = PackageWriter(), [], []

    def rows(data: bytes, last: bool = False) -> Iterator[pa.RecordBatch]:
        kept.append(data)
        if last or sum(map(len, kept)) >= FLUSH:
            whole = b"".join(kept)
            kept.clear()
            cut = len(whole) if last else whole.rfind(b"\n")
            if cut < 0:
                kept.append(whole)
                return
            if not last:
                kept.append(whole[cut + 1 :])
            yield pa.RecordBatch.from_arrays([pa.array([whole[:cut]], pa.binary())], names=["value"])

    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            chunk = []
            for row in batch.slice(start, 64).to_pylist():
                payload = (row["html"] or "").encode()
                sha = digest(payload)
                member = record(row["page_id"], row["url"], payload, row["first"], row["revisit"], sha)
                if not writer.open_:
                    chunk.append(writer.begin(ARCHIVE))
                at = writer.open_[3]
                chunk.append(writer.data(member))
                kind = "revisit" if row["revisit"] else "response"
                index.append(json.dumps({
                    "urlkey": row["url"] or "", "timestamp": DATE, "page_id": row["page_id"], "record": kind, "digest": f"sha1:{sha}",
                    "filename": ARCHIVE, "offset": at, "length": len(member),
                }))
            yield from rows(b"".join(chunk))
    if writer.open_:
        tail = [writer.end(), writer.begin(INDEX), writer.data("".join(f"{line}\n" for line in sorted(index)).encode()), writer.end()]
        yield from rows(b"".join([*tail, writer.close()]), last=True)


def write_packages(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Writes ``pages (page_id, url, html)`` to packages in the folder ``path``.

    Payloads of fewer than ``min_bytes`` bytes are never revisits."""
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    slim = keyed.where(F.octet_length("html") >= min_bytes).select("page_id", "sha")
    firsts = slim.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = (
        slim.join(firsts, "sha").where("first is not null and (page_id is null or page_id <> first)")
        .select(F.col("page_id").alias("later_id"), F.col("sha").alias("later_sha"), "first").distinct()
    )
    rows = keyed.join(later, F.col("page_id").eqNullSafe(F.col("later_id")) & (F.col("sha") == F.col("later_sha")), "left").select(
        "page_id", "url", "html", "first", F.col("first").isNotNull().alias("revisit")
    )
    map_batches(rows, _packages, "value binary").select(F.col("value").cast("string")).write.text(path)


def _directory(file, size: int) -> list[tuple[str, int, int]]:
    """Name, start of the data and length of every stored member of a package."""

    def read(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)

    tail_at = max(0, size - 65557)  # end record and the longest comment
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end record: not a ZIP package")
    entries, length, start = struct.unpack("<10xHII2x", tail[at : at + 22])
    if 0xFFFF in (entries,) or 0xFFFFFFFF in (length, start):
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack("<8xQ4x", locator)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, start = struct.unpack("<32xQQQ", end)
    central, out, p = read(start, length), [], 0
    for _ in range(entries):
        sign, method, packed, plain, n, m, k, offset = struct.unpack("<4s6xH8xIIHHH8xI", central[p : p + 46])
        if sign != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        name, extra = central[p + 46 : p + 46 + n].decode(), central[p + 46 + n : p + 46 + n + m]
        p += 46 + n + m + k
        while len(extra) >= 4:
            kind, wide = struct.unpack("<HH", extra[:4])
            if kind == 1:
                values = list(struct.unpack(f"<{wide // 8}Q", extra[4 : 4 + wide // 8 * 8]))
                plain = values.pop(0) if plain == 0xFFFFFFFF else plain
                packed = values.pop(0) if packed == 0xFFFFFFFF else packed
                offset = values.pop(0) if offset == 0xFFFFFFFF else offset
            extra = extra[4 + wide :]
        if method == 0:
            head = read(offset, 30)
            if head[:4] != b"PK\x03\x04":
                raise ValueError("damaged local header")
            n, m = struct.unpack("<26xHH", head)
            out.append((name, offset + 30 + n + m, packed))
    return out


def _open(path: str):
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    where, inner = fs.FileSystem.from_uri(path)
    return where.open_input_file(inner)


def index_of(file, size: int) -> Iterator[tuple[int, int]]:
    """Start and length of every record, from the package's indexes."""
    members = {name: (start, length) for name, start, length in _directory(file, size)}
    for name, (start, length) in members.items():
        if name.startswith("indexes/"):
            file.seek(start)
            for line in file.read(length).decode().splitlines():
                entry = json.loads(line)
                yield members[entry["filename"]][0] + entry["offset"], entry["length"]


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, length): a row for each record."""
    for batch in batches:
        for row in batch.to_pylist():
            if row["length"]:
                with _open(row["path"]) as file:
                    found = list(index_of(file, row["length"]))
                starts, lengths = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]] * len(found)), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], names=["path", "start", "length"]
                )


FIELDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _rows(members: list[bytes]) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in range(7)]
    for member in members:
        headers, block = parse_record(member)
        http, _, payload = block.partition(b"\r\n\r\n")
        full = next(int(line[16:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
        kind, sha = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (full != len(payload) or sha != digest(payload)):
            raise ValueError(f"damaged payload of {headers['warc-record-id']}")
        page, refers = (headers.get(k, "")[10:-1] for k in ("warc-record-id", "warc-refers-to"))
        values = (
            int(page) if page else None, headers.get("warc-target-uri"), kind, int(refers) if refers else None, full, sha,
            payload if kind == "response" else None,
        )
        for column, value in zip(columns, values, strict=True):
            column.append(value)
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [f.split(" ")[0] for f in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, start, length) in order: neighbouring records are fetched with one read."""
    path, file = None, None
    for batch in batches:
        rows = batch.to_pylist()
        at = 0
        while at < len(rows):
            end = at + 1
            while (
                end < len(rows) and rows[end]["path"] == rows[at]["path"]
                and rows[end]["start"] == rows[end - 1]["start"] + rows[end - 1]["length"]
                and rows[end]["start"] + rows[end]["length"] - rows[at]["start"] <= READ
            ):
                end += 1
            if rows[at]["path"] != path:
                if file:
                    file.close()
                path, file = rows[at]["path"], _open(rows[at]["path"])
            first = rows[at]["start"]
            file.seek(first)
            data = file.read(rows[end - 1]["start"] + rows[end - 1]["length"] - first)
            for i in range(at, end, 256):
                yield _rows([data[r["start"] - first : r["start"] - first + r["length"]] for r in rows[i : min(i + 256, end)]])
            at = end
    if file:
        file.close()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (length, content): the records of packages that Spark has read."""
    for batch in batches:
        for row in batch.to_pylist():
            if row["length"]:
                file = io.BytesIO(row["content"])
                found = list(index_of(file, row["length"]))
                for i in range(0, len(found), 256):
                    yield _rows([row["content"][s : s + n] for s, n in found[i : i + 256]])


def _in_reach(path: str) -> bool:
    try:
        return path.startswith(("/", "file:")) or bool(fs.FileSystem.from_uri(path))
    except (pa.ArrowException, ValueError, OSError):
        return False


def read_packages(spark: SparkSession, path: str, ranged: bool | None = None) -> DataFrame:
    """The records of all packages in a folder: ``page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload`` (null for revisits)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if ranged if ranged is not None else _in_reach(path):
        places = map_batches(files.select("path", "length"), _locate, "path string, start long, length long")
        # Ranges of 16 MiB of a package are dealt to tasks.
        dealt = places.withColumn("part", F.shiftright("start", 24)).repartition("path", "part").sortWithinPartitions("path", "start")
        return map_batches(dealt.drop("part"), _ranges, FIELDS)
    return map_batches(files.select("length", "content"), _whole, FIELDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages written to packages in the shared folder and read back."""
    path = new_path(pages.sparkSession, "warc")
    write_packages(pages, path, min_bytes)
    return read_packages(pages.sparkSession, path)
