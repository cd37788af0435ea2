import base64
import glob
import hashlib
import os
import zipfile

import pytest

from sensorgrid.llm.warc import PackageWriter, _directory, read_packages, round_trip, write_packages


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (3, "http://a/\r\nb", "a\n\n<b>é\r\n\r\n"), (1, None, "a\n\n<b>é\r\n\r\n"), (2, "u", None), (9, "u", ""), (None, "z", ""),
    (1, "again", "a\n\n<b>é\r\n\r\n"), (4, "long", "word\n" * 700_000), (5, "binary-like", "\x00\x01\n\x7f" * 50),
]
WANT = [
    (3, "revisit", 1), (1, "response", None), (2, "response", None), (9, "revisit", 2), (None, "revisit", 2),
    (1, "response", None), (4, "response", None), (5, "response", None),
]


@pytest.mark.parametrize("ranged", [True, False])
def test_round_trip(spark, tmp_path, ranged):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, first string")
    write_packages(pages, f"{tmp_path}/w")
    got = read_packages(spark, f"{tmp_path}/w", ranged).collect()
    want = [
        (i, kind, refers, len((h or "").encode()), sha(h), (h or "").encode() if kind == "response" else None)
        for (i, _, h), (_, kind, refers) in zip(ROWS, WANT, strict=True)
    ]
    found = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload and bytes(r.payload) if r.payload != b"" else b"") for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    packages = [f for f in glob.glob(f"{tmp_path}/w/part-*") if os.path.getsize(f)]
    for path in packages:  # another program accepts the packages
        with zipfile.ZipFile(path) as package:
            assert package.testzip() is None
            assert package.namelist() == ["archive/data.warc.gz", "indexes/index.cdxj"]
            assert {i.compress_type for i in package.infolist()} == {zipfile.ZIP_STORED}


def test_smallest_payload_for_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")], "page_id long, url string, html string")
    kinds = {r.page_id: r.record_type for r in round_trip(pages, min_bytes=5).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_directories_of_another_writer(tmp_path):
    """Packages by zipfile: with a comment, deflated members (skipped), plain and ZIP64 headers."""
    path = f"{tmp_path}/z.zip"
    with zipfile.ZipFile(path, "w") as package:
        package.writestr("a", b"12345")
        package.writestr(zipfile.ZipInfo("b"), b"x" * 99, zipfile.ZIP_DEFLATED)
        with package.open("c", "w", force_zip64=True) as member:
            member.write(b"data of c")
        package.comment = b"a comment"
    with open(path, "rb") as file:
        found = _directory(file, os.path.getsize(path))
        assert [n for n, _, _ in found] == ["a", "c"]
        for (_, start, length), data in zip(found, (b"12345", b"data of c"), strict=True):
            file.seek(start)
            assert file.read(length) == data
    with open(path, "wb") as file:
        file.write(b"no package")
    with open(path, "rb") as file, pytest.raises(ValueError, match="not a ZIP"):
        _directory(file, 10)


class Far:
    """A file of which only the end exists."""

    def __init__(self, start: int, data: bytes):
        self.start, self.data, self.at = start, data, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        before = max(0, self.start - self.at)
        return bytes(before) + self.data[max(0, self.at - self.start) :][: n - before]


def test_sizes_beyond_32_bits():
    writer = PackageWriter()
    writer.begin("big")
    writer.at += 5 << 32
    writer.open_[3] = 5 << 32
    writer.end()
    start = writer.at
    data = writer.begin("tail") + writer.data(b"abc") + writer.end()
    writer.entries = writer.entries[1:]  # the local header of the first is out of reach here
    data += writer.close() + b"\n"
    found = _directory(Far(start, data), start + len(data))
    assert [(n, at - start, size) for n, at, size in found] == [("tail", len(PackageWriter().begin("tail")), 3)]
