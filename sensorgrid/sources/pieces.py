"""Nested history files of any size, read in byte ranges.

A file ``{date: {sensor: {file name: {...}}}}`` may be one line and hold years.  Spark's text reader
splits it with ``}`` as the line end, so each task reads a range of bytes as pieces that end at
a brace.  What a piece belongs to depends on all that comes before it, hence two passes:

1. *Survey*: a range is summed up in one row: which brackets it closes that were opened before it, and
   which brackets, with their keys, it leaves open.  The rows of a file, in order, tell what is open
   at the start of each range, and whether the file is one whole object.
2. *Parse*: each range gives its records as text with their date, sensor and file name.  A record
   that a range border cuts (one with an object inside) is put together from its fragments.

A range border may fall on a brace inside a string (a key with a brace).  So a range is surveyed both as
one that begins outside of strings and as one that begins inside; which is right follows from the ranges
before it, as does the first part of a key that is cut.  The wrong one of the two breaks within a few
tokens as a rule, and is followed no further then.

What goes to the driver is a row for each range but a file's first one, and one for each broken file.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.sources.dated import between_dates
from sensorgrid.staging import release, stage

#: Ranges and broken files that the driver may hold; a range is a task, of which it holds more.
MOST = 1_000_000
#: What the value at each depth is called.
LEVELS = ("document", "date", "sensor", "record")
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s"{}\[\]:,]+|"', re.S)
_LITERAL = re.compile(r"-?\d+(\.\d+)?([eE][-+]?\d+)?|true|false|null|NaN|-?Infinity|[+-]?INF")
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
#: The usual piece: one more flat record of the sensor that is open.
_NEXT = re.compile(r'\s*,\s*"([^"\\]*)"\s*:\s*(\{[^{}\[\]"\\]*(?:(?:"[^"\\]*"|\[[^{}\[\]"\\]*\])[^{}\[\]"\\]*)*\})', re.S)

Found = tuple[str, list, str | None, str | None]


class _Head(str):
    """The rest of a string that was opened in an earlier range."""


def _in_record(stack: list) -> bool:
    return len(stack) >= 4 and all(kind == "{" for kind, _ in stack[:4])


class Scanner:
    """Follows the brackets of a file from ``stack``, the open ones as (bracket, key), from the ``key`` whose
    value comes next and from the text of the ``string`` that is open.

    In a survey the text of a string that is open at the start is not known: its rest is ``head``, and
    its key is True where it is one.
    """

    def __init__(self, stack: list[tuple[str, str | bool | None]], at_start: bool, survey: bool, key: str | None = None, string: str = ""):
        self.stack, self.at_start, self.survey = list(stack), at_start, survey
        self.closed = ""
        self.broken = False
        self.key: str | bool | None = key
        self.last: str | None = None
        self.string: list[str] = [string] if string else []
        self.head: str | None = None
        self.head_open, self.head_is_key = survey and bool(string), False
        #: Text of the record that is open; its fragment if it was opened in an earlier range.
        self.fragment = _in_record(stack)
        self.record: list[str] | None = [] if self.fragment else None

    def keys(self) -> list:
        return [key for _, key in self.stack[1:4]]

    def plain(self, depth: int) -> bool:
        return len(self.stack) == depth and all(kind == "{" for kind, _ in self.stack)

    def feed(self, piece: str) -> list[Found]:
        """(kind, keys, text, reason) of what a piece, and the brace after it, completes."""
        text, found, at = piece + "}", [], 0
        if not self.string and self.record is None and self.last is None and self.key is None:
            if self.survey or self.plain(3):
                usual = _NEXT.fullmatch(text)
                if usual:
                    return [] if self.survey else [("record", [*self.keys(), usual[1]], usual[2], None)]
        if self.string:
            end = _STRING_END.match(text)
            if end is None:
                self.string.append(text)
                if self.record is not None:
                    self.record.append(text)
                return found
            token, at = "".join(self.string) + end[0], end.end()
            if self.record is not None:
                self.record.append(end[0])
            self.string = []
            if self.head_open:
                self.head_open, self.head = False, token[1:]
                token = _Head(token)
            self.value(token)
        for m in _TOKEN.finditer(text, at):
            token = m[0]
            if self.record is not None:
                self.record.append(text[at : m.end()])
                at = m.end()
            if token == '"':
                self.string = [text[m.start() :]]
                if self.record is not None:
                    self.record.append(text[m.end() :])
                return found
            self.step(token, found)
            at = m.end()
        return found

    def value(self, token: str) -> None:
        if self.last is not None or token[0] != '"' and not _LITERAL.fullmatch(token):
            self.broken = True
        self.last = token

    def step(self, token: str, found: list[Found]) -> None:
        if token in "{[":
            if not self.survey and self.record is None and all(k == "{" for k, _ in self.stack):
                depth = len(self.stack)
                if depth == 3 and token == "{":
                    self.record = ["{"]
                elif 1 <= depth <= 3 and token == "[":
                    found.append(("part", [*self.keys(), self.key], None, f"{LEVELS[depth]} is not an object"))
            if self.last is not None or self.at_start and not self.stack and (self.closed or token == "["):
                self.broken = True
            self.stack.append((token, self.key))
            self.key = None
        elif token == ":":
            if self.last is None or self.last[0] != '"' or self.key is not None:
                self.broken = True
                return
            try:
                if isinstance(self.last, _Head):
                    self.key = self.head_is_key = True
                else:
                    self.key = json.loads(self.last, strict=False)
            except ValueError:
                self.broken = True
            self.last = None
        elif token in ",}]":
            if self.last is not None:
                self.scalar(found)
            elif self.key is not None:
                self.broken, self.key = True, None
            if token != ",":
                self.close(token, found)
        else:
            self.value(token)

    def scalar(self, found: list[Found]) -> None:
        depth = len(self.stack)
        if self.at_start and not depth:
            self.broken = True
        if not self.survey and 1 <= depth <= 3 and self.record is None and all(k == "{" for k, _ in self.stack):
            found.append(("part", [*self.keys(), self.key], None, f"{LEVELS[depth]} is not an object"))
        self.key = self.last = None

    def close(self, token: str, found: list[Found]) -> None:
        if not self.stack:
            self.closed += token
            return
        kind, key = self.stack.pop()
        if (kind == "{") != (token == "}"):
            self.broken = True
        if self.record is not None and len(self.stack) == 3:
            found.append(("fragment" if self.fragment else "record", [*self.keys(), key], "".join(self.record), None))
            self.record, self.fragment = None, False


def _pieces(spark: SparkSession, path: str, since: date | None, until: date | None) -> DataFrame:
    files = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).option("lineSep", "}").text(path)
    meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_size")]
    return between_dates(files, since, until).select(*meta, F.col("value").cast("binary").alias("value"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], Iterator[bytes]]]:
    """The pieces of each range, in order, as they come."""

    def rows():
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    stream = rows()
    row = next(stream, None)
    while row is not None:
        own = row[:3]

        def pieces():
            nonlocal row
            while row is not None and row[:3] == own:
                yield row[3]
                row = next(stream, None)

        yield own, pieces()


_SURVEY = (
    "path string, block long, size long, inside boolean, bytes long, closed string, opened string, head string, head_is_key boolean,"
    " key string, string string, broken boolean, blank boolean"
)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = [pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range, and one for the case that it begins inside a string."""
    for (path, block, size), pieces in _ranges(batches):
        scanners, many, piece = [Scanner([], block == 0, True)], 0, b""
        if block:
            scanners.append(Scanner([], False, True, string='"'))
        for piece in pieces:
            text = piece.decode(errors="replace")
            for scanner in scanners:
                if not scanner.broken:
                    scanner.feed(text)
            many += len(piece) + 1
        yield _batch(
            [
                (path, block, size, bool(inside), many, s.closed, json.dumps(s.stack), s.head, s.head_is_key, json.dumps(s.key),
                 "".join(s.string)[1 if s.head_open else 0 :], s.broken, not piece.strip())
                for inside, s in enumerate(scanners)
            ],
            _SURVEY,
        )


_OUTLINE = "path string, block long, state string, owner long, verdict string"


def _outline(rows: pd.DataFrame) -> pd.DataFrame:
    """What is open at the start of each range of a file (brackets, key, text of a string), and a verdict if
    it is not plain."""
    stack, key, string, owner, out, verdict = [], None, "", -1, [], None
    of = {(r.block, bool(r.inside)): r for r in rows.itertuples()}
    blocks = sorted({block for block, _ in of})
    total = sum(of[block, False].bytes for block in blocks)
    for block in blocks:
        r = of.get((block, bool(string)))
        if r is None:
            verdict = "broken"
            break
        if block:
            out.append((r.path, block, json.dumps([stack, key, string]), owner, None))
        opened, whole = json.loads(r.opened), None
        if string and pd.isna(r.head):
            # The string goes on through all of the range.
            string += r.string
        elif string:
            try:
                whole = json.loads(string + r.head, strict=False)
            except ValueError:
                # As within a range, only a key has to be a string that can be read.
                verdict = "broken" if r.head_is_key else None
            if r.head_is_key and key is not None:
                verdict = "broken"
            key, string = json.loads(r.key), r.string
        else:
            key, string = json.loads(r.key), r.string
        key = whole if key is True else key
        ends = r.closed
        if block == blocks[-1]:
            # The reader does not tell whether a brace ends the last piece; the sizes do.
            if total > r.size:
                if not r.blank or not ends.endswith("}"):
                    verdict = "broken"
                ends = ends[:-1]
            if string:
                verdict = "broken"
        lowest = len(stack)
        for token in ends:
            if not stack or (stack[-1][0] == "{") != (token == "}"):
                verdict = "broken"
                break
            stack.pop()
            lowest = min(lowest, len(stack))
        if r.broken:
            verdict = "broken"
        if lowest < 4:
            owner = block
        stack += [[kind, whole if name is True else name] for kind, name in opened]
        if string and not stack:
            verdict = "broken"
        if verdict:
            break
    if verdict is None and stack:
        verdict = "broken"
    if verdict:
        out = [(rows.path.iloc[0], 0, None, None, verdict)]
    return pd.DataFrame(out, columns=["path", "block", "state", "owner", "verdict"])


_PARTS = "kind string, path string, owner long, block long, date string, sensor string, filename string, text string, reason string"


def _parse(outline: dict[tuple[str, int], tuple[list, str | None, str, int]], left_out: set[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        for (path, block, _), pieces in _ranges(batches):
            if path in left_out:
                for _ in pieces:
                    pass
                continue
            stack, key, string, owner = outline.get((path, block), ([], None, "", block))
            scanner = Scanner([tuple(x) for x in stack], block == 0, False, key, string)
            for piece in pieces:
                for kind, keys, text, reason in scanner.feed(piece.decode(errors="replace")):
                    names = [*keys, None, None, None][:3]
                    rows.append((kind, path, owner if kind == "fragment" else block, block, *names, text, reason))
                if len(rows) >= 5000:
                    yield _batch(rows, _PARTS)
                    rows.clear()
            if scanner.record is not None:
                # Cut by the end of the range.
                rows.append(("fragment", path, owner if scanner.fragment else block, block, *scanner.keys(), "".join(scanner.record), None))
        if rows:
            yield _batch(rows, _PARTS)

    return run


def _map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package on a local master."""
    context = df.sparkSession.sparkContext
    if context.master.startswith("local["):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        known = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
        if root not in known.split(os.pathsep):
            context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return df.mapInArrow(fn, schema)


def history_parts(spark: SparkSession, path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """``date, sensor, filename, text, reason`` of every record and every part that is none (runs jobs).

    ``reason`` is NULL where ``text`` is a record.  A file that is no whole object, cut off for
    example, gives one row.
    """
    pieces = _pieces(spark, path, since, until)
    surveyed = stage(_map(pieces, _survey, _SURVEY), "history-survey")
    found = surveyed.groupBy("path").applyInPandas(_outline, _OUTLINE).limit(MOST + 1).collect()
    if len(found) > MOST:
        raise ValueError(f"over {MOST} byte ranges and broken files: raise spark.sql.files.maxPartitionBytes or read fewer files")
    release(surveyed)
    outline = {(r.path, r.block): (*json.loads(r.state), r.owner) for r in found if r.verdict is None}
    broken = [r.path for r in found if r.verdict == "broken"]
    rows = _map(pieces, _parse(outline, set(broken)), _PARTS)
    columns = ["date", "sensor", "filename", "text", "reason"]
    out = rows.where("kind <> 'fragment'").select(*columns)
    if any(_in_record(stack) for stack, *_ in outline.values()):
        # Fragments are where records hold objects and a range ends in one: a few for each range.
        order = F.array_sort(F.collect_list(F.struct("block", "text")))
        joined = rows.where("kind = 'fragment'").groupBy("path", "owner").agg(
            *[F.max(c).alias(c) for c in columns[:3]], F.array_join(F.transform(order, lambda x: x["text"]), "").alias("text")
        )
        out = out.unionByName(joined.select(*columns[:4], F.lit(None).cast("string").alias("reason")))
    if broken:
        missing = [F.lit(None).cast("string").alias(c) for c in columns[:4]]
        verdicts = spark.createDataFrame([(p,) for p in broken], "path string")
        out = out.unionByName(verdicts.select(*missing, F.lit("document is not an object").alias("reason")))
    return out
