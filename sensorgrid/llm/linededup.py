"""Repeated lines, found through a sharded minimal perfect hash (operator 7).

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at both ends and with A-Z
in lower case.  Keys of at least ``min_chars`` code points that occur in two or more documents
stay only in the smallest doc_id that holds them; there all their lines stay.

1. Every document gives the 128-bit hashes of its distinct keys; one aggregate turns them into
   a row per distinct line: how many documents hold it, and the smallest of them.
2. Distinct lines are dealt to shards by hash.  Each shard becomes a minimal perfect hash
   (levels of collision-free bits, ranked) and three arrays it indexes: 32-bit fingerprints,
   counts and first holders.  A shard has about ``SHARD_LINES`` lines, however many there are.
3. The documents' hashes are sent to the shards.  A shard's arrays arrive first, are held, and
   the probes stream past them; lines are never joined.  A shard that holds frequent lines gets
   more probes than others: its arrays are copied, and its probes are dealt to the copies by
   document.  Copies are counted so that none gets over ``SHARE`` times the mean of a shard (or
   1 / ``HOT`` of all probes, if that is more); what is broadcast is the number of copies of the
   shards that have several, fewer than ``HOT`` rows whatever the input.
4. The lines to drop go back to their documents by doc_id.

Every probe is a member of the hash's key set, so an answer is exact; the fingerprint guards
against damaged arrays.

Defined cases: a null or empty text is one empty line; a null doc_id takes no part and loses
nothing; rows that share a doc_id are one document; a document may lose all lines and is then
empty.  Other columns are kept as they are; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from sensorgrid.llm.common import free_name, map_batches, partitions, quoted
from sensorgrid.llm.words import mix
from sensorgrid.staging import release, stage

SPACE = " \t\n\x0b\x0c\r"
SHARD_LINES = 1 << 15
#: Probes of a copy of a shard: at most SHARE times the mean, or 1 / HOT of all.
SHARE, HOT = 4, 1000
#: Bits per key on each level of the hash.
SPREAD = 2


def line_key(line: str, min_chars: int) -> bytes | None:
    """Hash of the line's key; None for a key that is too short."""
    line = line.strip(SPACE)
    return xxhash.xxh3_128_digest(line.encode().lower()) if len(line) >= min_chars else None


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys, given as two columns of 64 bits."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.rank = np.cumsum(self.bits) - self.bits

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            salted = keys[:, 0] ^ mix(keys[:, 1] + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15))
        return (mix(salted) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys):
            place = cls._place(keys, len(levels), SPREAD * len(keys) + 1)
            alone = np.bincount(place, minlength=SPREAD * len(keys) + 1) == 1
            levels.append(alone)
            keys = keys[~alone[place]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key; -1 where a key is on no level, so not in the set."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for number, level in enumerate(self.levels):
            place = self._place(keys[left], number, len(level))
            hit = level[place]
            out[left[hit]] = self.rank[base + place[hit]]
            left, base = left[~hit], base + len(level)
            if not len(left):
                break
        return out


def pack_shard(keys: np.ndarray, counts: np.ndarray, firsts: np.ndarray) -> bytes:
    """A shard's hash and arrays as one value: sizes, level bits, fingerprints, counts, firsts."""
    perfect = PerfectHash.build(keys)
    at = perfect.index(keys)
    prints, number, first = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    prints[at], number[at], first[at] = (keys[:, 1] >> np.uint64(32)).astype(np.uint32), counts, firsts
    head = np.array([len(keys), len(perfect.levels), *map(len, perfect.levels)], np.int64)
    return b"".join(x.tobytes() for x in (head, np.packbits(perfect.bits), first, number, prints))


class Shard:
    """A packed shard, ready for probes."""

    def __init__(self, packed: bytes):
        n, depth = np.frombuffer(packed, np.int64, 2)
        sizes = np.frombuffer(packed, np.int64, depth, 16)
        at, total = 16 + 8 * int(depth), int(sizes.sum())
        bits = np.unpackbits(np.frombuffer(packed, np.uint8, -(-total // 8), at), count=total).astype(bool)
        at += -(-total // 8)
        self.perfect = PerfectHash(np.split(bits, np.cumsum(sizes)[:-1]))
        self.first = np.frombuffer(packed, np.int64, n, at)
        self.count = np.frombuffer(packed, np.int64, n, at + 8 * int(n))
        self.prints = np.frombuffer(packed, np.uint32, n, at + 16 * int(n))

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold each line, and the first of them; 0 for lines not in the shard."""
        at = self.perfect.index(keys)
        known = (at >= 0) & (self.prints[at] == (keys[:, 1] >> np.uint64(32)).astype(np.uint32))
        return np.where(known, self.count[at], 0), np.where(known, self.first[at], 0)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _keys_of(batch: pa.RecordBatch, a: int, b: int, h1: int, h2: int) -> np.ndarray:
    return np.column_stack([_numbers(batch.column(c).slice(a, b - a)) for c in (h1, h2)]).view(np.uint64)


def _lines(min_chars: int):
    """Rows (id, text): the distinct keys of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids, found = [], []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    keys = {line_key(line, min_chars) for line in (text or "").split("\n")}
                    keys.discard(None)
                    found += keys
                    ids += [i] * len(keys)
                flat = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, 0])), pa.array(np.ascontiguousarray(flat[:, 1])), pa.array(ids, pa.int64())],
                    names=["h1", "h2", "id"],
                )

    return run


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, h1, h2, count, first, n) sorted by shard: a row of arrays for each shard, with
    the number of its probes."""

    def packed(shard, parts):
        keys = np.concatenate([p[0] for p in parts])
        blob = pack_shard(keys, *(np.concatenate([p[i] for p in parts]) for i in (1, 2)))
        probes = sum(int(p[3].sum()) for p in parts)
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([probes], pa.int64()), pa.array([blob], pa.binary())],
            names=["shard", "probes", "arrays"],
        )

    shard, parts = None, []
    for batch in batches:
        for now, a, b in _shards(batch):
            if now != shard and parts:
                yield packed(shard, parts)
                parts = []
            shard = now
            parts.append((_keys_of(batch, a, b, 1, 2), *(_numbers(batch.column(c).slice(a, b - a)) for c in (3, 4, 5))))
    if parts:
        yield packed(shard, parts)


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int]]:
    shard = _numbers(batch.column(0))
    cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield int(shard[a]), a, b


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, arrays, h1, h2, id) sorted by place, arrays first: the lines to drop."""
    held: Shard | None = None
    for batch in batches:
        for _, a, b in _shards(batch):
            if batch.column(1)[a].is_valid:
                held, a = Shard(batch.column(1)[a].as_py()), a + 1
            if a == b:
                continue
            keys = _keys_of(batch, a, b, 2, 3)
            ids = _numbers(batch.column(4).slice(a, b - a))
            count, first = held.probe(keys)
            out = (count > 1) & (first != ids)
            lost = np.ascontiguousarray(keys[out]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[out]), pa.array(np.ascontiguousarray(lost[:, 0])), pa.array(np.ascontiguousarray(lost[:, 1]))],
                names=["id", "h1", "h2"],
            )


def _cut(text_at: int, lost_at: int, min_chars: int):
    """Drops the listed lines; the last column holds the hashes of a row's lines to drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = pc.fill_null(part.column(text_at), "")
                lines = pc.add(pc.count_substring(texts, "\n"), 1).to_numpy().astype(np.int64)
                dropped = np.zeros(part.num_rows, np.int64)
                changed = np.flatnonzero(part.column(lost_at).is_valid().to_numpy(zero_copy_only=False))
                if len(changed):
                    out = texts.to_pylist()
                    for row in changed:
                        pairs = part.column(lost_at)[row].values.flatten()
                        flat = np.column_stack([p.to_numpy() for p in pairs])
                        lost = {r.tobytes() for r in np.ascontiguousarray(flat)}
                        split = out[row].split("\n")
                        kept = [line for line in split if line_key(line, min_chars) not in lost]
                        dropped[row] = len(split) - len(kept)
                        out[row] = "\n".join(kept)
                    texts = pa.array(out, part.column(text_at).type)
                columns = [c for i, c in enumerate(part.columns) if i != lost_at]
                names = [n for i, n in enumerate(part.schema.names) if i != lost_at]
                columns[text_at] = texts
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(lines), pa.array(dropped)], names=[*names, "n_lines", "n_dropped"]
                )

    return run


def line_index(lines: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Shards ``(shard, probes, arrays)`` over the distinct lines of ``(h1, h2, id)``, the shards
    of several ``copies``, and the number of shards."""
    spark = lines.sparkSession
    found = stage(
        lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
        .select("h1", "h2", F.when(F.col("first") == F.col("last"), 1).otherwise(F.col("n")).alias("count"), "first", "n"),
        "lines-distinct",
    )
    total, distinct_lines = found.agg(F.sum("n"), F.count("*")).first()
    shards = max(8 * partitions(spark), -(-distinct_lines // SHARD_LINES))
    dealt = found.select(F.pmod("h1", F.lit(shards)).alias("shard"), "h1", "h2", "count", "first", "n")
    index = stage(
        map_batches(dealt.repartition("shard").sortWithinPartitions("shard"), _build, "shard long, probes long, arrays binary"),
        "lines-index",
    )
    release(found)
    most = max(SHARE * (total or 0) / shards, (total or 0) / HOT, 1.0)
    split = index.where(F.col("probes") > most).select("shard", F.ceil(F.col("probes") / most).cast("long").alias("copies"))
    return index, split, shards


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without repeated lines, and ``n_lines, n_dropped`` of each row (runs jobs)."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")])
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text")).where("id is not null")
    lines = stage(map_batches(texts, _lines(min_chars), "h1 long, h2 long, id long"), "lines")
    index, split, shards = line_index(lines)
    # Fewer than HOT rows: each has over 1 / HOT of all probes.
    split = F.broadcast(split)
    copies = F.coalesce("copies", F.lit(1))
    probes = lines.withColumn("shard", F.pmod("h1", F.lit(shards))).join(split, "shard", "left").select(
        (F.col("shard") + shards * F.pmod(F.xxhash64("id"), copies)).alias("place"),
        F.lit(None).cast("binary").alias("arrays"), "h1", "h2", "id",
    )
    arrays = index.join(split, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).select(
        (F.col("shard") + shards * F.col("copy")).alias("place"), "arrays",
        *[F.lit(None).cast("long").alias(c) for c in ("h1", "h2", "id")],
    )
    sent = arrays.unionAll(probes).repartition("place").sortWithinPartitions("place", F.col("arrays").isNull())
    lost = map_batches(sent, _probe, "id long, h1 long, h2 long")
    key, gone = free_name(docs, "lost_id"), free_name(docs, "lost_lines")
    lost = stage(lost.groupBy(F.col("id").alias(key)).agg(F.collect_list(F.struct("h1", "h2")).alias(gone)), "lines-lost")
    release(lines, index)
    joined = docs.join(lost, quoted(id_col).cast("long") == F.col(key), "left").drop(key)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = docs.columns
    return map_batches(joined, _cut(names.index(text_col), len(names), min_chars), schema)
