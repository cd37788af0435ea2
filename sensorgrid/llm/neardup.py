"""Near-duplicate documents by MinHash bands and odd sketches (operator 2).

A document is the set of its distinct word k-grams.  Two documents are linked when their
sets' Jaccard similarity is at least ``percent`` hundredths; groups are the connected
components of the links.

1. One pass over the texts gives each document the size and a 128-bit digest of its set, and
   ``BANDS`` band keys over MinHash samples.  Documents of equal sets form a class at once, by
   an aggregate; only the smallest doc_id of a class goes on.
2. Documents that share a band key are put into one candidate group, named after the smallest
   doc_id with that key, so every two that share a key meet in a group (a pair at the threshold
   shares no key with a probability below ``MISS``).
3. Each candidate group is cut into blocks of bounded size.  In a block, the MinHash
   samples of every document are folded into a parity bitmap (odd sketch): a sample flips one
   of ``BITS`` bits.  The population count z of two bitmaps' XOR estimates the similarity as
   1 + BITS / (4 SAMPLES) ln(1 - 2 z / BITS); pairs within ``SIGMAS`` standard deviations of
   the threshold are confirmed on their full sets.  Pairs already linked to one another, by any
   path, are skipped, so a block gives one link for each document, never all pairs.
4. A candidate group of several blocks shares ``ANCHORS`` documents among them, which joins most
   of it.  What stays outside its largest part is then compared with the whole group, in blocks:
   one block is held in memory while the other documents stream past it.
5. The connected components of all links are the result.

Nothing is capped: a large group only means more blocks.

Defined cases: null or empty texts and texts of white space have an empty set and are linked
with nothing; fewer than k words make one gram of all words; rows that share a doc_id are one
document; a null doc_id is linked with nothing, has a null component and is kept.  Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sensorgrid.llm.common import free_name, map_batches, quoted
from sensorgrid.llm.components import components
from sensorgrid.llm.words import Words, chunks, distinct, mix, numbers, utf8
from sensorgrid.staging import release, stage

BANDS = 40
SAMPLES = 512
BITS = 2048
#: Highest chance that a pair exactly at the threshold shares no band.
MISS = 2e-7
SIGMAS = 5.5
ANCHORS = 64
#: Documents and bytes of sets in a block.
BLOCK_ROWS = 2000
BLOCK_BYTES = 16 << 20

_XOR, _TIMES, _FOLD = numbers(SAMPLES, 21), numbers(SAMPLES, 22), numbers(SAMPLES, 23)


def band_rows(percent: int) -> int:
    """Samples in a band: as many as keep the chance of a miss at the threshold below MISS."""
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** BANDS <= MISS:
        rows += 1
    return rows


def _samples(grams: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """(count, rows) MinHash samples; rows must not be empty."""
    out = np.empty((count, len(first) - 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(count):
            out[i] = np.minimum.reduceat((grams ^ _XOR[i]) * _TIMES[i], first[:-1])
    return out


def odd_sketches(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(rows, BITS / 64) parity bitmaps of the rows' MinHash samples."""
    rows = len(first) - 1
    out = np.zeros((rows, BITS // 64), np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if not len(full):
        return out
    starts = np.append(first[full], first[-1])
    place = (mix(_samples(grams, starts, SAMPLES) ^ _FOLD[:, None]) % np.uint64(BITS)).astype(np.int64)
    cells = np.bincount((place + np.arange(len(full)) * BITS).ravel(), minlength=len(full) * BITS)
    out[full] = np.packbits((cells & 1).astype(np.uint8).reshape(len(full), BITS), axis=1).view(np.uint64)
    return out


def estimate(z: np.ndarray) -> np.ndarray:
    """Similarity that the population count of the XOR of two odd sketches stands for."""
    return 1 + BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * np.asarray(z, float) / BITS, 1e-9))


def _most_different(percent: int) -> int:
    """Largest population count at which a pair may still reach the threshold."""
    s = percent / 100
    floor = s - SIGMAS * math.sqrt(s * (1 - s) / SAMPLES + 2e-5)
    return int(np.searchsorted(-estimate(np.arange(BITS // 2)), -floor, side="right"))


def _describe(k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(1))
            for a, b in chunks(off):
                words = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                grams, first = distinct(*words.grams(k, whole=True))
                sizes = np.diff(first)
                full = np.flatnonzero(sizes > 0)
                digests = np.zeros((b - a, 2), np.int64)
                keys: list = [None] * (b - a)
                if len(full):
                    sig = _samples(grams, np.append(first[full], first[-1]), BANDS * rows)
                    order = numbers(rows, 24)[None, :, None]
                    with np.errstate(over="ignore"):
                        band = (sig.reshape(BANDS, rows, -1) * order).sum(axis=1, dtype=np.uint64)
                        band = mix(band + numbers(BANDS, 25)[:, None])
                    band = np.ascontiguousarray(band.T).view(np.int64)
                    for at, row in enumerate(full):
                        raw = grams[first[row] : first[row + 1]].tobytes()
                        digests[row] = np.frombuffer(xxhash.xxh3_128_digest(raw), np.int64)
                        keys[row] = band[at]
                none = sizes == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests[:, 0], pa.int64(), mask=none),
                        pa.array(digests[:, 1], pa.int64(), mask=none),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["id", "n", "d1", "d2", "keys"],
                )

    return run


class _Block:
    """Documents held in memory, their sets and odd sketches, and their groups so far."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent, self.far = k, percent, _most_different(percent)
        self.ids: list[int] = []
        self.labels: list[int] = []
        self.sets: list[np.ndarray] = []
        self.sketches: list[np.ndarray] = []

    def add(self, ids: list[int], labels: list[int], texts: pa.Array) -> None:
        for part in sets_of(texts, self.k):
            self.sets += part[0]
            self.sketches.append(part[1])
        self.ids += ids
        self.labels += labels

    def close(self) -> None:
        self.sketch = np.concatenate(self.sketches) if self.sketches else np.zeros((0, BITS // 64), np.uint64)
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.label = np.array(self.labels, np.int64)

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if len(a) > len(b):
            a, b = b, a
        place = np.minimum(np.searchsorted(b, a), len(b) - 1)
        both = int((b[place] == a).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)

    def links_of(self, own: int, grams: np.ndarray, sketch: np.ndarray, label: int, start: int) -> Iterator[tuple[int, int]]:
        """Links of one document to held ones from ``start`` on that are in other groups."""
        size = len(grams)
        if not size:
            return
        held = self.size[start:]
        fits = (100 * np.minimum(held, size) >= self.percent * np.maximum(held, size)) & (self.label[start:] != label)
        others = np.flatnonzero(fits) + start
        if not len(others):
            return
        z = np.bitwise_count(self.sketch[others] ^ sketch).sum(axis=1)
        near = np.flatnonzero(z <= self.far)
        for other in others[near[np.argsort(z[near], kind="stable")]]:
            if self.label[other] != label and self.linked(grams, self.sets[other]):
                yield own, self.ids[other]
                self.label[self.label == self.label[other]] = label

    def stars(self) -> pa.RecordBatch:
        """Every document that the block's links join to others, with the smallest of them."""
        self.close()
        for i in range(len(self.ids)):
            for _ in self.links_of(self.ids[i], self.sets[i], self.sketch[i], self.label[i], i + 1):
                pass
        ids = np.array(self.ids, np.int64)
        _, part = np.unique(self.label, return_inverse=True)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, part, ids)
        root = least[part]
        return _edges(list(zip(ids[root != ids].tolist(), root[root != ids].tolist(), strict=True)))


def sets_of(texts: pa.Array, k: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    data, off = utf8(texts)
    for a, b in chunks(off):
        words = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
        grams, first = distinct(*words.grams(k, whole=True))
        yield [grams[x:y] for x, y in zip(first[:-1], first[1:], strict=True)], odd_sketches(grams, first)


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _runs(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[tuple, int, int]]:
    """Runs of equal values in the first ``columns`` columns."""
    keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)])
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    edges = [0, *cuts.tolist(), len(keys)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield tuple(keys[a].tolist()), a, b


def _within(k: int, percent: int):
    """Rows (comp, block, id, label, text), sorted by the first two: the stars of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            for now, a, b in _runs(batch, 2):
                if now != key:
                    if block:
                        yield block.stars()
                    key, block = now, _Block(k, percent)
                block.add(
                    batch.column(2).slice(a, b - a).to_pylist(),
                    batch.column(3).slice(a, b - a).to_pylist(),
                    batch.column(4).slice(a, b - a),
                )
        if block:
            yield block.stars()

    return run


def _across(k: int, percent: int):
    """Rows (comp, block, salt, moving, id, label, text), sorted by the first four: the links of
    moving documents to the block's held ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, open_ = None, None, False
        for batch in batches:
            for now, a, b in _runs(batch, 4):
                if now[:3] != key:
                    key, block, open_ = now[:3], _Block(k, percent), True
                ids = batch.column(4).slice(a, b - a).to_pylist()
                labels = batch.column(5).slice(a, b - a).to_pylist()
                texts = batch.column(6).slice(a, b - a)
                if not now[3]:
                    block.add(ids, labels, texts)
                    continue
                if open_:
                    block.close()
                    open_ = False
                found, at = [], 0
                for grams, sketches in sets_of(texts, k):
                    for g, s in zip(grams, sketches, strict=True):
                        # Groups met so far in this task are carried by the held labels only.
                        found += block.links_of(ids[at], g, s, labels[at], 0)
                        at += 1
                yield _edges(found)

    return run


def _blocks_of(sizes: DataFrame) -> DataFrame:
    """Number of blocks of each candidate group ``(comp, rows, bytes)``."""
    return sizes.select(
        "comp", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("nb")
    )


def _links(members: DataFrame, texts: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links inside the blocks of ``members (id, n, comp)``; and the members of split groups."""
    nb = _blocks_of(members.groupBy("comp").agg(F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes")))
    placed = members.join(nb, "comp")
    split = placed.where("nb > 1")
    anchor = F.row_number().over(_by_hash("comp"))
    home = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    anchors = (
        split.select("id", "comp", "nb", home.alias("home"), anchor.alias("r")).where(F.col("r") <= ANCHORS)
        .select("id", "comp", "home", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block")).where("block <> home")
    )
    rows = placed.select("id", "comp", home.alias("block")).unionAll(anchors.select("id", "comp", "block"))
    sent = (
        rows.join(texts.hint("merge"), "id").select("comp", F.col("block").cast("long").alias("block"), "id", F.col("id").alias("label"), "text")
        .repartition("comp", "block").sortWithinPartitions("comp", "block")
    )
    return map_batches(sent, _within(k, percent), "a long, b long"), split.select("id", "n", "comp")


def _by_hash(key: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(F.xxhash64("id"), "id")


def _rest(split: DataFrame, roots: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between what lies outside the largest part of a split group, and all of it."""
    named = split.join(roots.withColumnRenamed("node", "id"), "id", "left").select(
        "id", "n", "comp", F.coalesce("root", "id").alias("label")
    )
    groups = named.groupBy("comp", "label").agg(F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes"))
    main = groups.groupBy("comp").agg(
        F.max_by("label", F.struct("rows", "label")).alias("main"), F.sum("rows").alias("all_rows")
    )
    outside = named.join(main, "comp").where("label <> main")
    nb = outside.groupBy("comp", "all_rows").agg(F.count("*").alias("rows"), F.sum(F.col("n") * 8).alias("bytes"))
    nb = nb.select(
        "comp",
        F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("nb"),
        F.ceil(F.col("all_rows") / (2 * BLOCK_ROWS)).cast("int").alias("salts"),
    )
    held = outside.join(nb, "comp").select(
        "comp", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("moving"), "id", "label",
    )
    moving = named.join(nb, "comp").select(
        "comp", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("block"),
        F.pmod(F.xxhash64("id", F.lit(7)), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("moving"), "id", "label",
    )
    sent = (
        held.unionAll(moving).join(texts.hint("merge"), "id")
        .select(*[F.col(c).cast("long").alias(c) for c in ("comp", "block", "salt", "moving", "id", "label")], "text")
        .repartition("comp", "block", "salt").sortWithinPartitions("comp", "block", "salt", "moving")
    )
    return map_batches(sent, _across(k, percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept`` (runs jobs)."""
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    described = stage(
        map_batches(texts, _describe(k, band_rows(percent)), "id long, n long, d1 long, d2 long, keys array<long>"), "neardup-sets"
    )
    classes = described.where("d1 is not null").groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    members = stage(
        described.join(classes, ["d1", "d2"], "left").select(
            "id", "n", "rep", F.when(F.col("id") == F.col("rep"), F.col("keys")).alias("keys")
        ),
        "neardup-members",
    )
    release(described)
    reps = members.where("keys is not null").select(F.col("rep").alias("id"), "n", F.explode("keys").alias("key"))
    shared = reps.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    grouped = reps.join(shared.select("key", F.col("hub").alias("comp")), "key").groupBy("id", "comp").agg(F.max("n").alias("n"))
    candidates = stage(grouped, "neardup-candidates")
    links, split = _links(candidates, texts, k, percent)
    links = stage(links, "neardup-links")
    roots = components(links, "neardup-groups", check_first=False)
    if split.limit(1).count():
        more = stage(_rest(split, roots, texts, k, percent), "neardup-rest")
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more)
        merged = components(joined, "neardup-groups", check_first=False)
        release(roots, more)
        roots = merged
    release(candidates, links)
    component = F.when(F.col("rep").isNull(), F.col("id")).otherwise(F.coalesce("root", "rep"))
    return members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not their group's smallest doc_id."""
    key = free_name(docs, "gone_id")
    gone = near_duplicates(docs, k, percent, id_col, text_col).where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone.hint("merge"), quoted(id_col).cast("long") == F.col(key), "left_anti")
