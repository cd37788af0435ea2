"""Hard negatives by slot-decomposed selection (operator 12).

For each anchor its ``positives`` nearest rows of the same label are found first.  A negative of a
positive with score s is a row of another label that scores from ``low`` percent of s to s.
The windows of an anchor's positives overlap, so they are not searched one by one:

1. The windows' upper limits cut the scores into slots that share none; slot 0 is the highest, and
   the last one ends at the smallest lower limit.
2. Rows lie in blocks; anchors, with their limits, are sent past all of them.  A block returns the k
   best rows of each slot of an anchor, and what the blocks return is combined to k rows a slot.
   No pair of an anchor and a row leaves a block otherwise.
3. The best rows below an upper limit are those of its slot, then those of the slots below: a
   suffix of the anchor's slots in order, of which the first k are cut, and then the rows below
   the window's lower limit.

Scores are exact: components become whole numbers, floor(scale * x), and their products are summed
in a type that holds the largest possible score (single precision below 2^24, double below 2^53,
whole numbers of any size beyond, where scores over 64 bits are set to the nearest that fits).

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part;
of several rows of one id the smallest (label, vector) counts, so an anchor never finds itself; ties
go to the smaller id; vectors are compared with those of their own length only; an anchor without
positives has no rows, nor has a positive whose window is empty (as with every score below 0);
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.llm.common import map_batches, partitions, quoted
from sensorgrid.staging import stage

#: Components in a block of rows, pairs of an anchor and a row looked at together, rows that are
#: worth a block of their own.
BLOCK_CELLS, PAIRS, LEAST_ROWS = 1 << 22, 1 << 21, 1 << 10
_NONE, LARGEST = -(2**63), 2**63 - 1


def usable_vectors(vectors: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """``(id, label, v)``: one row an id, with whole-number components."""
    rows = vectors.select(
        quoted(id_col).cast("long").alias("id"), quoted(label_col).cast("long").alias("label"), quoted(vector_col).cast("array<double>").alias("v")
    ).where("id is not null and label is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    one = rows.select("id", "label", whole.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    return one.select("id", "r.label", "r.v")


def _top(scores: np.ndarray, wanted: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, row) of the k highest wanted scores of each anchor; earlier rows first."""
    anchors, rows = scores.shape
    if not wanted.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if scores.dtype != object and float(np.abs(scores).max()) * rows < 2.0**62:
        # The score, then the place, in one number.
        key = scores.astype(np.int64) * rows + np.arange(rows - 1, -1, -1)
        key[~wanted] = _NONE
        if rows > k:
            at = np.argpartition(key, rows - k, axis=1)[:, rows - k :]
        else:
            at = np.broadcast_to(np.arange(rows), scores.shape)
        a, c = np.nonzero(np.take_along_axis(key, at, axis=1) > _NONE)
        return a, at[a, c]
    best = [(a, c) for a in range(anchors) for c in sorted(np.flatnonzero(wanted[a]), key=lambda c: (-scores[a, c], c))[:k]]
    return tuple(np.array(best, np.int64).reshape(-1, 2).T)


class _Block:
    """Rows of a block by the length of their vectors, in the order of their ids."""

    def __init__(self, parts: list[pa.RecordBatch], kind: type):
        self.kind, self.by_size = kind, {}
        for size, ids, labels, v, _ in _matrices(parts, kind):
            self.by_size[size] = ids, labels, v

    def scores(self, anchors: list[pa.RecordBatch]) -> Iterator[tuple]:
        """(anchors' ids, labels, limits, rows' ids, labels, scores) in bounded pieces."""
        for size, ids, labels, v, limits in _matrices(anchors, self.kind):
            if size in self.by_size:
                row_ids, row_labels, rows = self.by_size[size]
                step = max(1, PAIRS // len(row_ids))
                for a in range(0, len(ids), step):
                    b = slice(a, a + step)
                    scores = v[b] @ rows.T
                    if self.kind is object:
                        scores = np.clip(scores, -LARGEST, LARGEST)
                    yield ids[b], labels[b], limits[b], row_ids, row_labels, scores


def _matrices(parts: list[pa.RecordBatch], kind: type) -> Iterator[tuple]:
    if not parts:
        return
    table = pa.Table.from_batches(parts).combine_chunks()
    ids, labels = table["id"].to_numpy(), table["label"].to_numpy()
    v = table["v"].combine_chunks()
    offsets = np.asarray(v.offsets).astype(np.int64)
    values = np.asarray(v.values)
    sizes = np.diff(offsets)
    limits = table["limits"].to_pylist()
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        cells = values[offsets[own][:, None] + np.arange(size)]
        if kind is object:
            cells = np.array([[int(x) for x in row] for row in cells], object).reshape(len(own), size)
        else:
            cells = cells.astype(kind)
        yield int(size), ids[own], labels[own], cells, [limits[i] for i in own]


def _past(kind: type, answer):
    """Holds the rows of a block (kind 0) while its anchors (kind 1) come past."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, ready = [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            mark = 2 * batch.column(0).to_numpy() + batch.column(1).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(mark)) + 1, [len(mark)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part, at = batch.slice(a, b - a), int(mark[a]) // 2
                if at != block:
                    held, block, ready = [], at, None
                if mark[a] % 2 == 0:
                    held.append(part)
                    continue
                if ready is None:
                    ready, held = _Block(held, kind), []
                found = list(answer(ready, [part]))
                if found:
                    anchor, slot, score, own = (np.concatenate(c) for c in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor, pa.int64()), pa.array(slot, pa.int32()), pa.array(score.astype(np.int64)), pa.array(own, pa.int64())],
                        names=["anchor_id", "slot", "score", "id"],
                    )

    return run


def _positives(k: int):
    def answer(block: _Block, anchors: list[pa.RecordBatch]) -> Iterator[tuple]:
        for ids, labels, _, row_ids, row_labels, scores in block.scores(anchors):
            wanted = (labels[:, None] == row_labels) & (ids[:, None] != row_ids)
            a, r = _top(scores, wanted, k)
            yield ids[a], np.zeros(len(a), np.int32), scores[a, r], row_ids[r]

    return answer


def _slots(k: int, low: int):
    def answer(block: _Block, anchors: list[pa.RecordBatch]) -> Iterator[tuple]:
        for ids, labels, limits, row_ids, row_labels, scores in block.scores(anchors):
            other = labels[:, None] != row_labels
            for slot in range(max(map(len, limits))):
                # Above the next limit, or from the last lower limit on; no score where there is no slot.
                upto = np.array([x[slot] if slot < len(x) else 0 for x in limits], object)
                over = np.array([x[slot + 1] if slot + 1 < len(x) else (low * x[slot] - 1) // 100 if slot < len(x) else 0 for x in limits], object)
                if scores.dtype != object:
                    upto, over = (x.astype(np.float64) for x in (upto, over))
                wanted = other & (scores <= upto[:, None]) & (scores > over[:, None])
                a, r = _top(scores, wanted, k)
                yield ids[a], np.full(len(a), slot, np.int32), scores[a, r], row_ids[r]

    return answer


_FOUND = "anchor_id long, slot int, score long, id long"


def _search(rows: DataFrame, anchors: DataFrame, blocks: int, kind: type, answer) -> DataFrame:
    """What ``answer`` finds for ``anchors (id, label, v, limits)`` in the blocks of ``rows``."""
    held = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.lit(0).cast("long").alias("kind"), "id", "label", "v", F.lit(None).cast("array<long>").alias("limits"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(1).cast("long").alias("kind"), "id", "label", "v", "limits")
    placed = held.unionAll(sent).repartition(blocks, "block").sortWithinPartitions("block", "kind", "id")
    return map_batches(placed, _past(kind, answer), _FOUND)


def _best(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k highest scores of each group, smaller ids first; each task cuts its own rows first."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 5, low: int = 80, scale: int = 256,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    rows = stage(usable_vectors(vectors, scale, id_col, label_col, vector_col), "hard-negative-rows")
    largest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("size"), F.max(largest).alias("largest")).first()
    size, bound = facts["size"] or 1, (facts.largest or 0.0) ** 2 * (facts["size"] or 1)
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object
    blocks = max(1, -(-facts.n * size // BLOCK_CELLS), min(partitions(spark), facts.n // LEAST_ROWS))

    anchors = rows.where(is_anchor)
    found = _search(rows, anchors.withColumn("limits", F.lit(None).cast("array<long>")), blocks, kind, _positives(positives))
    near = stage(_best(found, positives, "anchor_id"), "hard-negative-positives")
    # A window below 0 is empty, as its lower limit is the larger number.
    limits = near.where("score >= 0").groupBy("anchor_id").agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    aimed = anchors.join(limits, anchors["id"] == limits["anchor_id"])
    found = _search(rows, aimed, blocks, kind, _slots(k, low))
    slots = _best(found, k, "anchor_id", "slot")

    # At most ``positives`` slots of k rows each, from the highest score down.
    order = F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("less"), "id")))
    below = slots.groupBy("anchor_id").agg(order.alias("below")).join(limits, "anchor_id")
    pairs = near.where("score >= 0").select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(below, "anchor_id")
    own = F.array_position("limits", F.col("positive_score")) - 1
    suffix = F.slice(F.filter("below", lambda x: x["slot"] >= F.col("own")), 1, k)
    inside = F.filter("suffix", lambda x: -x["less"].cast("decimal(20)") * 100 >= F.col("positive_score").cast("decimal(20)") * low)
    out = pairs.withColumn("own", own).withColumn("suffix", suffix).select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("rank", "negative")
    )
    return out.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("negative.id").alias("negative_id"),
        "positive_score", (-F.col("negative.less")).alias("negative_score"),
    )
