"""Quality classifier by attention-based multiple-instance learning (operator 4).

A document is a bag of passages of ``PASSAGE_WORDS`` words; all of them count.  A passage is
described by its bytes alone: square roots of the shares of each byte, of hashed byte triples,
and a few ratios.  A small network (Ilse et al., 2018) encodes each passage, gives it a gated
attention weight, softmax(w . (tanh(V h) * sigmoid(U h))), and scores the weighted sum of the
encodings.  Only document labels are needed.

Scoring runs in the tasks that read the texts; the model, some 100 kB, travels with the task.
Fitting takes a bounded sample: of the labelled documents whose ids hash lowest, at most
``max_documents`` with at most ``max_passages`` passages in all.  A document is in the sample
with all its passages or not at all; one that no longer fits is passed over.  Everything else
covers all rows.

Defined cases: a null or empty text is a bag of one passage of zeros and gets a score like any
other; with no usable labels every score is 0.5; documents with two different labels count
under both; equal rows of a doc_id count once, rows of a doc_id with different texts are bags of
their own, all within the bounds; a null doc_id is scored and is never held out.  Columns named
like the results are replaced, others kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sensorgrid.llm.common import map_batches, quoted
from sensorgrid.llm.words import SPACES, Words, chunks, utf8
from sensorgrid.staging import release, stage

PASSAGE_WORDS = 100
TRIPLES = 256
#: Byte shares, triple shares, and the ratios of ``_ratios``.
WIDTH = 256 + TRIPLES + 6
#: Bounds of the sample a model is fitted on, if the caller names no others.
TRAIN_DOCUMENTS, TRAIN_PASSAGES = 3000, 100_000
HIDDEN, ATTENTION = 24, 16


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the first passage of each row (at least one a row)."""
    rows, n = len(offsets) - 1, len(data)
    found = Words(data, offsets)
    starts, first = found.starts, found.first
    words = found.counts()
    counts = np.maximum(-(-words // PASSAGE_WORDS), 1)
    begins = np.concatenate([[0], np.cumsum(counts)])
    total = int(begins[-1])
    out = np.zeros((total, WIDTH), np.float32)
    if not n:
        return out, begins
    # The passage of each byte: rows without words put all their bytes in their only passage.
    row_of = np.repeat(np.arange(rows), counts)
    at = np.arange(total) - begins[row_of]
    opens = np.where(at == 0, offsets[row_of], n)
    later = at > 0
    opens[later] = starts[first[row_of[later]] + at[later] * PASSAGE_WORDS]
    lengths = np.diff(np.append(opens, n))
    of = np.repeat(np.arange(total), lengths)
    size = np.maximum(lengths, 1)[:, None]
    out[:, :256] = np.sqrt(np.bincount(of * 256 + data, minlength=total * 256).reshape(total, 256) / size)
    if n > 2:
        wide = data.astype(np.uint32)
        triple = (wide[:-2] * 0x9E3779B1 + wide[1:-1] * 0x85EBCA77 + wide[2:] * 0xC2B2AE3D).astype(np.uint32)
        triple = (triple ^ (triple >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(24)
        whole = of[:-2] == of[2:]
        cells = np.bincount((of[:-2] * TRIPLES + triple)[whole], minlength=total * TRIPLES)
        out[:, 256 : 256 + TRIPLES] = np.sqrt(cells.reshape(total, TRIPLES) / size)
    out[:, 256 + TRIPLES :] = _ratios(data, found, of, size[:, 0], total)
    return out, begins


def _ratios(data: np.ndarray, found: Words, of: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
    """Capitals, bytes that are neither letters, digits nor spaces, word length, words to bytes,
    words like the one before, different words."""
    starts, ends = found.starts, found.ends
    capital = np.bincount(of[(data >= 65) & (data <= 90)], minlength=total) / size
    low = data | 32
    plain = ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128) | SPACES[data]
    odd = np.bincount(of[~plain], minlength=total) / size
    owner = of[starts]
    count = np.bincount(owner, minlength=total)
    words = np.maximum(count, 1)
    length = np.bincount(owner, weights=ends - starts, minlength=total) / words
    again = np.zeros(len(owner), bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
    repeats = np.bincount(owner[again], minlength=total) / words
    order = np.lexsort((found.hashes, owner))
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (found.hashes[order[1:]] != found.hashes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    different = np.bincount(owner[order[fresh]], minlength=total) / words
    return np.column_stack([capital, odd, np.log1p(length), count / size, 3 * repeats, 3 * different])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Weights of the network; ``loss_and_slopes`` is used in fitting only."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, width: int = WIDTH, seed: int = 7) -> AttentionModel:
        rng = np.random.default_rng(seed)
        shape = {"e": (width, HIDDEN), "f": (HIDDEN,), "v": (HIDDEN, ATTENTION), "u": (HIDDEN, ATTENTION),
                 "w": (ATTENTION,), "c": (HIDDEN,), "b": (1,)}
        return cls({
            k: (np.zeros(s) if k in ("f", "b") else rng.normal(0, s[0] ** -0.5, s)).astype(np.float32)
            for k, s in shape.items()
        })

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes, starts = self.weights, np.diff(first), first[:-1]
        h = np.tanh(x @ p["e"] + p["f"])
        tv, su = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        s = (tv * su) @ p["w"]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), sizes))
        a = s / np.repeat(np.add.reduceat(s, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "tv": tv, "su": su, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["b"])}

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(x, first)["y"].astype(np.float64)

    def slopes(self, x: np.ndarray, first: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss over the bags."""
        p, sizes, starts = self.weights, np.diff(first), first[:-1]
        m = self.forward(x, first)
        dy = (m["y"] - target).astype(np.float32) / len(target)
        dz = np.repeat(dy[:, None] * p["c"], sizes, axis=0)
        da = (dz * m["h"]).sum(axis=1)
        ds = m["a"] * (da - np.repeat(np.add.reduceat(m["a"] * da, starts), sizes))
        gate = ds[:, None] * p["w"]
        dv = gate * m["su"] * (1 - m["tv"] ** 2)
        du = gate * m["tv"] * m["su"] * (1 - m["su"])
        dh = m["a"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T
        dx = dh * (1 - m["h"] ** 2)
        return {"e": x.T @ dx, "f": dx.sum(axis=0), "v": m["h"].T @ dv, "u": m["h"].T @ du,
                "w": (m["tv"] * m["su"]).T @ ds, "c": m["z"].T @ dy, "b": dy.sum(keepdims=True)}

    def train(self, x: np.ndarray, first: np.ndarray, target: np.ndarray, steps: int = 600, batch: int = 128,
              rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
        """Adam over random batches of bags."""
        rng, mean, square = np.random.default_rng(seed), {}, {}
        sizes = np.diff(first)
        for step in range(1, steps + 1):
            bags = rng.choice(len(target), min(batch, len(target)), replace=False)
            own = np.concatenate([np.arange(first[i], first[i + 1]) for i in bags])
            slopes = self.slopes(x[own], np.concatenate([[0], np.cumsum(sizes[bags])]), target[bags])
            pace = rate * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in slopes.items():
                g = g + decay * self.weights[k]
                mean[k] = 0.9 * mean.get(k, 0) + 0.1 * g
                square[k] = 0.99 * square.get(k, 0) + 0.01 * g * g
                change = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - pace * change).astype(np.float32)
        return self


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from fitting: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, quality, text): the features of all passages of each text."""
    for batch in batches:
        data, off = utf8(batch.column(2))
        for a, b in chunks(off):
            x, first = passages(data[off[a] : off[b]], off[a : b + 1] - off[a])
            bags = [x[i:j].astype(np.float16).tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(a, b - a) for c in batch.columns[:2]), pa.array(np.diff(first), pa.int64()), pa.array(bags, pa.binary())],
                names=["id", "quality", "n", "bag"],
            )


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_documents: int = TRAIN_DOCUMENTS, max_passages: int = TRAIN_PASSAGES,
) -> AttentionModel:
    """A model of ``labels (doc_id, quality)``, from rows that are not held out (runs jobs).

    The driver gets at most ``max_passages`` passages of about 1 kB each."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = (
        usable.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("quality")).distinct()
        .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(max_documents)
    )
    # At most max_documents ids and labels.
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "quality", "text")
    bags = stage(
        map_batches(rows, _bags, "id long, quality int, n long, bag binary").withColumn("mark", F.xxhash64("bag")), "quality-bags"
    )
    sizes = bags.select("id", "quality", "mark", "n").distinct().orderBy(F.xxhash64("id"), "id", "quality", "mark").limit(max_documents)
    taken, room = [], max_passages
    for r in sizes.collect():
        if r.n <= room:
            taken.append((r.id, r.quality, r.mark))
            room -= r.n
    model = AttentionModel.fresh()
    if not taken:
        release(bags)
        model.weights["c"][:] = 0
        return model
    key = ["id", "quality", "mark"]
    sample = docs.sparkSession.createDataFrame(taken, "id long, quality int, mark long")
    rows = bags.join(F.broadcast(sample), key).groupBy(key).agg(F.first("bag").alias("bag")).select("quality", "bag").collect()
    release(bags)
    rows.sort(key=lambda r: (r.bag, r.quality))
    parts = [np.frombuffer(r.bag, np.float16).reshape(-1, WIDTH) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(b) for b in parts])])
    return model.train(np.concatenate(parts).astype(np.float32), first, np.array([r.quality for r in rows]))


def _score(model: AttentionModel, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column(text_at))
            for a, b in chunks(off, 1 << 19):
                scores = model.scores(*passages(data[off[a] : off[b]], off[a : b + 1] - off[a]))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*part.schema.names, "score"])

    return run


def score(docs: DataFrame, model: AttentionModel, text_col: str = "text") -> DataFrame:
    """``docs`` and a ``score`` from 0 to 1 of each row; higher is better."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "score"])
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    return map_batches(docs, _score(model, docs.columns.index(text_col)), schema)
