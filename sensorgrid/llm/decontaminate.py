"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment (operator 9).

1. The word n-grams of all test items set bits in a bitmap of fixed size, which is broadcast.
   One pass over the documents looks up every n-gram of every text and writes windows: the
   stretch around n-grams that may be an item's, wide enough for the longest item.
2. The windows' n-grams are counted over the whole corpus.  Each item keeps the rarer half of
   its n-grams as seeds (at least ``LEAST_SEEDS``), so common phrases start no alignment.
3. A join on the seeds pairs windows with items; pairs are made distinct before texts meet.
4. Each pair is aligned locally word by word (match 1, mismatch and gap -1).  A document holds
   an item if the score reaches ``share`` of the item's words, whatever its length; so edited,
   reworded and partial copies count, and chance phrases do not.
5. Items of fewer than n words have no n-gram.  They are searched as a whole, by the hash of all
   their words: ``contaminated`` reports every document that holds them word for word, with a
   score of 1.  ``drop_contaminated`` keeps such documents unless told otherwise (``short``), as
   a few words are no evidence of a copied test.

Joins on n-grams are salted by document, so a common one is spread over ``SALTS`` tasks.

Words are runs of letters, digits and all non-ASCII characters, in lower case.

Defined cases: null or empty texts hold nothing; items without words match nothing; equal items
match alike; rows that share a doc_id are one document; rows with a null id are neither found
nor removed.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from sensorgrid.llm.common import free_name, map_batches, quoted
from sensorgrid.llm.words import SYMBOLS, Words, chunks, utf8
from sensorgrid.staging import release, stage

GRAM = 4
LEAST_SEEDS = 8
SHARE = 0.5
SALTS = 16
#: The bitmap has 2 ** MAP_BITS bits (2 MiB).
MAP_BITS = 24


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return utf8(pc.utf8_lower(column.cast(pa.large_string())))


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, SYMBOLS)


def _item_grams(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = _lowered(batch.column(1))
            for a, b in chunks(off):
                words = _words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                grams, first = words.grams(n)
                lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(words.counts(), pa.int64()), lists.cast(pa.list_(pa.int64()))],
                    names=["item_id", "n_words", "grams"],
                )

    return run


def _bitmap(grams: DataFrame) -> np.ndarray:
    """Bits of the grams, as bytes; at most 2 ** (MAP_BITS - 6) rows reach the driver."""
    place = F.shiftrightunsigned("gram", 64 - MAP_BITS)
    words = grams.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(gram, {64 - MAP_BITS}) & 63 as int))")).alias("bits")
    ).toPandas()
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _hits(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the n-grams whose bit is set."""
    place = grams >> np.uint64(64 - MAP_BITS)
    return np.flatnonzero((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))


def _spread(rows: DataFrame, grams: DataFrame, on: list[str]) -> DataFrame:
    """Rows with a doc_id joined with n-grams, each of which is dealt to ``SALTS`` places."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    copies = grams.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return salted.join(copies, [*on, "salt"]).drop("salt")


def _whole(sizes: list[int], bitmap=None):
    """Rows (id, text): the distinct runs of ``sizes`` words, and the first place of each; with a
    bitmap, those whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = _lowered(batch.column(1))
            for a, b in chunks(off):
                words = _words(data[off[a] : off[b]], off[a : b + 1] - off[a])
                ids = batch.column(0).slice(a, b - a)
                for size in sizes:
                    grams, first = words.grams(size)
                    row = np.repeat(np.arange(b - a), np.diff(first))
                    if bitmap is not None:
                        hits = _hits(grams, bitmap.value)
                        grams, row = grams[hits], row[hits]
                    else:
                        hits = np.arange(len(grams))
                    order = np.lexsort((grams, row))  # stable, so the first place comes first
                    fresh = np.ones(len(order), bool)
                    fresh[1:] = (grams[order[1:]] != grams[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
                    chosen = order[fresh]
                    at = pa.array(row[chosen])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), pa.array(np.full(len(chosen), size), pa.int64()), pa.array(grams[chosen].view(np.int64)),
                         pa.array(hits[chosen] - first[row[chosen]], pa.int64())],
                        names=["doc_id", "n_words", "gram", "at"],
                    )

    return run


def _short(texts: DataFrame, tests: DataFrame, sizes: list[int]) -> DataFrame:
    """Items of ``sizes`` words that stand in a document word for word, at their first place."""
    kind = "n_words long, gram long, at long"
    items = map_batches(tests, _whole(sizes), f"doc_id long, {kind}").withColumnRenamed("doc_id", "item_id")
    counts = map_batches(tests, _item_grams(1), "item_id long, n_words long, grams array<long>").select("item_id", "n_words").distinct()
    items = items.join(counts, ["item_id", "n_words"]).select("item_id", "n_words", "gram").distinct()
    # A combining aggregate leaves a row per document and gram before anything is dealt by gram.
    bitmap = tests.sparkSession.sparkContext.broadcast(_bitmap(items))
    held = map_batches(texts, _whole(sizes, bitmap), f"doc_id long, {kind}").groupBy("doc_id", "n_words", "gram").agg(F.min("at").alias("at"))
    return _spread(held, items, ["n_words", "gram"]).groupBy("doc_id", "item_id").agg(F.min(F.struct("at", "n_words")).alias("b")).select(
        "doc_id", "item_id", F.lit(1.0).alias("score"), F.col("b.at").alias("first_word"),
        (F.col("b.at") + F.col("b.n_words") - 1).alias("last_word"),
    )


def _windows(n: int, reach: int, bitmap):
    """Rows (id, text): windows around n-grams whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            data, off = _lowered(batch.column(1))
            for a, b in chunks(off):
                part = data[off[a] : off[b]]
                words = _words(part, off[a : b + 1] - off[a])
                grams, first = words.grams(n)
                hits = _hits(grams, bits)
                if not len(hits):
                    continue
                row = np.searchsorted(first, hits, side="right") - 1
                word = hits - first[row] + words.first[row]
                cut = np.flatnonzero((row[1:] != row[:-1]) | (word[1:] - word[:-1] > reach)) + 1
                begins, closes = np.append(0, cut), np.append(cut, len(hits))
                ids, starts, texts, found = batch.column(0).slice(a, b - a), [], [], []
                for x, y in zip(begins, closes, strict=True):
                    r = row[x]
                    left = max(word[x] - reach, words.first[r])
                    right = min(word[y - 1] + n + reach, words.first[r + 1]) - 1
                    starts.append(int(left - words.first[r]))
                    texts.append(part[words.starts[left] : words.ends[right]].tobytes().decode())
                    found.append(np.unique(grams[hits[x:y]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[begins])), pa.array(starts, pa.int64()), pa.array(texts, pa.string()), pa.array(found, pa.list_(pa.int64()))],
                    names=["doc_id", "start", "window", "grams"],
                )

    return run


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local score of two word sequences, and the position after its last word in ``text``.

    A row of the matrix is one array step: the gap along the text is a running maximum.
    """
    steps = np.arange(len(text) + 1)
    above, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for word in item:
        now = np.maximum(above - 1, 0)
        now[1:] = np.maximum(now[1:], above[:-1] + np.where(text == word, 1, -1))
        above = np.maximum.accumulate(now + steps) - steps
        at = int(above.argmax())
        if above[at] > best:
            best, end = int(above[at]), at
    return best, end


def _align(share: float):
    """Rows (doc_id, item_id, start, window, item): those whose alignment is good enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, items = (_words(*_lowered(part.column(c))) for c in (3, 4))
                rows, found = [], []
                for r in range(part.num_rows):
                    item = items.hashes[items.first[r] : items.first[r + 1]]
                    text = texts.hashes[texts.first[r] : texts.first[r + 1]]
                    if not len(item) or not len(text):
                        continue
                    score, end = align(item, text)
                    if score >= share * len(item):
                        # The same alignment read backwards from its end gives its first word.
                        back = align(item[::-1], text[:end][::-1])[1]
                        start = part.column(2)[r].as_py()
                        rows.append(r)
                        found.append((score / len(item), start + end - back, start + end - 1))
                score, first, last = zip(*found, strict=True) if found else ((), (), ())
                chosen = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(chosen), part.column(1).take(chosen), pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                    names=["doc_id", "item_id", "score", "first_word", "last_word"],
                )

    return run


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = GRAM, share: float = SHARE,
    id_col: str = "doc_id", text_col: str = "text", short: bool = True,
) -> DataFrame:
    """Test items found in documents: ``doc_id, item_id, score, first_word, last_word`` of the
    best alignment, one row per document and item (runs jobs)."""
    spark = docs.sparkSession
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item")).where("item_id is not null")
    grams = stage(map_batches(tests, _item_grams(n), "item_id long, n_words long, grams array<long>"), "bench-items")
    reach, sizes = grams.agg(F.max("n_words"), F.collect_set(F.when(F.col("n_words").between(1, n - 1), F.col("n_words")))).first()
    reach = reach or 0
    own = grams.select("item_id", F.explode("grams").alias("gram")).distinct()
    bitmap = spark.sparkContext.broadcast(_bitmap(own))
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text")).where("id is not null")
    windows = stage(
        map_batches(texts, _windows(n, reach, bitmap), "doc_id long, start long, window string, grams array<long>"), "bench-windows"
    )
    hits = windows.select("doc_id", "start", F.explode("grams").alias("gram"))
    seen = hits.groupBy("gram").agg(F.count("*").alias("seen"))
    per_item = Window.partitionBy("item_id")
    seeds = (
        own.join(seen, "gram", "left")
        .withColumn("rank", F.row_number().over(per_item.orderBy(F.coalesce("seen", F.lit(0)), "gram")))
        .withColumn("n_grams", F.count("*").over(per_item))
        .where(F.col("rank") <= F.greatest(F.lit(LEAST_SEEDS), F.ceil(F.col("n_grams") / 2))).select("gram", "item_id")
    )
    pairs = stage(_spread(hits, seeds, ["gram"]).select("doc_id", "start", "item_id").distinct(), "bench-pairs")
    rows = pairs.join(windows.drop("grams"), ["doc_id", "start"]).join(tests, "item_id").select(
        "doc_id", "item_id", "start", "window", "item"
    )
    found = map_batches(rows, _align(share), "doc_id long, item_id long, score double, first_word long, last_word long")
    if short and sizes:
        found = found.unionByName(_short(texts, tests, sorted(sizes)))
    best = stage(
        found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("first_word")).alias("f"), "last_word")).alias("b"))
        .select("doc_id", "item_id", "b.score", (-F.col("b.f")).alias("first_word"), "b.last_word"), "bench-found",
    )
    release(grams, windows, pairs)
    return best


def drop_contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False
) -> DataFrame:
    """``docs`` without the documents that hold a test item (of n words or more, if not ``short``)."""
    key = free_name(docs, "leak_id")
    leaks = contaminated(docs, items, id_col=id_col, text_col=text_col, short=short).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(leaks, quoted(id_col).cast("long") == F.col(key), "left_anti")
