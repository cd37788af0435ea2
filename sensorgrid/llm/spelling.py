"""Spelling variants found with an index of variable-length grams (operator 13).

1. Words are counted over whole texts, all in Spark expressions; a rule on the hash of a document
   and a word may delete one of its code points first (``corrupted``).
2. Gram dictionary: for each word length c the grams of the padded words of lengths c and c + 1
   are counted, from ``SHORTEST`` code points on; a gram that more than ``list_size`` places hold
   is extended by one code point, up to three fifths of a padded word.  What stays in the
   dictionary are the frequent grams.  There are at most ``DICTIONARY`` of them, because
   ``list_size`` grows with the number of places; so they can travel to the tasks.
3. A word is taken apart: the gram at a place is the shortest one that is not frequent, or the
   longest allowed.  It depends on its own code points alone, so an edit affects a gram only if it
   lies inside it.
4. All grams are indexed by length, gram and place, and so is the pair of a word's both ends.  A word
   looks up the two lists that are expected to be the shortest and of which one edit affects one at
   most: two grams that share no place (bound: one of two lists holds every near word).  Where all
   such grams are frequent, it takes the grams at its start and at its end, which overlap; an edit
   where they do affects both, but neither of the ends, so the list of words that hold both ends (a
   merge with the bound two of two) is looked up too.  Near words of the same length are at the same
   place of a list, those that are a code point longer at the same place or the next one.
5. What the lists hold is verified by edit distance, inside the join; letters as bits rule most out.

Nothing is capped: a list of any length is joined, and adaptive execution splits long ones.

Defined cases: null and empty texts have no words; the text of a null doc_id is hashed as an empty
string; repeated rows count each time; other columns are ignored; an empty table gives no rows.
Lower-casing is for A to Z only, and an upper-case letter beyond them is another letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.llm.common import map_batches, quoted
from sensorgrid.llm.words import U64, mix, numbers
from sensorgrid.staging import release, stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent.
FORM_TIMES = 10
#: Code points in the shortest and the longest grams.
SHORTEST, LONGEST = 3, 12
#: Places of a gram that is not extended, and grams in the dictionary at most.
LIST, DICTIONARY = 64, 1_000_000
#: Words that are expected to hold both ends of a word.
ENDS_COST = 30
#: Code points at either end of a long word that are looked at.
HALF = 32
#: Gram lengths that are counted in one pass; a frequent gram's beginnings are frequent, too.
STEP = 2
#: Keys that a task counts before it passes them on.
HELD = 1 << 21

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLACES = numbers(LONGEST, 31)
_SALTS = numbers(4, 32)


def corrupted(doc_id: Column, run: Column) -> Column:
    """``run`` without its code point h % length where 31 divides h, the crc32 of doc_id:run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 31 == 0, cut).otherwise(run)


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words long and frequent enough."""
    low = F.translate(quoted(text_col).cast("string"), _UPPER, _LOWER)
    # A shorter run cannot become a word; a match starts where a run does, as shorter ones fail.
    runs = F.regexp_extract_all(low, F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    found = docs.select(quoted(id_col).alias("id"), F.explode(runs).alias("run"))
    words = found.select(corrupted(F.col("id"), F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def longest(c: int) -> int:
    """Code points of the longest grams for pairs of words of c and of c or c + 1 code points."""
    return min((3 * (c + 2) + 2) // 5, LONGEST)


def end_size(c: int) -> int:
    """Code points of the two ends of a padded word that are looked up together."""
    return c + 2 - longest(c)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Lengths, rows of the words of that length, and their code points between two marks."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join([words[r] for r in rows]).encode("utf-32-le"), np.uint32).reshape(len(rows), length)
        yield int(length), rows, np.pad(points, ((0, 0), (1, 1)), constant_values=((0, 0), (1, 1)))


def _keys(points: np.ndarray, c: int, upto: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each gram length from SHORTEST: hashes of the grams at all places, for class c."""
    letters = mix(points.astype(U64) + U64(7))
    total = np.zeros(points.shape, U64)
    width = points.shape[1]
    with np.errstate(over="ignore"):
        for q in range(1, upto + 1):
            total[:, : width - q + 1] += letters[:, q - 1 :] * _PLACES[q - 1]
            if q >= SHORTEST:
                yield q, mix(total[:, : width - q + 1] + U64(c) * _SALTS[0] + U64(q) * _SALTS[1])


def _view(points: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a class looks at: the code points, their places in the word, and where grams may start.

    Of words over twice ``HALF`` code points both ends are enough, as grams there share no place.
    """
    width = points.shape[1]
    if c <= 2 * HALF:
        return points, np.arange(width), np.ones(width, bool)
    places = np.concatenate([np.arange(HALF), np.arange(width - HALF, width)])
    at = np.arange(2 * HALF)
    return points[:, places], places, (at <= HALF - LONGEST) | (at >= HALF)


def _found(keys: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is frequent, and its place in the dictionary."""
    if not len(frequent):
        return np.zeros(keys.shape, bool), np.zeros(keys.shape, np.int64)
    at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
    return frequent[at] == keys, at


def decompose(
    points: np.ndarray, c: int, frequent: np.ndarray, counts: np.ndarray, list_size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Length (0: none), hash and expected list of the gram at each place of each word; the places."""
    points, places, open_ = _view(points, c)
    size = np.zeros(points.shape, np.int64)
    gram = np.zeros(points.shape, U64)
    cost = np.zeros(points.shape, np.float64)
    upto = longest(c)
    for q, keys in _keys(points, c, upto):
        width = keys.shape[1]
        often, at = _found(keys, frequent)
        stop = (size[:, :width] == 0) & (~often | (q == upto))
        size[:, :width][stop] = q
        gram[:, :width][stop] = keys[stop]
        # Of rare grams the longer ones are taken to be rarer.
        guess = list_size / (2.0 + q)
        expected = np.where(often, counts[at] if len(counts) else 0, guess)
        # A gram without a mark is spread over places.
        expected[:, 1 : points.shape[1] - q] /= 3
        cost[:, :width][stop] = expected[stop]
    size[:, ~open_] = 0
    return size, gram, cost, places


def _levels(q: int, frequent: np.ndarray):
    """Counts of the grams of q to q + STEP - 1 code points whose beginnings below q are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held) if held else np.zeros(0, U64), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["gram", "places"])

        for batch in batches:
            for length, _, points in _by_length(batch.column(0).to_pylist()):
                for c in (length, length - 1):
                    if c < LEAST_LENGTH or q > longest(c):
                        continue
                    seen, _, open_ = _view(points, c)
                    alive = np.broadcast_to(open_, seen.shape)
                    for k, keys in _keys(seen, c, min(q + STEP - 1, longest(c))):
                        alive = alive[:, : keys.shape[1]]
                        if k >= q:
                            held.append(keys[alive])
                            many += len(held[-1])
                        else:
                            alive = alive & _found(keys, frequent)[0]
            if many > HELD:
                yield counted()
                held, many = [], 0
        if many:
            yield counted()

    return run


def gram_dictionary(words: DataFrame, list_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and places of the grams that more than ``list_size`` places hold."""
    frequent, counts = np.zeros(0, U64), np.zeros(0, np.int64)
    for q in range(SHORTEST, LONGEST + 1, STEP):
        level = map_batches(words.select("word"), _levels(q, frequent), "gram long, places long")
        rows = level.groupBy("gram").agg(F.sum("places").alias("places")).where(F.col("places") > list_size).toArrow()
        if not len(rows):
            break
        frequent = np.concatenate([frequent, rows["gram"].to_numpy().view(U64)])
        counts = np.concatenate([counts, rows["places"].to_numpy()])
        order = np.argsort(frequent)
        frequent, counts = frequent[order], counts[order]
    return frequent, counts


def _entry(gram: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Key of the list of words of ``length`` that hold ``gram`` at ``place``."""
    with np.errstate(over="ignore"):
        return mix(gram + place.astype(U64) * _SALTS[2] + U64(length)).view(np.int64)


def _letters(points: np.ndarray) -> np.ndarray:
    """Code points of each word as a set of bits; one edit changes two of them at most."""
    out = np.zeros(len(points), U64)
    for a in range(1, points.shape[1] - 1, 1 << 16):
        part = points[:, a : min(a + (1 << 16), points.shape[1] - 1)]
        out |= np.bitwise_or.reduce(U64(1) << (part.astype(U64) & U64(63)), axis=1)
    return out.view(np.int64)


def _rows(batch: pa.RecordBatch, rows: list[np.ndarray], keys: list[np.ndarray], bits: list[np.ndarray]) -> pa.RecordBatch:
    own = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
            batch.column(0).take(pa.array(own)),
            batch.column(1).take(pa.array(own)),
            pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)),
        ],
        names=["entry", "word", "n", "bits"],
    )


_SCHEMA = "entry long, word string, n long, bits long"


def _ends(points: np.ndarray, c: int) -> np.ndarray:
    """Hash of both ends of each word."""
    points, _, _ = _view(points, c)
    size, width = min(end_size(c), HALF), points.shape[1]
    both = np.concatenate([points[:, :size], points[:, width - size :]], axis=1)
    with np.errstate(over="ignore"):
        return mix((mix(both.astype(U64) + U64(7)) * numbers(2 * size, 33)).sum(axis=1, dtype=U64) + U64(c) * _SALTS[3])


def _index(frequent: np.ndarray, counts: np.ndarray, list_size: int):
    """An entry for each gram of each word, as the longer and as the equally long word of a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, bits = [], [], []
            for length, own, points in _by_length(batch.column(0).to_pylist()):
                marks = _letters(points)
                for c in (length, length - 1):
                    if c < LEAST_LENGTH:
                        continue
                    size, gram, _, places = decompose(points, c, frequent, counts, list_size)
                    r, p = np.nonzero(size)
                    rows += [own[r], own]
                    keys += [_entry(gram[r, p], places[p], length), _entry(_ends(points, c), np.zeros(len(own)), length)]
                    bits += [marks[r], marks]
            yield _rows(batch, rows, keys, bits)

    return run


def chosen_pair(size: np.ndarray, cost: np.ndarray, c: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the two grams to look up for each word, and whether its ends are to be, too."""
    n, width = size.shape
    row = np.arange(n)
    # The best gram that ends at or before a place.
    ends = np.where(size > 0, np.arange(width) + size, width + 1)
    best, at = np.full((n, width + 2), np.inf), np.zeros((n, width + 2), np.int64)
    for p in range(width):
        e = ends[:, p]
        better = (size[:, p] > 0) & (cost[:, p] < best[row, e])
        best[row[better], e[better]] = cost[better, p]
        at[row[better], e[better]] = p
    for e in range(1, width + 1):
        worse = best[:, e - 1] <= best[:, e]
        best[worse, e], at[worse, e] = best[worse, e - 1], at[worse, e - 1]
    start = width - longest(c)
    left, right = np.zeros(n, np.int64), np.full(n, start)
    total = cost[:, 0] + cost[:, start]
    joint = size[:, 0] > start
    total[joint] += ENDS_COST
    for p in range(width):
        sum_ = best[:, p] + cost[:, p]
        better = (size[:, p] > 0) & (sum_ < total)
        total[better], left[better], right[better], joint[better] = sum_[better], at[better, p], p, False
    return left, right, joint


def _probes(frequent: np.ndarray, counts: np.ndarray, list_size: int):
    """The lists that hold all words near a word and not shorter than it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, bits = [], [], []
            for length, own, points in _by_length(batch.column(0).to_pylist()):
                marks = _letters(points)
                size, gram, cost, places = decompose(points, length, frequent, counts, list_size)
                if length > 2 * HALF:
                    # Where the longer word may not have an entry, being a place off.
                    size[:, [HALF - LONGEST, HALF]] = 0
                left, right, joint = chosen_pair(size, cost, length)
                row, ends = np.arange(len(own)), _ends(points[joint], length)
                for of, on, longer in ((left, 0, 0), (right, 0, 0), (left, 0, 1), (right, 1, 1)):
                    rows.append(own)
                    keys.append(_entry(gram[row, of], places[of] + on, length + longer))
                    bits.append(marks)
                for longer in (0, 1):
                    rows.append(own[joint])
                    keys.append(_entry(ends, np.zeros(len(ends)), length + longer))
                    bits.append(marks[joint])
            yield _rows(batch, rows, keys, bits)

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, b, n_a, n_b)``: pairs of ``words (word, n)`` that differ by exactly one code point
    inserted, deleted or replaced, each once.  Words are different, of LEAST_LENGTH or more."""
    places = words.agg(F.sum(2 * (F.length("word") + 2)).alias("s")).first().s or 0
    list_size = max(LIST, -(-places * (LONGEST - SHORTEST + 1) // DICTIONARY))
    frequent, counts = gram_dictionary(words, list_size)
    pair = words.select("word", "n")
    index = map_batches(pair, _index(frequent, counts, list_size), _SCHEMA).alias("t")
    probes = map_batches(pair, _probes(frequent, counts, list_size), _SCHEMA).alias("s")
    found = probes.join(
        index,
        (F.col("s.entry") == F.col("t.entry"))
        & (F.bit_count(F.col("s.bits").bitwiseXOR(F.col("t.bits"))) <= 2)
        & ((F.length("s.word") < F.length("t.word")) | (F.col("s.word") < F.col("t.word")))
        & (F.levenshtein("s.word", "t.word", 1) == 1),
    )
    return found.select(
        F.col("s.word").alias("a"), F.col("t.word").alias("b"), F.col("s.n").alias("n_a"), F.col("t.n").alias("n_b")
    ).distinct()


def follow(links: DataFrame) -> DataFrame:
    """``(word, root)`` for ``links (word, form)``: the last form reached.  A staged table.

    Each round doubles the steps; a form is ten times as frequent, so there are few.
    """
    roots = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(roots.join(onward, "root", "left"), "spelling-roots")
        release(roots)
        more = joined.where("next is not null").limit(1).count() > 0
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))
        roots._staged_at = joined._staged_at
        if not more:
            return roots


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``docs``."""
    words = stage(counted_words(docs, id_col, text_col), "spelling-words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    # The most frequent near word; of equally frequent ones the smallest.
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= FORM_TIMES * F.col("n"), F.col("best")).alias("best"),
    )
    known = stage(known.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.less")).alias("form_n")), "spelling-forms")
    release(words)
    roots = follow(known.where("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
