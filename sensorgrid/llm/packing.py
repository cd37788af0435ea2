"""Best-fit packing of token sequences by a linear grouping scheme (operator 6).

Documents become token ids and an end mark; those longer than ``capacity`` are cut into full
pieces and a rest.  The pieces are then packed into as few sequences as the scheme can:

1. How many pieces there are of each length is all that packing needs; that is one number for
   each of at most ``capacity`` lengths, whatever the input, and so fits the driver.
2. Large pieces (over ``LARGE`` of the capacity) are ordered by length and cut into up to
   ``GROUPS`` groups of equal cardinality; lengths are rounded up to the largest of the group.
   The linear program over configurations of these few sizes is solved by column generation
   (Gilmore and Gomory), and its solution is rounded down.
3. Actual pieces replace the rounded ones, in order of length, so the room they leave is known
   in runs of equal sequences.
4. Everything else, from long to short, goes where the least room is left (best fit), again for
   whole runs of equal lengths and equal sequences at once; new sequences open where none fits.
5. The resulting plan - a few thousand runs - says for the r-th piece of a length in which
   sequence and at which offset it goes.  The ranks are computed by Spark: pieces of a length are
   dealt to blocks, counted, and numbered within blocks, so a frequent length is no hot group.

Defined cases: a null text is an empty one; an empty text is one piece that holds the end mark;
rows that share a doc_id, and null ids, are packed like any others; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sensorgrid.llm.common import map_batches, quoted
from sensorgrid.staging import stage

CAPACITY = 4096
LARGE = 1 / 3
GROUPS = 48
END_ID = 1
#: Words and bytes of words whose ids a task remembers.
KNOWN_WORDS, KNOWN_BYTES = 400_000, 16 << 20
BLOCK_ROWS = 512


#: Small letters (of ASCII, or any other characters) and then ASCII signs without "'" and "<".
PLAIN = re.compile(rb"([a-z\x80-\xff]*[a-z]|[a-z\x80-\xff]+(?=$))([!-&(-/:;=-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable Latin-1 characters
    stand for themselves, the others for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordIds:
    """Token ids of texts.

    A tokenizer that drops white space, lowers letters and parts words never joins what white
    space separates, so the ids of a text are those of its words; frequent words are looked
    up.  Words are parted at ASCII white space only; the tokenizer itself treats all other
    characters.  Any other kind of tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        lists = ("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")
        kinds = [[part["type"] for part in (made.get(a) or {}).get(b, [])] for a, b in lists]
        self.by_word = kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
        self.codes = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.tails: dict[bytes, list[int]] = {}
        self.bytes = self.used = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes = np.zeros(KNOWN_WORDS, np.int64), np.zeros(KNOWN_WORDS, np.int64)

    def _ids_of(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words.  Letters, or letters and then ASCII signs, are what the tokenizer's own
        splitting would leave whole, so its model gets them at once; the rest goes through all
        of the tokenizer."""
        out: list = [None] * len(words)
        odd = []
        model, tails, codes = self.tokenizer.model.tokenize, self.tails, self.codes
        for i, word in enumerate(words):
            match = PLAIN.fullmatch(word)
            if match:
                letters, signs = match.groups()
                text = letters.decode()
                if text.isascii() or (text.isalpha() and text == text.lower() and is_normalized("NFC", text)):
                    ids = [t.id for t in model(text if text.isascii() else letters.decode("latin-1").translate(codes))]
                    if signs:
                        if signs not in tails:
                            tails[signs] = self.tokenizer.encode(signs.decode(), add_special_tokens=False).ids
                        ids += tails[signs]
                    out[i] = ids
                    continue
            odd.append(i)
        for i, found in zip(odd, self.tokenizer.encode_batch_fast([words[i].decode() for i in odd], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return out

    def _learn(self, words: list[bytes]) -> None:
        base = len(self.place)
        if base + len(words) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x[:base], np.zeros(len(words), np.int64)]) for x in (self.starts, self.sizes))
        lists = self._ids_of(words)
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), np.uint32, int(sizes.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.sizes[base : base + len(words)] = sizes
        self.starts[base : base + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.place.update(zip(words, range(base, base + len(words)), strict=True))
        self.bytes += sum(map(len, words))

    @staticmethod
    def _split(text: bytes) -> list[bytes]:
        # The tokenizer lowers all letters, but special tokens are told by their exact letters.
        return (text if b"<|" in text else text.lower()).split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the first of each text."""
        if not self.by_word:
            found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            edges = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *found]), edges
        split = [self._split(t.encode()) for t in texts]
        words = [w for s in split for w in s]
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = list(dict.fromkeys(words[i] for i in missing))
            if len(self.place) + len(new) > KNOWN_WORDS or self.bytes > KNOWN_BYTES:
                self._forget()
                missing, new = np.arange(len(words)), list(dict.fromkeys(words))
            self._learn(new)
            at[missing] = np.fromiter((self.place[words[i]] for i in missing), np.int64, len(missing))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.starts[at] - ends + sizes, sizes)]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)]
        return ids, edges


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this Python worker, with the words it has learned in earlier tasks."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def _pieces(path: str, capacity: int, with_ids: bool):
    """Rows (id, text): a row for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                ids, edges = known.encode([t or "" for t in part.column(1).to_pylist()])
                rows, piece, start, length, check, values = [], [], [], [], [], []
                for r in range(part.num_rows):
                    own = np.append(ids[edges[r] : edges[r + 1]], np.uint32(END_ID)).astype("<u4")
                    for number, first in enumerate(range(0, len(own), capacity)):
                        cut = own[first : first + capacity]
                        rows.append(r)
                        piece.append(number)
                        start.append(first)
                        length.append(len(cut))
                        check.append(zlib.crc32(cut.tobytes()))
                        if with_ids:
                            values.append(cut.astype(np.int32))
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, check)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(values, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration (unbounded knapsack), as counts of the sizes."""
    worth = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    size, value = sizes[order], values[order]
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for room in range(int(size[0]), capacity + 1):
        options = worth[room - size[: fits[room]]] + value[: fits[room]]
        best = int(options.argmax())
        if options[best] > worth[room - 1]:
            worth[room], chosen[room] = options[best], best
        else:
            worth[room] = worth[room - 1]
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
            continue
        counts[order[chosen[room]]] += 1
        room -= size[chosen[room]]
    return float(worth[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use them: the linear optimum, rounded down."""
    patterns = np.diag(capacity // sizes).astype(float)
    inverse = np.linalg.inv(patterns)
    for _ in range(steps):
        prices = inverse.sum(axis=0)
        worth, pattern = _best_pattern(sizes, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        use, move = inverse @ demand, inverse @ pattern
        ratio = np.where(move > 1e-10, np.maximum(use, 0) / np.where(move > 1e-10, move, 1), np.inf)
        patterns[:, int(ratio.argmin())] = pattern
        inverse = np.linalg.inv(patterns)
    use = np.floor(inverse @ demand + 1e-6).astype(np.int64)
    return [(patterns[:, i].astype(np.int64), int(use[i])) for i in range(len(sizes)) if use[i] > 0]


@dataclass
class Plan:
    """Runs of pieces, ordered by length and rank: ``each`` pieces go to every sequence from
    ``sequence`` on, the first of them at ``offset``."""

    lengths: np.ndarray
    ranks: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scale = int(self.ranks.max(initial=0)) + int(rank.max(initial=0)) + 1
        run = np.searchsorted(self.lengths * scale + self.ranks, length * scale + rank, side="right") - 1
        past = rank - self.ranks[run]
        return self.sequence[run] + past // self.each[run], self.offset[run] + past % self.each[run] * length


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> Plan:
    """Plan for ``counts[length]`` pieces of each length up to the capacity."""
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    keys: list[int] = []
    sequences = 0
    used = np.zeros(capacity + 1, np.int64)
    left = counts.astype(np.int64).copy()

    def room(size: int, first: int, number: int) -> None:
        if size > 0:
            if size not in rooms:
                bisect.insort(keys, size)
                rooms[size] = []
            rooms[size].append((first, number))

    least = int(capacity * large) + 1
    lengths = np.arange(capacity, least - 1, -1)
    upto = np.concatenate([[0], np.cumsum(left[lengths])])  # ranks of the large pieces, longest first
    total = int(upto[-1])
    if total:
        wide = -(-total // min(groups, total))
        first = np.arange(0, total, wide)
        sizes = lengths[np.searchsorted(upto, first, side="right") - 1]
        demand = np.minimum(first + wide, total) - first
        # Groups of one size are one demand.
        size, group_of = np.unique(sizes, return_inverse=True)
        begins = np.array([first[group_of == i].min() for i in range(len(size))])
        demand = np.array([demand[group_of == i].sum() for i in range(len(size))])
        taken = begins.copy()
        for pattern, number in configurations(size, demand, capacity):
            slots = np.repeat(np.arange(len(size)), pattern)
            at = []
            for g in slots:
                at.append(int(taken[g]))
                taken[g] += number
            cuts = {0, number}
            for rank in at:
                edges = upto[np.searchsorted(upto, rank, side="right") : np.searchsorted(upto, rank + number, side="left")]
                cuts.update((edges - rank).tolist())
            order = sorted(cuts)
            for i, j in zip(order[:-1], order[1:], strict=True):
                offset = 0
                for rank in at:
                    place = int(np.searchsorted(upto, rank + i, side="right")) - 1
                    length = int(lengths[place])
                    runs.append((length, rank + i - int(upto[place]), sequences + i, 1, offset))
                    offset += length
                room(capacity - offset, sequences + i, j - i)
            sequences += number
        # What rounding down leaves, as runs of ranks.
        spare: list[tuple[int, int, int]] = []
        for g in range(len(size)):
            rank, stop = int(taken[g]), int(begins[g] + demand[g])
            while rank < stop:
                place = int(np.searchsorted(upto, rank, side="right")) - 1
                until = min(stop, int(upto[place + 1]))
                spare.append((int(lengths[place]), rank - int(upto[place]), until - rank))
                rank = until
        left[least:] = 0
    else:
        spare = []
    spare += [(int(n), 0, int(left[n])) for n in np.flatnonzero(left) if left[n]]
    for length, rank, number in sorted(spare, reverse=True):
        while number:
            at = bisect.bisect_left(keys, length)
            if at == len(keys):
                each = capacity // length
                need = -(-number // each)
                room(capacity, sequences, need)
                sequences += need
                continue
            size = keys[at]
            first, free = rooms[size].pop()
            if not rooms[size]:
                keys.pop(at)
                del rooms[size]
            each = size // length
            full = min(free, number // each)
            if full:
                runs.append((length, rank, first, each, capacity - size))
                room(size - each * length, first, full)
                rank, number = rank + full * each, number - full * each
                first, free = first + full, free - full
            elif free:
                runs.append((length, rank, first, number, capacity - size))
                room(size - number * length, first, 1)
                first, free, number = first + 1, free - 1, 0
            if free:
                room(size, first, free)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(5)), sequences)


def _place(chosen, length_at: int, rank_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = chosen.value.place(batch.column(length_at).to_numpy(), batch.column(rank_at).to_numpy())
            columns = [c for i, c in enumerate(batch.columns) if i != rank_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != rank_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def _ranked(pieces: DataFrame, most: int) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0."""
    blocks = max(1, -(-most // BLOCK_ROWS))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)))
    sizes = dealt.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("rank", F.row_number().over(within).cast("long") - 1)
    return numbered.join(offsets, ["length", "block"]).withColumn("rank", F.col("rank") + F.col("before")).drop("block", "before")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and,
    if asked for, the piece's ``ids`` (runs jobs)."""
    texts = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = stage(map_batches(texts, _pieces(tokenizer, capacity, with_ids), schema), "packing-pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most one row per length
        counts[row["length"]] = row["count"]
    chosen = docs.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    ranked = _ranked(pieces, int(counts.max())).select(*pieces.columns, "rank")
    names = ranked.columns
    out = map_batches(ranked, _place(chosen, names.index("length"), names.index("rank")), schema + ", sequence_id long, offset long")
    return out


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids, doc_ids, offsets``, from the result
    of ``pack(..., with_ids=True)``.  A group is one sequence, so at most ``capacity`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")
    )


__all__ = ["CAPACITY", "Plan", "WordIds", "configurations", "pack", "plan", "sequences"]
