import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorgrid.llm.packing import WordIds, configurations, pack, plan, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(counts):
    for length in np.flatnonzero(counts):
        for rank in range(counts[length]):
            yield int(length), rank


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_a_packing(seed):
    rng = np.random.default_rng(seed)
    capacity, counts = 256, np.zeros(257, np.int64)
    sizes = [rng.integers(1, 257, 900), rng.integers(90, 140, 700), np.full(500, 129), rng.integers(1, 9, 40),
             np.array([], int), rng.integers(60, 257, 3)][seed]
    np.add.at(counts, sizes, 1)
    chosen = plan(counts, capacity, groups=16)
    length, rank = np.array(list(pieces_of(counts)), np.int64).reshape(-1, 2).T
    sequence, offset = chosen.place(length, rank)
    order = np.lexsort((offset, sequence))
    filled = {}
    for i in order:
        assert offset[i] == filled.get(sequence[i], 0)
        filled[sequence[i]] = offset[i] + length[i]
    assert all(v <= capacity for v in filled.values()) and len(filled) == chosen.sequences
    least = max(-(-int(sizes.sum()) // capacity), int((sizes > capacity // 2).sum()), -(-int((sizes > capacity // 3).sum()) // 2))
    assert chosen.sequences <= 1.05 * least + 2


def test_configurations():
    sizes, demand = np.array([130, 100, 70, 40]), np.array([400, 400, 400, 400])
    used = configurations(sizes, demand, 256)
    assert all((pattern * sizes).sum() <= 256 for pattern, _ in used)
    packed = sum(pattern * n for pattern, n in used)
    assert (packed <= demand).all() and (demand - packed).sum() < 20
    # Sizes that fill sequences without a rest: the linear optimum is the area.
    used = configurations(np.array([128, 64, 32]), np.array([100, 200, 400]), 256)
    assert 147 <= sum(n for _, n in used) <= 150


def test_ids_like_the_tokenizer():
    letters = [*"aB1 é\n\t\x0b\x0c\x1c\x85\xa0́Å's.", "<|endoftext|>", "<|ENDOFTEXT|>", "'S ", "Σ", "한", "ᄒ", "ᅡ", "İ", "word", "…"]
    rng = random.Random(5)
    known, plain = WordIds(PATH), Tokenizer.from_file(PATH)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(2000)]
    for i in range(0, 2000, 50):
        ids, edges = known.encode(texts[i : i + 50])
        for n, encoded in enumerate(plain.encode_batch(texts[i : i + 50], add_special_tokens=False)):
            assert ids[edges[n] : edges[n + 1]].tolist() == encoded.ids, texts[i + n]


def test_forgets_and_other_tokenizers(monkeypatch):
    from sensorgrid.llm import packing

    monkeypatch.setattr(packing, "KNOWN_WORDS", 5)
    known, plain = WordIds(PATH), Tokenizer.from_file(PATH)
    for text in ("a b c d", "e f g a b c d", "h " * 9, "one two three four five six seven a"):
        assert known.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
    other = public_tokenizers.path("byte_bpe_50k.json")
    known, plain = WordIds(other), Tokenizer.from_file(other)
    assert not known.by_word
    ids, edges = known.encode(["A text,  with spaces", "", "two"])
    assert ids[: edges[1]].tolist() == plain.encode("A text,  with spaces").ids and edges[1] == edges[2]


def test_pack(spark):
    rows = [(i, "word " * (i * 37 % 900)) for i in range(60)] + [(100, None), (101, ""), (None, "null id"), (None, "null id"), (7, "again"), (102, "long text " * 6000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, block string")
    packed = pack(df, PATH, with_ids=True)
    out = packed.collect()
    plain = Tokenizer.from_file(PATH)
    want = []
    for i, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for n, start in enumerate(range(0, len(ids), 4096)):
            cut = ids[start : start + 4096]
            want.append((i, n, start, len(cut), zlib.crc32(cut.tobytes()), cut.tolist()))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in out), key=str) == sorted(want, key=str)
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096
    for r in sequences(packed).collect():
        assert len(r.ids) == filled[r.sequence_id]
    assert pack(df.limit(0), PATH).collect() == []
