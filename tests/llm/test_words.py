import hypothesis.strategies as st
import numpy as np
import pyarrow as pa
from hypothesis import given, settings

from sensorgrid.llm.words import SPACES, SYMBOLS, Words, chunks, distinct, utf8

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 é\n\t_-", max_size=30)), max_size=6)


def split(text, symbols):
    raw = (text or "").encode().lower()
    if symbols:
        raw = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in raw)
    return raw.split()


@settings(max_examples=200, deadline=None)
@given(TEXT, st.booleans(), st.integers(1, 4))
def test_words_and_grams_like_a_plain_split(texts, symbols, k):
    data, off = utf8(pa.array(texts, pa.string()))
    words = Words(data, off, SYMBOLS if symbols else SPACES)
    plain = [split(t, symbols) for t in texts]
    assert words.counts().tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    same = {(a, b) for a, b in zip(flat, words.hashes.tolist(), strict=True)}
    assert len(same) == len(set(flat)) == len(set(words.hashes.tolist()))
    grams, first = words.grams(k, whole=True)
    want = [[tuple(p[i : i + k]) for i in range(max(len(p) - k + 1, 1))] if p else [] for p in plain]
    assert np.diff(first).tolist() == [len(w) for w in want]
    flat = [g for w in want for g in w]
    assert len({(a, b) for a, b in zip(flat, grams.tolist(), strict=True)}) == len(set(flat)) == len(set(grams.tolist()))
    unique, starts = distinct(grams, first)
    assert np.diff(starts).tolist() == [len(set(w)) for w in want]


def test_hashes_do_not_depend_on_the_batch():
    texts = ["one two", None, "", "two " * 5000, "x" * 100_000, "one"]
    data, off = utf8(pa.array(texts))
    whole = Words(data, off).hashes
    parts = [Words(data[off[a] : off[b]], off[a : b + 1] - off[a]).hashes for a, b in chunks(off, 10)]
    assert (np.concatenate(parts) == whole).all()
    assert list(chunks(off, 10)) == [(0, 3), (3, 4), (4, 5), (5, 6)]
