import random

import pytest

from sensorgrid.llm import neardup
from sensorgrid.llm.components import components
from sensorgrid.llm.neardup import BITS, SAMPLES, band_rows, drop_near_duplicates, estimate, near_duplicates


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))) if words else frozenset()


def brute(rows, k, percent):
    """Component of each doc_id, from all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def corpus(seed, groups=6, copies=25, words=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(words)] = f"v{rng.randrange(5000)}"
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.component_id for r in near_duplicates(df, **options).collect()}


@pytest.mark.parametrize("small_blocks", [False, True])
def test_like_all_pairs(spark, monkeypatch, small_blocks):
    if small_blocks:  # split components, anchors, and the search outside the largest group
        monkeypatch.setattr(neardup, "BLOCK_ROWS", 4)
        monkeypatch.setattr(neardup, "ANCHORS", 2)
    rows = corpus(3)
    want = brute(rows, 3, 85)
    assert len(set(want.values())) > 10
    assert found(spark, rows, k=3, percent=85) == want


def test_defined_cases(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(5, text), (2, text.upper()), (9, "two words"), (8, " Two\twords "), (7, None), (6, ""), (4, " \n"), (None, text), (5, text)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, kept int, component_id string")
    out = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k=3, percent=85).collect()}
    assert out == {
        (5, 10, 2, False), (2, 10, 2, True), (9, 1, 8, False), (8, 1, 8, True), (7, 0, 7, True), (6, 0, 6, True),
        (4, 0, 4, True), (None, 10, None, True),
    }
    kept = drop_near_duplicates(df, 3, 85)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "6", "7", "8", "None"]
    assert near_duplicates(df.limit(0)).collect() == []


def test_estimate_and_bands():
    # Two samples' sets that differ in d places flip 2 d bits.
    import numpy as np

    for similarity in (0.8, 0.85, 0.95, 1.0):
        flips = 2 * SAMPLES * (1 - similarity)
        z = BITS / 2 * (1 - (1 - 2 / BITS) ** flips)
        assert abs(float(estimate(np.array(z))) - similarity) < 0.002
    assert band_rows(85) > band_rows(80) > 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 300), (300, 400), (200, 400), (5, 5), (None, 3), (9, 9)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**dict.fromkeys([*range(41), 100], 0), 200: 200, 300: 200, 400: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
