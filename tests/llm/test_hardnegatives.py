import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgrid.llm import hardnegatives
from sensorgrid.llm.hardnegatives import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def expected(rows, anchor, positives=5, k=5, low=80):
    usable = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        usable[i] = min(usable.get(i, row), row)
    out = set()
    for a in filter(anchor, usable):
        label, v = usable[a]

        def best(same):
            found = [(-sum(x * y for x, y in zip(v, w)), i) for i, (m, w) in usable.items() if i != a and (m == label) == same and len(w) == len(v)]
            return [(i, -s) for s, i in sorted(found)]

        others = best(False)
        for p, top in best(True)[:positives]:
            inside = [(i, s) for i, s in others if low * top <= 100 * s <= 100 * top][:k]
            out |= {(a, p, rank, i, top, s) for rank, (i, s) in enumerate(inside, 1)}
    return out


def result(df, **options):
    out = hard_negatives(df, F.col("id") % 4 == 0, **options)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("scale,pairs,least", [(1, 1 << 21, 1 << 10), (300, 64, 8), (1e5, 50, 8), (1e6, 1 << 21, 8)])
def test_like_brute_force(spark, monkeypatch, scale, pairs, least):
    """Whole numbers in single, double and any precision; one block and several."""
    monkeypatch.setattr(hardnegatives, "LEAST_ROWS", least)
    monkeypatch.setattr(hardnegatives, "PAIRS", pairs)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in np.round(rng.normal(1, 1, 3), 1) * scale], int(rng.integers(3))) for i in rng.permutation(150)]
    rows += [(200 + i, rows[0][1], i % 4) for i in range(60)]  # a hot vector, ties
    want = expected(rows, lambda i: i % 4 == 0)
    assert len(want) > 200
    assert result(spark.createDataFrame(rows, SCHEMA)) == want


def test_other_windows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0.5, 1, 2)], i % 2) for i in range(80)]
    want = expected(rows, lambda i: i % 4 == 0, 3, 2, 50)
    assert result(spark.createDataFrame(rows, SCHEMA), positives=3, k=2, low=50) == want


def test_defined_cases(spark):
    rows = [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 0.9], 1), (3, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1),
            (7, [float("inf"), 1.0], 1), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (4, [1.0], 0), (10, [1.0], 0), (11, [0.9], 1),
            (2, [1.0, 0.9], 1), (2, [0.0, 0.0], 2), (8, [-1.0, 0.0], 0), (13, [], 0), (12, [], 0), (14, [], 1), (16, [1e-30], 7)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA + ", ID int, score string")
    got = result(df)
    assert got == expected(rows, lambda i: i % 4 == 0)
    assert (0, 1, 1, 2, 2 * 256**2, 256**2 + 256 * 230) in got and (12, 13, 1, 14, 0, 0) in got
    assert result(df.limit(0)) == set()
    huge = [(0, [1e300], 0), (1, [1e300], 0), (2, [1e300], 1)]
    assert result(spark.createDataFrame(huge, SCHEMA)) == {(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)}
