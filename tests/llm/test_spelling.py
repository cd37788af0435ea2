import random
import re
import zlib
from collections import Counter

import pytest

from sensorgrid.llm import spelling
from sensorgrid.llm.spelling import LEAST_LENGTH, chosen_pair, decompose, end_size, longest, spelling_variants


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    close = {w: [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)] for w in words}
    form = {}
    for w, others in close.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(close[w]), words[form[w]] if w in form else None))
    return out


def result(spark, rows, extra=False):
    data = [(*r, "x", 1) if extra else r for r in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string" + (", word string, N int" if extra else ""))
    got = [tuple(r) for r in spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def vocabulary(rng, size, parts):
    """Words of few parts, with neighbours at every distance and place."""
    out = []
    while len(out) < size:
        word = "".join(rng.choice(parts) for _ in range(rng.randint(2, 7)))
        out.append(word)
        for _ in range(3):
            i = rng.randrange(len(word))
            letter = rng.choice("abcéÿz")
            word = rng.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])
            out.append(word)
    return out


@pytest.mark.parametrize("list_size", [1, 4, 64])
def test_like_brute_force(spark, monkeypatch, list_size):
    monkeypatch.setattr(spelling, "LIST", list_size)
    rng = random.Random(list_size)
    words = vocabulary(rng, 500, ["th", "en", "ció", "ment", "a", "ß", "er"])
    words += vocabulary(rng, 20, ["th" * 20, "enaß" * 15, "ab" * 11])  # around the length from which ends are enough
    rows = []
    for d in range(40):
        rows.append((d, ", ".join(words[int(len(words) * rng.random() ** 4)].title() for _ in range(100))))
    want = expected(rows)
    assert len(want) > 200 and any(w[1] for w in want) and max(w[4] for w in want) > 2
    assert result(spark, rows) == want


def test_chain_of_forms(spark):
    text = "aaaaaaa " * 3 + "aaaaaab " * 40 + "aaaaabb " * 500 + "aaaabbb " * 6000
    rows = [(d, text) for d in (3, 5, 6)]
    got = {r[0]: r for r in result(spark, rows)}
    assert got == {r[0]: r for r in expected(rows)}
    assert got["aaaaaaa"][1:3] == ("aaaaaab", "aaaabbb")


def test_defined_cases(spark):
    long_word = "abcdefg" * 4000
    rows = [(1, None), (2, ""), (None, "Letters letters LETTERS"), (4, "ÄÖÜäöüß äöüäöüß " * 2), (4, "ÄÖÜäöüß äöüäöüß " * 2),
            (5, f"{long_word} {long_word} {long_word}x {long_word}x"), (6, "seventy 7seventy7 seventy_seventy short short")]
    assert result(spark, rows, extra=True) == expected(rows)
    assert result(spark, rows[:2]) == set() == result(spark, [])


def test_two_lists_or_both_ends():
    """One edit never affects all that is looked up."""
    import numpy as np

    none = np.zeros(0, np.uint64)
    for c in range(LEAST_LENGTH, 40):
        points = np.pad(np.arange(1, c + 1, dtype=np.uint32)[None], ((0, 0), (1, 1)))
        for frequent in (none, _all_grams(points, c)):
            size, _, cost, _ = decompose(points, c, frequent, np.full(len(frequent), 99), 64)
            left, right, joint = chosen_pair(size, cost, c)
            l, r, width = int(left[0]), int(right[0]), c + 2
            le, re_ = l + size[0, l], r + size[0, r]
            assert size[0, l] and size[0, r] and max(size[0]) <= longest(c)
            if joint[0]:
                assert l == 0 and re_ == width and r == end_size(c) <= le <= width - end_size(c)
            else:
                assert le <= r


def _all_grams(points, c):
    import numpy as np

    return np.unique(np.concatenate([k.ravel() for _, k in spelling._keys(points, c, longest(c))]))
