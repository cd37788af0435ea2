import random

import numpy as np
from hypothesis import given, settings, strategies as st

from sensorgrid.llm.decontaminate import align, contaminated, drop_contaminated


def slow(item, text):
    best, end = 0, 0
    above = [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (1 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        above = row
        if max(row) > best:
            best, end = max(row), row.index(max(row))
    return best, end


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_align(item, text):
    assert align(np.array(item, np.int64), np.array(text, np.int64)) == slow(item, text)


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def test_copies_and_clean_documents(spark):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng, rng.randrange(15, 60)))) for i in range(20)]
    items += [(50, "too short"), (51, None), (None, items[0][1]), (52, ""), (3, items[3][1])]
    docs, want = [], set()
    for d in range(120):
        text = words(rng, rng.randrange(0, 300))
        if d % 3 == 0:
            i = rng.randrange(20)
            copy = items[i][1].split()
            for _ in range(len(copy) // 9):  # words replaced, left out, put in
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([["new"], [], [copy[at], "more"]])
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() if d % 2 else w + "," for w in copy]
            want.add((d, i))
        docs.append((d, " ".join(text)))
    phrase = "of the and to"  # a common phrase in all documents and in an item
    docs = [(i, f"{phrase} {t}") for i, t in docs] + [(200, None), (201, ""), (None, items[1][1]), (0, docs[0][1]), (202, items[2][1] + " x" * 50_000)]
    items[4] = (4, items[4][1] + " " + phrase)
    df = spark.createDataFrame([(*r, 0.5, "x") for r in docs], "doc_id long, text string, score double, window string")
    tests = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    out = contaminated(df, tests).collect()
    found = {(r.doc_id, r.item_id) for r in out}
    assert found == want | {(202, 2)} and len(out) == len(found)
    assert {(r.doc_id, r.item_id) for r in contaminated(df, tests, short=False).collect()} == found
    exact = next(r for r in out if r.doc_id == 202)
    assert (exact.score, exact.first_word, exact.last_word) == (1.0, 0, len(items[2][1].split()) - 1)
    kept = drop_contaminated(df, tests)
    gone = {d for d, _ in found}
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in gone)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text of a document")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some text of a document")], "item_id long, text string")
    assert contaminated(docs.limit(0), items).collect() == []
    assert contaminated(docs, items.limit(0)).collect() == []
    assert len(contaminated(docs, items).collect()) == 1


def test_short_items_like_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["Red", "blue,", "GREEN", "\u00e9t\u00e9"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    docs += [(70, None), (None, "red blue"), (0, docs[0][1])]
    items = [(1, "red blue"), (2, "Green"), (3, "blue red green"), (4, "\u00c9t\u00e9 red"), (5, "red blue"), (6, ""), (7, "black"), (None, "red")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, text in docs:
        has = (text or "").lower().replace(",", "").split()
        for item, phrase in items:
            p = phrase.lower().split()
            at = [k for k in range(len(has) - len(p) + 1) if has[k : k + len(p)] == p]
            if i is not None and item is not None and p and at:
                want.add((i, item, 1.0, at[0], at[0] + len(p) - 1))
    out = contaminated(df, tests).collect()
    assert {tuple(r) for r in out} == want and len(out) == len(want) > 20
    assert drop_contaminated(df, tests).count() == len(docs)
    gone = {i for i, *_ in want}
    assert drop_contaminated(df, tests, short=True).count() == sum(i not in gone for i, _ in docs)


def test_one_rule_for_all_lengths(spark):
    """Half of the words decides, for long items too."""
    item = [f"w{i}" for i in range(400)]
    docs = [(0, " ".join(item)), (1, " ".join(item[:210])), (2, " ".join(item[:150])), (3, " ".join(item[100:310]))]
    out = contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(9, " ".join(item))], "item_id long, text string"),
    ).collect()
    assert {r.doc_id: r.score for r in out} == {0: 1.0, 1: 210 / 400, 3: 210 / 400}
