import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sensorgrid.llm import toxicity
from sensorgrid.llm.quality import held_out
from sensorgrid.llm.toxicity import ACT, INSULT, LISTED, LISTED_WEIGHT, MACHINES, OTHER, arc, clause_weights, features, fit_toxicity, listed, regression, score_toxicity
from sensorgrid.llm.words import SYMBOLS, Words, utf8


@pytest.mark.parametrize("sf,least", [("0.01", 0.95), ("0.1", 0.98)])
def test_held_out_accuracy(spark, sf, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, fit_toxicity(docs, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("toxicity", "toxic").collect()
    right = np.mean([(r.toxicity >= 0.7) == (r.toxic == 1) for r in rows])
    clean = np.mean([r.toxicity < 0.7 for r in rows if r.toxic == 0])
    assert len(rows) > 100 and right > least and clean > 0.99


def plain(text):
    """Weights of the clauses with an insult or act, machine by machine and word by word."""
    roles = {w: role for role, words in LISTED.items() for w in words}
    out = []
    for clause in re.split(r"[.!?;:\n]", text):
        states, total, hot = dict.fromkeys(MACHINES, 0), 0.0, False
        for word in re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in clause)):
            role = roles.get(word, OTHER)
            factor, added = arc(states, role)
            total += factor * LISTED_WEIGHT + added
            hot |= role in (INSULT, ACT)
            states = {n: m.step(states[n], role) for n, m in MACHINES.items()}
        if hot:
            out.append(total)
    return out


def weights(texts):
    data, off = utf8(pa.array(texts))
    row, weight = clause_weights(data, Words(data, off, SYMBOLS), listed())
    return [weight[row == r].tolist() for r in range(len(texts))]


def test_composed_machine_like_plain_ones():
    rng = np.random.default_rng(2)
    vocabulary = [w for words in LISTED.values() for w in words[:5]] + ["word"] * 12 + [".", "\n", ",", "!", "1"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 120))) for _ in range(300)] + [None, "", "...", "idiot" * 2000]
    for got, text in zip(weights(texts), texts, strict=True):
        assert np.allclose(got, plain(text or ""))
    assert sum(map(len, weights(texts))) > 500


def test_clauses_not_words():
    one = lambda text: sum(weights([text])[0])
    assert one("You are an idiot") > one("Some idiot came") > one("You are not an idiot") > 0
    assert one("Some idiot came") > one("She said that some idiot came") > 0
    assert one("I will kill you") > one("I will kill time") > one("Kill time") == 0
    assert one("An idiot. You") < one("An idiot, you") and one("You. An idiot") < one("You, an idiot")
    assert one("a plain text about you") == 0


def test_learnt_beginnings(spark):
    """Insults of an unknown language, seen only with their endings."""
    rng = np.random.default_rng(1)
    plain_word = lambda: "".join(rng.choice(["la", "ko", "mi", "re", "su"], rng.integers(1, 4)))
    rows = []
    for i in range(900):
        words = [plain_word() for _ in range(60)]
        if i % 5 == 0:
            for j in rng.choice(60, 3, replace=False):
                words[j] = "zorqu" + plain_word()
        rows.append((i, " ".join(words), i % 5 == 0))
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, TOXIC string")
    labels = spark.createDataFrame([(i, int(t)) for i, _, t in rows], "doc_id long, toxic int")
    out = score_toxicity(docs, fit_toxicity(docs, labels)).select("doc_id", "toxicity").collect()
    assert all((r.toxicity >= 0.7) == (r.doc_id % 5 == 0) for r in out)
    few = fit_toxicity(docs, labels, toxic=30, clean=50)
    assert len(few.keys) > len(listed().keys)


def test_defined_cases(spark, monkeypatch):
    texts = ["You are an idiot, you stupid scum.", "A plain and quiet text.", None, "", " \n ", "you idiot " * 30000, "quiet " * 100000]
    rows = [(i, t, 0.5) for i, t in enumerate(texts)] + [(None, texts[0], 0.5), (0, texts[0], 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Toxicity double")
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    out = score_toxicity(docs, fit_toxicity(docs, empty))
    assert out.columns == ["doc_id", "text", "toxicity"]
    got = [(r.text, r.toxicity) for r in out.collect()]
    assert len(got) == len(rows) and all((s >= 0.7) == ("idiot" in (t or "")) for t, s in got)
    assert len({s for t, s in got if t in (None, "", " \n ", texts[1])}) == 1
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (3, None), (1, 0), (2, 5)], "doc_id long, toxic int")
    assert all(0 <= r.toxicity <= 1 for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect())
    assert score_toxicity(docs.limit(0), listed()).collect() == []
    monkeypatch.setattr(toxicity, "LEAST_RATIO", -99.0)
    assert score_toxicity(docs.limit(0), fit_toxicity(docs.limit(0), labels)).collect() == []


def test_regression_counts_nothing_against():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 2))])
    y = (x[:, 1] - x[:, 2] + rng.normal(size=300) / 2 > 0).astype(float)
    w = regression(x, y)
    assert w[1] > 1 and w[2] == 0


def test_features_cover_whole_texts():
    long_text = "word " * 50000 + "you idiot"
    x = features(*utf8(pa.array([long_text, "", "you idiot"])), listed())
    assert x[0, 1] == x[2, 1] > 0 and x[1, 1:].tolist() == [0, 0, 0, 0]
