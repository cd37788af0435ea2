import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sensorgrid.llm.quality import AttentionModel, fit, held_out, passages, score
from sensorgrid.llm.words import utf8

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, fit(docs, labels))
    assert out.columns == [*docs.columns, "score"]
    rows = out.join(labels, "doc_id").where(held_out(F.col("doc_id"))).select("score", "quality").collect()
    right = sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows)
    assert len(rows) > 100 and right > 0.95


def test_defined_cases(spark):
    good, bad = "Some plain words follow each other here. " * 20, "BUY!!! NOW$$$ " * 40
    rows = [(i, good if i % 2 else bad) for i in range(60)] + [(100, None), (101, ""), (None, good), (3, good), (102, good * 2000)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, SCORE double")
    labels = spark.createDataFrame(
        [(i, i % 2, "x") for i in range(60)] + [(3, 1, "x"), (None, 0, "x"), (5, None, "x")], "doc_id long, quality int, text string"
    )
    out = score(docs, fit(docs, labels, max_documents=60))
    assert out.columns == ["doc_id", "text", "score"]
    got = [(r.doc_id, r.text, r.score) for r in out.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, _, s in got)
    assert all((s >= 0.5) == (t[0] == "S") for _, t, s in got if t)
    none = score(docs, fit(docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}
    assert score(docs.limit(0), AttentionModel.fresh()).collect() == []


def test_held_out_rule(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert spark.sql("select cast(null as long) id").select(held_out(F.col("id")).alias("h")).first().h is False


def test_slopes_like_differences():
    rng = np.random.default_rng(0)
    model = AttentionModel.fresh(5)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, first, target = rng.normal(size=(9, 5)), np.array([0, 2, 3, 9]), np.array([1, 0, 1])

    def loss():
        y = model.forward(x, first)["y"]
        return -np.mean(target * np.log(y) + (1 - target) * np.log(1 - y))

    slopes = model.slopes(x, first, target)
    for name, values in model.weights.items():
        at = tuple(0 for _ in values.shape)
        old, small = values[at], 1e-5
        values[at] = old + small
        up = loss()
        values[at] = old - small
        down = loss()
        values[at] = old
        assert abs((up - down) / (2 * small) - slopes[name][at]) < 1e-6


def test_passages_cover_whole_texts():
    texts = ["", None, " \n ", "one", "w " * 250, "x" * 5000]
    x, first = passages(*utf8(pa.array(texts)))
    assert np.diff(first).tolist() == [1, 1, 1, 1, 3, 1]
    alone = [passages(*utf8(pa.array([t])))[0] for t in texts]
    assert np.allclose(np.concatenate(alone), x, atol=1e-6)


def test_forward_like_plain_loops():
    rng = np.random.default_rng(3)
    model = AttentionModel.fresh(6)
    model.weights = {k: rng.normal(size=v.shape) for k, v in model.weights.items()}
    p = model.weights
    x, first = rng.normal(size=(11, 6)), np.array([0, 1, 5, 11])
    want = []
    for a, b in zip(first[:-1], first[1:]):
        hidden = [np.tanh(np.array([sum(row[i] * p["e"][i, j] for i in range(6)) for j in range(len(p["f"]))]) + p["f"]) for row in x[a:b]]
        raw = [
            sum(p["w"][j] * np.tanh(h @ p["v"][:, j]) / (1 + np.exp(-(h @ p["u"][:, j]))) for j in range(len(p["w"])))
            for h in hidden
        ]
        weight = np.exp(raw) / np.exp(raw).sum()
        z = sum(w * h for w, h in zip(weight, hidden))
        want.append(1 / (1 + np.exp(-(z @ p["c"] + p["b"][0]))))
    assert np.allclose(model.scores(x, first), want, atol=1e-12)


def test_sample_holds_whole_documents_within_its_bounds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(AttentionModel, "train", lambda self, x, first, target: seen.append((np.diff(first).tolist(), len(x))) or self)
    long = " ".join(f"w{i}" for i in range(5000))  # 50 passages
    rows = [(0, long), (0, long), (0, "another text"), (2, "a b c"), (3, "d e f"), (4, None)]
    ids = [i for i in (0, 2, 3, 4) if zlib.crc32(str(i).encode()) % 3 != 1]
    docs = spark.createDataFrame([r for r in rows if r[0] in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    texts = {r for r in rows if r[0] in ids}
    sizes = sorted(50 if t == long else 1 for _, t in texts)
    fit(docs, labels)
    fit(docs, labels, max_passages=10)
    fit(docs, labels, max_documents=1)
    assert sorted(seen[0][0]) == sizes
    assert sorted(seen[1][0]) == [n for n in sizes if n == 1] and seen[1][1] <= 10
    assert len(seen[2][0]) == 1
