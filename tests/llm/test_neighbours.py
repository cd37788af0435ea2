import numpy as np
from pyspark.sql import functions as F

from sensorgrid.llm import neighbours
from sensorgrid.llm.neighbours import Graph, nearest

KIND = "vec_id long, embedding array<float>, score int"


def brute(rows, asked, k):
    out = {}
    sound = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for q, v in sound:
        if q in asked:
            found = [
                (-float((v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum()))), i)
                for i, w in sound if i != q and len(w) == len(v)
            ]
            out[q] = [(i, round(-s, 9)) for s, i in sorted(found)[:k]]
    return out


def test_recall_on_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = {}
    for r in nearest(rows, rows.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    plain = [(r.vec_id, r.embedding) for r in rows.collect()]
    want = brute(plain, {i for i, _ in plain if i % 50 == 0}, 5)
    hits = sum(len({i for i, _ in w} & set(got[q])) for q, w in want.items())
    assert hits / sum(map(len, want.values())) >= 0.95


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_POINTS", 150)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    plain = [(i, (centres[i % 12] + rng.normal(size=16) * 0.4).astype(np.float32).tolist()) for i in range(900)]
    df = spark.createDataFrame([(i, v, 0) for i, v in plain], KIND)
    want = brute(plain, set(range(0, 900, 20)), 5)
    got = {}
    for r in nearest(df, df.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = sum(len({i for i, _ in w} & set(got[q])) for q, w in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_ties_and_defined_cases(spark):
    copies = [(i, [1.0, 0.0]) for i in range(20, 0, -1)]
    others = [(30, [2.0, 0.0]), (31, [0.0, 1.0]), (32, None), (33, [0.0, 0.0]), (34, [1.0, None]), (35, [1.0, float("nan")]),
              (36, [float("inf"), 0.0]), (None, [1.0, 0.0]), (37, [1.0, 2.0, 3.0]), (38, [3.0, 2.0, 1.0]), (39, [])]
    rows = copies + others + copies[:3]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)
    out = {}
    for r in nearest(df, df.where("vec_id in (2, 31, 33, 37)")).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    assert out[2] == [(i, 1.0) for i in (1, 3, 4, 5, 6)]
    assert out[31] == [(i, 0.0) for i in (1, 2, 3, 4, 5)]
    assert [i for i, _ in out[37]] == [38] and 33 not in out
    assert nearest(df.limit(0), df.limit(0)).collect() == []
    assert nearest(df, df.where(F.lit(False))).collect() == []


def test_graph_reaches_all_points():
    x = np.random.default_rng(2).normal(size=(300, 8))
    graph = Graph.build(x, 1)
    assert len(graph.levels) > 1
    found = graph.search(graph.unit, 64)
    assert (found[:, 0] == np.arange(300)).mean() > 0.99


def test_every_point_is_on_a_list():
    rng = np.random.default_rng(3)
    # Hubs: all points lie around few centres, whose own lists are full of nearer points.
    x = np.concatenate([rng.normal(size=(2000, 48)), rng.normal(size=(200, 48)) * 0.05 + 1])
    graph = Graph.build(x, 1)
    for points, ties in graph.levels:
        if len(points) > 1:
            assert set(ties[ties >= 0].tolist()) == set(range(len(points)))


def test_long_vectors_make_smaller_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_BYTES", 40 * 16 * 8)
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, rng.normal(size=16).tolist(), 0) for i in range(200)], KIND)
    index, shards = neighbours.build_index(df.selectExpr("vec_id", "transform(embedding, x -> cast(x as double)) v"), 5)
    assert [r.shards for r in shards.collect()] == [5] and index.count() == 5
