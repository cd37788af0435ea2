import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import graph as g
from sensorgrid.operators.spectral import spectral_encoding
from sensorgrid.plans.catalog import graphs
from sensorgrid.sources import read_graph
from sensorgrid.staging import checkpoint_root, stage
from tests.helpers import edges, nodes


def _matrix(df, n, value="weight"):
    out = np.zeros((n, n))
    for r in df.collect():
        out[r[0], r[1]] = r[value]
    return out


def _frame(spark, a):
    return stage(
        edges(spark, [(i, j, a[i, j], 1.0) for i in range(len(a)) for j in range(len(a)) if a[i, j]]).coalesce(1), "e"
    )


def _random(seed, n=7, symmetric=True):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random((n, n)) < 0.4, rng.integers(1, 5, (n, n)), 0).astype(float)
    if symmetric:
        a = np.triu(a) + np.triu(a, 1).T
    a[n - 1, :] = a[:, n - 1] = 0  # a node of degree 0
    return a


@pytest.mark.parametrize("symmetric", [True, False])
def test_build_and_normalize(spark, symmetric):
    a = _random(3, symmetric=symmetric)
    n = len(a)
    df, ids = _frame(spark, a), nodes(spark, range(n))
    built = a.copy()
    np.fill_diagonal(built, 1.0)
    if not symmetric:
        built = (built + built.T) / 2
    frame = stage(g.graph_build(df, ids), "built")
    assert np.allclose(_matrix(frame, n), built)
    d = built.sum(1)
    assert np.allclose(_matrix(g.graph_normalize(frame, "symmetric"), n), built / np.sqrt(np.outer(d, d)))
    row = _matrix(g.graph_normalize(frame, "row"), n)
    assert np.allclose(row, built / d[:, None]) and np.allclose(row.sum(1), 1)
    assert np.allclose(_matrix(g.graph_normalize(frame, "none"), n), built)
    plus = a + np.eye(n)
    d = plus.sum(1)
    assert np.allclose(_matrix(g.graph_for_panel(df, ids), n), plus / np.sqrt(np.outer(d, d)))


def test_zero_degree_rules(spark):
    df = edges(spark, [(0, 1, 2, 1)])  # node 1 has no outgoing edge
    one = _matrix(g.graph_normalize(df, "symmetric", "one"), 2)
    zero = _matrix(g.graph_normalize(df, "symmetric", "zero"), 2)
    assert one[0, 1] == pytest.approx(2 / np.sqrt(2)) and zero[0, 1] == 0
    for bad in (("other", "one"), ("row", "other")):
        with pytest.raises(ValueError):
            g.graph_normalize(df, *bad)
    with pytest.raises(ValueError):
        g.graph_build(df, nodes(spark, [0, 1]), self_loops="other")


def test_validate(spark):
    a = _random(5)
    a[0, 0] = 2
    n = len(a)
    got = g.graph_validate(_frame(spark, a), nodes(spark, range(n))).first()
    assert got.symmetric and got.n_nodes == n
    assert got.n_edges == (a > 0).sum() - n
    assert got.without_self_loop == (np.diag(a) == 0).sum()
    assert got.density == pytest.approx(a.mean())
    assert got.sparsity == pytest.approx(1 - got.n_edges / (n * (n - 1)))
    a[0, 1] += 5
    assert not g.graph_validate(_frame(spark, a), nodes(spark, range(n))).first().symmetric


def test_topology_checks(spark):
    df = edges(spark, [(0, 1, 1, 1), (1, 5, 1, 1)])
    with pytest.raises(ValueError):
        g.check_topology(df, nodes(spark, [0, 1]))
    with pytest.raises(ValueError):
        g.check_topology(df, nodes(spark, [0, 1, 5, 5]))
    g.check_topology(df, nodes(spark, [0, 1, 5]))


def test_subgraph_and_alignment(spark):
    df = edges(spark, [(3, 8, 1, 2), (8, 3, 1, 2), (3, 5, 4, 1), (9, 9, 1, 0)])
    all_nodes = nodes(spark, [3, 5, 8, 9])
    index, sub = g.subgraph(df, all_nodes, nodes(spark, [8, 3, 77]))
    assert {(r.node_id, r.pos) for r in index.collect()} == {(3, 0), (8, 1)}
    assert {(r.src_pos, r.dst_pos, r.distance) for r in sub.collect()} == {(0, 1, 2.0), (1, 0, 2.0)}
    with pytest.raises(ValueError):
        g.subgraph(df, all_nodes, nodes(spark, [77]))
    order = spark.createDataFrame([("3", 0), ("77", 1)], "node_id STRING, pos BIGINT")
    with pytest.raises(ValueError):
        g.align_graph(df, all_nodes, order)
    assert {(r.src, r.dst) for r in g.neighbors(df).collect()} == {(3, 8), (8, 3), (3, 5)}


def test_laplacian_and_spectrum(spark):
    n = 12
    a = np.zeros((n, n))
    for i in range(n - 1):
        a[i, i + 1] = a[i + 1, i] = 1 + i % 3
    df, ids = _frame(spark, a), nodes(spark, range(n))
    lap = _matrix(g.laplacian(df, ids), n, "value")
    d = 1 / np.sqrt(a.sum(1) + 1e-8)
    assert np.allclose(lap, np.eye(n) - d[:, None] * a * d[None, :])
    values, encoding = spectral_encoding(df, ids, k=3, oversample=12)
    vectors = np.zeros((n, 3))
    for r in encoding.collect():
        vectors[r.node_id] = [r.pe0, r.pe1, r.pe2]
    assert np.allclose(values, np.linalg.eigvalsh(lap)[1:4], atol=1e-6)
    assert np.abs(lap @ vectors - vectors * np.array(values)).max() < 1e-4
    assert np.allclose(vectors.T @ vectors, np.eye(3), atol=1e-6)


def test_filtered_iteration(spark):
    """The block is smaller than the graph, so the filter has to do the work."""
    n = 40
    a = np.zeros((n, n))
    for i in range(n):
        a[i, (i + 1) % n] = a[(i + 1) % n, i] = 1 + (i * 7) % 5
    df, ids = _frame(spark, a), nodes(spark, range(n))
    values, _ = spectral_encoding(df, ids, k=1, oversample=6, cycles=2, tol=1e-3)
    d = 1 / np.sqrt(a.sum(1))
    want = np.linalg.eigvalsh(np.eye(n) - d[:, None] * a * d[None, :])[1]
    assert values[0] == pytest.approx(want, abs=1e-3)


def test_encoding_of_a_graph_of_many_parts(spark):
    """More parts than vectors in the block: the value 1 fills it, so the filter's cut is next to 1."""
    parts, size = 24, 12
    a = np.zeros((parts * size, parts * size))
    for part in range(parts):
        for i in range(size):
            x, y = part * size + i, part * size + (i + 1) % size
            a[x, y] = a[y, x] = 1 + (i * 5 + part) % 4
    df = _frame(spark, a)
    values, encoding = spectral_encoding(df, nodes(spark, range(len(a))), k=2, oversample=2, cycles=4)
    d = 1 / np.sqrt(a.sum(1))
    scaled = d[:, None] * a * d[None, :]
    vectors = np.zeros((len(a), 2))
    for r in encoding.collect():
        vectors[r.node_id] = [r.pe0, r.pe1]
    assert np.allclose(values, 0, atol=1e-6)
    assert np.linalg.norm(scaled @ vectors - vectors, axis=0).max() < 2e-4


def test_hub_links_are_spread(spark):
    """A hub with most links: the salted join gives the same rows as the plain one."""
    rows = spark.createDataFrame([(s, b) for s in (0, 1) for b in range(50)], "sensor_id BIGINT, bucket BIGINT")
    links = spark.createDataFrame([(0, i) for i in range(1, 40)] + [(1, 0)], "sensor_id BIGINT, neighbor BIGINT")
    salted = g.join_links(rows, links, "sensor_id", "bucket")
    assert salted.count() == salted.distinct().count() == 50 * 39 + 50
    lonely = spark.createDataFrame([(9, 1)], "sensor_id BIGINT, bucket BIGINT")
    assert g.join_links(lonely, links, "sensor_id", "bucket", "left").collect()[0].neighbor is None


@pytest.mark.parametrize("key", ["src", "dst"])
def test_hub_edges_are_dealt_to_copies(spark, key):
    """One node has a third of all edges: same rows as a plain join, and no large task."""
    pairs = {(0, i) for i in range(1, 2001)} | {(i, 1 + (i * 7 + j) % 2000) for i in range(1, 2001) for j in range(2)}
    other = "dst" if key == "src" else "src"
    df = stage(spark.createDataFrame(sorted(pairs), f"{key} BIGINT, {other} BIGINT"), "hub")
    # Node 5 has no value, node 9999 has no edge.
    values = spark.createDataFrame([(i, i * 2) for i in [*range(5), *range(6, 2001), 9999]], f"{key} BIGINT, v BIGINT")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for how in ("inner", "left"):
            joined = g.join_nodes(df, values, key, how, piece=50)
            rows = joined.select(key, other, "v", F.spark_partition_id().alias("task")).collect()
            plain = {(r[key], r[other], r.v) for r in df.join(values, key, how).collect()}
            assert {(r[key], r[other], r.v) for r in rows} == plain and len(rows) == len(plain)
            tasks = np.bincount([r.task for r in rows], minlength=16)
            assert tasks.max() < 3 * np.median(tasks)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert g.join_nodes(df.limit(0), values, key).collect() == []


def test_only_cells_that_are_not_zero_are_joined(spark, tmp_path):
    """Both matrices meet cell by cell, without their zeros; short and missing distance rows are NULL there."""
    doc = {
        "adjacency-matrix": [[0, 1, 2, 3], [4, 0, 0, 5], [0, 0, 6, 7], [8, 0, 0, 9]],
        "distance-matrix": [[0, 0, 1.5, None], [2.5, 0], []],
    }
    (tmp_path / "graph.json").write_text(json.dumps(doc))
    found = read_graph(spark, str(tmp_path))
    got = {(r.src, r.dst): (r.weight, r.distance) for r in found.collect()}
    assert got == {
        (0, 1): (1, 0), (0, 2): (2, 1.5), (0, 3): (3, None), (1, 0): (4, 2.5), (1, 3): (5, None),
        (2, 2): (6, None), (2, 3): (7, None), (3, 0): (8, None), (3, 3): (9, None),
    }
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert any("src" in line and "dst" in line for line in joins)


def test_document_is_written_in_compressed_parts(spark, tmp_path, monkeypatch):
    """All tasks write, and the zeros of a matrix take no room; links are those of the tables."""
    monkeypatch.setattr(graphs, "PART", 200_000)
    n, at = 400, str(tmp_path)
    spark.range(n).select(F.col("id").alias("s_suppkey")).write.parquet(f"{at}/supplier.parquet")
    key = F.col("id")
    rows = spark.range(1500).select(
        F.when(key % 9 == 0, 7).otherwise(key * key % 391).cast("bigint").alias("l_suppkey"), (key * 31 % 2003).alias("l_partkey"),
        (key % 7).cast("int").alias("l_linenumber"), F.when(key % 10 > 0, key % 50 / 4).alias("l_quantity"),
    )
    rows.write.parquet(f"{at}/lineitem.parquet")
    root, known = checkpoint_root(spark), set(glob.glob(f"{checkpoint_root(spark)}/sensorgrid/document-*"))
    got = {(r.src, r.dst): (r.weight, r.distance) for r in graphs.graph_document_file(spark, at).collect()}
    want = {}
    for r in rows.collect():
        weight, distance = want.get(link := (r.l_suppkey, (r.l_partkey + 3 * r.l_linenumber) % n), (0, 0))
        want[link] = (weight + 1, distance + (r.l_quantity or 0))
    assert got == want
    (folder,) = set(glob.glob(f"{root}/sensorgrid/document-*")) - known
    parts = sorted(glob.glob(f"{folder}/part-*"))
    document = json.loads("".join(row.value for part in parts for row in spark.read.text(part).collect()))
    assert [len(row) for name in ("adjacency-matrix", "distance-matrix") for row in document[name]] == [n] * (2 * n)
    assert len(parts) == 4 and sum(map(os.path.getsize, parts)) < n * n * 4 / 10


def test_document_without_suppliers(spark, tmp_path):
    spark.range(0).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(3).select(
        F.col("id").alias("l_suppkey"), F.col("id").alias("l_partkey"), F.lit(1).alias("l_linenumber"), F.lit(1.0).alias("l_quantity")
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    with pytest.raises(ValueError, match="no adjacency-matrix"):
        graphs.graph_document_file(spark, str(tmp_path))
