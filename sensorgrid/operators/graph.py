"""Sensor graphs as sparse edge tables ``edges(src, dst, weight, distance)``.

Absent pairs have weight 0 and ``(src, dst)`` is unique.  ``nodes(node_id)`` lists all nodes,
with or without edges.  No N x N array is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.operators.indexing import dense_position

# Tolerances of the symmetry test: |a - b| <= ATOL + RTOL * |b|.
ATOL = 1e-6
RTOL = 1e-5
# A node is a hub if it has more than PIECE edges and more than 1 / HUBS of all edges.
PIECE, HUBS = 100_000, 1000


def neighbors(edges: DataFrame) -> DataFrame:
    """Edges with positive weight, without self-loops."""
    return edges.where("weight > 0 AND src <> dst")


def join_links(
    rows: DataFrame, links: DataFrame, key: str, spread: str, how: str = "inner", salts: int = 8
) -> DataFrame:
    """``rows`` joined to a link table on ``key``.

    A hub may hold a large share of all links, and its rows would meet them in one task; so
    its rows are spread over ``salts`` parts by the column ``spread``.  The link table, which
    is small beside the rows, is repeated once per part.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = links.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def join_nodes(
    edges: DataFrame, values: DataFrame, key: str, how: str = "inner", piece: int = PIECE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``edges`` joined on ``key`` (src or dst) with a table of one row per node.

    The edges of a hub are dealt to as many copies of its row as it has pieces of edges; all
    other nodes are joined plainly.  Edges are counted before the shuffle, and what is broadcast
    are the hubs, fewer than ``HUBS`` rows.  ``counted`` is the table the edges come from, if
    they are the result of a join that need not run again for the counts.
    """
    counts = (edges if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    share = counts.agg((F.sum("_n") / HUBS).alias("share")).scalar()
    most = F.greatest(share, F.lit(float(piece)))
    hubs = F.broadcast(
        counts.where(F.col("_n") > most).select(key, F.ceil(F.col("_n") / most).cast("int").alias("_copies"))
    )
    copies = F.coalesce("_copies", F.lit(1))
    dealt = edges.join(hubs, key, "left").withColumn("_copy", F.pmod(F.xxhash64("src", "dst"), copies).cast("int"))
    rows = values.join(hubs, key, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.drop("_copies").join(rows.drop("_copies"), [key, "_copy"], how).drop("_copy")


def has_node(candidates: DataFrame, nodes: DataFrame, key: str = "node_id") -> DataFrame:
    """The candidates that are nodes of the graph."""
    return candidates.join(nodes.select(F.col("node_id").alias(key)), key, "left_semi")


def graph_nodes(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()
    )


def _pairs(edges: DataFrame) -> DataFrame:
    """``lo, hi, up, down``: both directions of every linked pair, from one shuffle."""
    off = edges.where("src <> dst")
    forward = F.col("src") < F.col("dst")
    return off.groupBy(
        F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")
    ).agg(
        F.coalesce(F.sum(F.when(forward, F.col("weight"))), F.lit(0.0)).alias("up"),
        F.coalesce(F.sum(F.when(~forward, F.col("weight"))), F.lit(0.0)).alias("down"),
    )


def _asymmetric() -> Column:
    gap = F.abs(F.col("up") - F.col("down"))
    return (gap > ATOL + RTOL * F.abs("up")) | (gap > ATOL + RTOL * F.abs("down"))


def is_symmetric(edges: DataFrame) -> Column:
    """Scalar subquery: True if no pair differs by more than the tolerance."""
    return _pairs(edges).agg((F.count_if(_asymmetric()) == 0).alias("ok")).scalar()


def graph_validate(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row: ``n_nodes, symmetric, without_self_loop, n_edges, sparsity, density``.

    ``n_edges`` is the number of positive weights minus the number of nodes, which is the
    off-diagonal count when every node has a self-loop.
    """
    stats = edges.agg(
        F.count_if(F.col("weight") > 0).alias("positive"),
        F.count_if((F.col("src") == F.col("dst")) & (F.col("weight") > 0)).alias("loops"),
        F.coalesce(F.sum("weight"), F.lit(0.0)).alias("total"),
    )
    n = F.col("n_nodes")
    possible = n * (n - 1)
    return stats.select(
        nodes.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_nodes"),
        is_symmetric(edges).alias("symmetric"),
        "positive",
        "loops",
        "total",
    ).select(
        "n_nodes",
        "symmetric",
        (n - F.col("loops")).alias("without_self_loop"),
        (F.col("positive") - n).alias("n_edges"),
        F.when(possible > 0, 1.0 - (F.col("positive") - n) / possible)
        .otherwise(0.0)
        .alias("sparsity"),
        F.try_divide(F.col("total"), n * n).alias("density"),
    )


def check_topology(edges: DataFrame, nodes: DataFrame) -> None:
    """Raises if node ids repeat or an edge ends outside the node table (runs jobs)."""
    if nodes.groupBy("node_id").count().where("count > 1").limit(1).count():
        raise ValueError("node ids are not unique")
    if graph_nodes(edges).join(nodes, "node_id", "left_anti").limit(1).count():
        raise ValueError("edge end outside the node table")


def graph_build(
    edges: DataFrame, nodes: DataFrame, self_loops: str = "set", symmetrize: bool = True
) -> DataFrame:
    """Adjacency ready for normalisation: ``src, dst, weight``.

    ``self_loops``: ``set`` puts 1 on the diagonal, ``add`` adds 1 to it, ``none`` keeps it.
    An asymmetric graph becomes ``(A + A^T) / 2``; a symmetric one is left as it is.
    """
    loops = edges.where("src = dst").select("src", "dst", "weight")
    ones = nodes.select(
        F.col("node_id").alias("src"), F.col("node_id").alias("dst"), F.lit(1.0).alias("weight")
    )
    if self_loops == "set":
        diagonal = ones
    elif self_loops == "add":
        diagonal = loops.unionByName(ones).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    elif self_loops == "none":
        diagonal = loops
    else:
        raise ValueError(f"unknown self-loop rule: {self_loops}")
    if not symmetrize:
        return edges.where("src <> dst").select("src", "dst", "weight").unionByName(diagonal)
    half = (F.col("up") + F.col("down")) / 2.0
    keep = is_symmetric(edges)
    both = F.array(
        F.struct(
            F.col("lo").alias("src"),
            F.col("hi").alias("dst"),
            F.when(keep, F.col("up")).otherwise(half).alias("weight"),
        ),
        F.struct(
            F.col("hi").alias("src"),
            F.col("lo").alias("dst"),
            F.when(keep, F.col("down")).otherwise(half).alias("weight"),
        ),
    )
    off = _pairs(edges).select(F.inline(both)).where("weight <> 0")
    return off.unionByName(diagonal)


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.sum("weight").alias("degree")).withColumnRenamed("src", "node_id")


def graph_normalize(edges: DataFrame, method: str = "symmetric", zero_degree: str = "one") -> DataFrame:
    """``D^-1/2 A D^-1/2`` (symmetric), ``D^-1 A`` (row) or A itself (none).

    A node of degree 0 counts as degree 1 (``one``) or drops out (``zero``).
    """
    if method == "none":
        return edges.select("src", "dst", "weight")
    if method not in ("symmetric", "row"):
        raise ValueError(f"unknown normalization: {method}")
    if zero_degree not in ("one", "zero"):
        raise ValueError(f"unknown zero-degree rule: {zero_degree}")
    if zero_degree == "one":
        value = F.when(F.coalesce(F.col("degree"), F.lit(0.0)) == 0, 1.0).otherwise(F.col("degree"))
    else:
        value = F.nullif(F.coalesce(F.col("degree"), F.lit(0.0)), F.lit(0.0))
    deg = degrees(edges)
    left = join_nodes(edges, deg.withColumnRenamed("node_id", "src"), "src", "left").withColumn("ds", value)
    if method == "row":
        scaled = left.select("src", "dst", (F.lit(1.0) / F.col("ds") * F.col("weight")).alias("weight"))
    else:
        scaled = (
            join_nodes(left.drop("degree"), deg.withColumnRenamed("node_id", "dst"), "dst", "left", counted=edges)
            .withColumn("dd", value)
            .select(
                "src",
                "dst",
                (F.lit(1.0) / F.sqrt("ds") * F.col("weight") * (F.lit(1.0) / F.sqrt("dd"))).alias("weight"),
            )
        )
    return scaled.withColumn("weight", F.coalesce("weight", F.lit(0.0)))


def graph_for_panel(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``D^-1/2 (A + I) D^-1/2`` with isolated rows at 0: the matrix written beside a panel."""
    built = graph_build(edges, nodes, self_loops="add", symmetrize=False)
    return graph_normalize(built, "symmetric", zero_degree="zero")


def graph_diagnostics(normalized: DataFrame, nodes: DataFrame, expected_nodes: int | None = None) -> DataFrame:
    """One row of checks on a normalised graph."""
    n = nodes.agg(F.count(F.lit(1)).alias("n")).scalar()
    stats = normalized.agg(
        F.count_if(F.col("weight") != 0).alias("nonzero"),
        (F.count_if(F.isnan("weight")) > 0).alias("has_nan"),
        F.sum(F.when(F.col("src") == F.col("dst"), F.col("weight"))).alias("trace"),
    )
    expected = F.lit(None).cast("boolean") if expected_nodes is None else n == expected_nodes
    return stats.select(
        n.alias("n_nodes"),
        nodes.agg(F.min("node_id").alias("v")).scalar().alias("first_id"),
        nodes.agg(F.max("node_id").alias("v")).scalar().alias("last_id"),
        (n - 1).alias("last_pos"),
        is_symmetric(normalized).alias("symmetric"),
        "has_nan",
        (1.0 - F.col("nonzero") / (n * n)).alias("sparsity"),
        F.coalesce("trace", F.lit(0.0)).alias("trace"),
        expected.alias("expected_nodes"),
    )


def subgraph(edges: DataFrame, nodes: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Graph restricted to the nodes in ``keep``, re-indexed by ascending id.

    Returns ``(nodes(node_id, pos), edges(src, dst, weight, distance, src_pos, dst_pos))``.
    Raises if no requested node is in the graph (runs a job).
    """
    common = nodes.select("node_id").intersect(keep.select("node_id"))
    if common.limit(1).count() == 0:
        raise ValueError("no valid nodes to filter")
    index = dense_position(common, ["node_id"])
    src = index.select(F.col("node_id").alias("src"), F.col("pos").alias("src_pos"))
    dst = index.select(F.col("node_id").alias("dst"), F.col("pos").alias("dst_pos"))
    return index, join_nodes(join_nodes(edges, src, "src"), dst, "dst", counted=edges).select(
        "src", "dst", "weight", "distance", "src_pos", "dst_pos"
    )


def align_graph(edges: DataFrame, nodes: DataFrame, order: DataFrame, check: bool = True) -> DataFrame:
    """Edges in panel order: ``src_pos, dst_pos, src, dst, weight``.

    ``order(node_id STRING, pos)`` is the panel's sensor order.  Raises if a sensor is not a
    node of the graph (runs a job).
    """
    ids = order.select(F.col("node_id").cast("bigint").alias("node_id"), "pos")
    if check and ids.join(nodes, "node_id", "left_anti").limit(1).count():
        raise ValueError("graph is missing a sensor of the panel")
    src = ids.select(F.col("node_id").alias("src"), F.col("pos").alias("src_pos"))
    dst = ids.select(F.col("node_id").alias("dst"), F.col("pos").alias("dst_pos"))
    return join_nodes(join_nodes(edges, src, "src"), dst, "dst", counted=edges).select("src_pos", "dst_pos", "src", "dst", "weight")


def alignment_preview(order: DataFrame, n: int = 5) -> DataFrame:
    return order.orderBy("pos").limit(n)


def node_consistency(**node_sets: DataFrame) -> DataFrame:
    """``node_id, in_<name>...`` for every node of any set: one union and one aggregate."""
    tagged = None
    for name, nodes in node_sets.items():
        rows = nodes.select(
            F.col("node_id").cast("string").alias("node_id"), F.lit(name).alias("where")
        )
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.groupBy("node_id").agg(
        *[F.bool_or(F.col("where") == name).alias(f"in_{name}") for name in node_sets]
    )


def laplacian(edges: DataFrame, nodes: DataFrame, eps: float = 1e-8) -> DataFrame:
    """``I - D^-1/2 A D^-1/2`` as ``src, dst, value``, with ``eps`` added to each degree."""
    scaled = scaled_adjacency(edges, eps)
    off = scaled.select("src", "dst", (-F.col("s")).alias("value"))
    ones = nodes.select(
        F.col("node_id").alias("src"), F.col("node_id").alias("dst"), F.lit(1.0).alias("value")
    )
    return off.unionByName(ones).groupBy("src", "dst").agg(F.sum("value").alias("value"))


def scaled_adjacency(edges: DataFrame, eps: float = 1e-8) -> DataFrame:
    deg = degrees(edges)
    root = F.lit(1.0) / F.sqrt(F.coalesce(F.col("degree"), F.lit(0.0)) + F.lit(eps))
    left = join_nodes(edges, deg.withColumnRenamed("node_id", "src"), "src", "left").select(
        "src", "dst", (root * F.col("weight")).alias("w")
    )
    return join_nodes(left, deg.withColumnRenamed("node_id", "dst"), "dst", "left", counted=edges).select(
        "src", "dst", (F.col("w") * root).alias("s")
    )
