import hypothesis.strategies as st
import numpy as np
from hypothesis import given, settings
from pyspark.sql import functions as F

from sensorgrid.llm import linededup
from sensorgrid.llm.linededup import PerfectHash, Shard, drop_repeated_lines, pack_shard

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    line = line.strip(SPACE)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line) if len(line) >= 10 else None


def brute(rows):
    first, last = {}, {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and key(line):
                first[key(line)] = min(first.get(key(line), i), i)
                last[key(line)] = max(last.get(key(line), i), i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or not key(x) or first[key(x)] == last[key(x)] or first[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@settings(max_examples=50, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=300))
def test_perfect_hash(pairs):
    keys = np.array(sorted(pairs), np.uint64).reshape(-1, 2)
    assert sorted(PerfectHash.build(keys).index(keys).tolist()) == list(range(len(keys)))
    if len(keys):
        n = np.arange(len(keys))
        shard = Shard(pack_shard(keys, n + 1, n * 7))
        count, first = shard.probe(keys)
        assert (count == n + 1).all() and (first == n * 7).all()


def test_like_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    pool = [f"Line number {i} of the pool" for i in range(40)] + ["short", "", "  É a line with accents ", "é a line with accents"]
    rows = [(int(i), "\n".join(rng.choice(pool, rng.integers(0, 9)))) for i in rng.permutation(120)]
    rows += [(500, None), (501, ""), (None, pool[0]), (None, pool[0]), (3, pool[1] + "\n" + pool[1]), (502, "\t line NUMBER 1 of the pool\r")]
    for share in (1000, 1):  # without and with shards of several copies
        monkeypatch.setattr(linededup, "SHARE", share)
        df = spark.createDataFrame([(9, *r, "x") for r in rows], "n_lines int, doc_id long, text string, lost_id string")
        out = drop_repeated_lines(df)
        assert out.columns == ["doc_id", "text", "lost_id", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_frequent_line_goes_to_copies_of_its_shard(spark):
    rows = [(i, f"this line is in every document\nonly number {i} holds this line") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index, split, shards = linededup.line_index(
        df.select(F.xxhash64(F.lit("a")).alias("h1"), F.lit(1).cast("long").alias("h2"), F.col("doc_id").alias("id"))
        .unionAll(df.select(F.xxhash64("text").alias("h1"), F.lit(2).cast("long").alias("h2"), F.col("doc_id").alias("id")))
    )
    probes = {r.shard: r.probes for r in index.collect()}
    copies = {r.shard: r.copies for r in split.collect()}
    assert sum(probes.values()) == 800 and copies
    most = linededup.SHARE * 800 / shards
    assert all(n / copies.get(shard, 1) <= most for shard, n in probes.items())
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in drop_repeated_lines(df).collect()), key=str) == brute(rows)
