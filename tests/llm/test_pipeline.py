import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from sensorgrid.llm.queries import TOKENIZER
from tests.llm.test_linededup import brute as line_brute
from tests.llm.test_neardup import brute as near_brute

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(f"{rng.choice(['the', 'of', 'and'])} word{rng.integers(3000)}" for _ in range(n)) + "."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Good and bad documents, copies, shared lines, passages of test items."""
    rng = np.random.default_rng(8)
    path = str(tmp_path_factory.mktemp("sf"))
    items = [(i, prose(rng, 15)) for i in range(5)]
    shared = [prose(rng, 6) for _ in range(4)]
    rows = []
    for i in range(90):
        if i % 5 == 4:
            text = " ".join(f"WIN{rng.integers(99)}!!! $$$" for _ in range(80))
        else:
            text = "\n".join(prose(rng, 40) for _ in range(4))
        if i % 7 == 0:
            text += "\n" + shared[i % 4]
        if i in (8, 16):
            text += " " + items[i % 5][1]
        rows.append((i, text, "en", "s", len(text)))
    for i in (0, 1, 2, 3):  # near copies: a few words changed in every line
        rows.append((200 + i, rows[i][1].replace(" of word", " of other", 1).replace("\n", " extra\n") + " extra", "en", "s", 1))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0), (None, prose(rng, 30), "en", "s", 3)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 5 != 4), 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, items


def test_stages_like_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "near duplicates", "benchmark decontamination", "best-fit packing"
    ]
    good, lines, near, unseen, pack = (f for _, f in corpus_pipeline.STAGES)

    def held(df):
        return sorted(((r.doc_id, r.text or "") for r in df.collect()), key=str)

    stage = good(spark, docs, path)
    assert stage.columns == docs.columns
    now = held(stage)
    assert {i for i, _ in now if i is not None and i < 200} == {i for i in range(90) if i % 5 != 4}

    stage = spark.createDataFrame(stage.collect(), KIND)
    stage = lines(spark, stage, path)
    now = sorted(((i, t) for i, _, _, t in line_brute(now)), key=str)
    assert stage.columns == docs.columns and held(stage) == now
    assert all(r.n_chars == len(r.text) for r in stage.collect())

    stage = near(spark, stage, path)
    groups = near_brute(now, 5, 80)
    now = [(i, t) for i, t in now if i is None or groups[i] == i]
    assert any(groups[i] != i for i in groups) and stage.columns == docs.columns and held(stage) == now

    stage = unseen(spark, stage, path)
    now = [(i, t) for i, t in now if not any(x in t for _, x in items)]
    assert stage.columns == docs.columns and held(stage) == now

    plain, want = Tokenizer.from_file(TOKENIZER), []
    for i, text in now:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want += [(i, n, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for n, s in enumerate(range(0, len(ids), 4096))]
    got = [(r.doc_id, r.piece, r.length, r.ids_crc32) for r in pack(spark, stage, path).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_run(spark, folder):
    path, _, _ = folder
    out = corpus_pipeline.run(spark, path).collect()
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert out and max(filled.values()) <= 4096


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    empty = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, empty, path).collect() == [], name


def test_columns_named_like_results_are_carried(spark, folder):
    path, rows, _ = folder
    docs = spark.createDataFrame(
        [(*r, 0.25, i, "x", 7) for i, r in enumerate(rows)], KIND + ", Score double, n_lines long, n_dropped string, given_score int"
    )
    for _, apply in corpus_pipeline.STAGES[:4]:
        out = apply(spark, docs, path)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    got = docs.collect()
    number = {(r[0]): i for i, r in enumerate(rows)}
    assert len(got) > 20 and all((r.Score, r.n_lines, r.n_dropped, r.given_score) == (0.25, number[r.doc_id], "x", 7) for r in got)


def test_empty_tables_pass_through(spark, folder, tmp_path):
    path, rows, items = folder
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    # Without labels every score is 0.5, without test items nothing is found: all documents stay.
    docs = spark.read.parquet(f"{path}/documents.parquet")
    good, _, _, unseen, _ = (f for _, f in corpus_pipeline.STAGES)
    assert good(spark, docs, str(tmp_path)).count() == unseen(spark, docs, str(tmp_path)).count() == len(rows)
