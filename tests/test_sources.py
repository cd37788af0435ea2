import gzip
import json
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensorgrid import sinks, sources
from sensorgrid.operators.panel import wide_panel
from sensorgrid.sources.history import read_documents
from tests.helpers import at, utc


def _docs(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value STRING")


def test_history_files(spark, tmp_path):
    doc = {"2024-01-01": {"12345": {"sensor_1704067200000.txt": {"count": 50}, "sensor_1704067500000.txt": {"count": 30}}}}
    (tmp_path / "day.json").write_text(json.dumps(doc, indent=1))
    got = sources.read_history(spark, str(tmp_path)).collect()
    assert sum(r["count"] for r in got) == 80 and {utc(r.ts) for r in got} == {at(0), at(5)}
    assert {r.sensor_id for r in got} == {12345}
    assert read_documents(spark, str(tmp_path)).count() == 1


def test_history_edges(spark):
    doc = {"d": {"1": {"x_1704067200000.txt": {}, "bad.txt": {"count": 9}}, "s": {"y_1704067200000.txt": {"count": 4}},
                 "node_007": {"z_1704067200000.txt": {"count": 3}}}}
    got = {(r.sensor_id, r["count"]) for r in sources.flatten_history(_docs(spark, doc, "not json")).collect()}
    assert got == {(1, 0.0), (7, 3.0)}
    bad = sources.history_rejects(_docs(spark, doc, "not json")).collect()
    assert {(r.sensor, r.filename, r.reason) for r in bad} == {
        ("1", "bad.txt", "no time in the file name"), ("s", "y_1704067200000.txt", "no sensor"), (None, None, "document is not an object")
    }


def test_history_rejects(spark):
    """One bad part costs that part alone; a cut off document is reported."""
    good = {"y_1704067200000.txt": {"count": 4}}
    docs = _docs(
        spark,
        {"d": {"1": good, "2": {"a.txt": {"count": 1}, "b_1704067200000.txt": 7}, "3": [1]}, "e": 5, "f": {}},
        {"d": {"1": {"y_1704067200000.txt": {"count": "x"}, "z_1704067200000.txt": {"count": None}}}},
        json.dumps({"d": {"1": good}})[:-1], "[]", "5", "",
    )
    got = sorted((r.sensor_id, r["count"], r.tie) for r in sources.flatten_history(docs).collect())
    assert got == [(1, 0.0, "z_1704067200000.txt"), (1, 4.0, "y_1704067200000.txt")]
    bad = sorted((r.date or "", r.sensor or "", r.filename or "", r.reason) for r in sources.history_rejects(docs).collect())
    assert bad == [("", "", "", "document is not an object")] * 4 + [
        ("d", "1", "y_1704067200000.txt", "count is not a number"),
        ("d", "2", "a.txt", "no time in the file name"),
        ("d", "2", "b_1704067200000.txt", "record is not an object"),
        ("d", "3", "", "sensor is not an object"),
        ("e", "", "", "date is not an object"),
    ]


def _random_document(rng):
    """Records of all kinds, some with objects and braces inside, and parts of other shapes."""
    def record(i):
        return rng.choice([
            {"count": i}, {"count": i, "timestamp": [7, 30]}, {}, {"count": None, "note": 'a}{"\\'}, {"more": {"a": [{}, {"b": {}}]}, "count": i},
            {"count": "many"}, 7, [1, {"count": 2}], None, "text }", {"count": i, "é}": "ü" * 40},
        ])

    def sensor(s):
        files = {f"f{i}_{1704067200000 + 1000 * i}.txt" if i % 9 else f"f{i}": record(i) for i in range(rng.randrange(40))}
        return rng.choice([files, files, files, {}, 5, [{}], None])

    days = {}
    for d in range(rng.randrange(1, 6)):
        days[f"2024-01-0{d + 1}"] = rng.choice([{str(s): sensor(s) for s in range(rng.randrange(12))}] * 6 + [3, [], {}])
    return days


@pytest.mark.parametrize("size, many", [("400", 3), ("4000", 12), ("20000", 30)])
def test_files_in_byte_ranges(spark, tmp_path, size, many):
    """Any range size gives the rows and rejects of documents that are parsed in one piece."""
    rng = random.Random(size)
    texts = []
    for i in range(many):
        doc = _random_document(rng)
        text = json.dumps(doc, indent=rng.choice([None, None, 1]), ensure_ascii=bool(i % 2)) + rng.choice(["", "", "\n", " \n\n"])
        texts.append(text[: rng.randrange(len(text) - 1)] if i % 8 == 0 else text)
    texts += ["[]", "5", '[{"a": 1}]', "{", "{}", '{"2024-01-01": {"1": {"a}b_1704067200000.txt": {"count": 8}, "c_1704067200001.txt": {"count": 1}}}}']
    texts += [json.dumps({"2024-01-01": {"1": {f"a}}b{i}_{1704067200000 + i}.txt": {"count": i} for i in range(60)}}})]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = Counter(map(tuple, sources.read_history(spark, str(tmp_path)).select("ts", "sensor_id", "count", "tie").collect()))
        bad = Counter(map(tuple, sources.read_history_rejects(spark, str(tmp_path)).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    docs = _docs(spark, *[t for t in texts if t])
    assert got == Counter(map(tuple, sources.flatten_history(docs).select("ts", "sensor_id", "count", "tie").collect()))
    assert bad == Counter(map(tuple, sources.history_rejects(docs).collect()))
    assert len(got) > 7 * many and len(bad) > many


def test_one_file_many_tasks(spark, tmp_path):
    doc = {f"2024-01-{d:02d}": {str(s): {f"x_{1704067200000 + 1000 * i}.txt": {"count": i} for i in range(50)} for s in range(20)} for d in range(1, 21)}
    (tmp_path / "all.json").write_text(json.dumps(doc))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = sources.read_history(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in rows.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(per_task) == 20_000 and len(per_task) >= 6 and max(per_task) < 6000


def test_borders_inside_strings(spark, tmp_path):
    """Most braces lie in keys and strings, so most ranges begin in one; still no task reads it all."""
    doc = {
        f"2024-01-{d:02d}": {
            f"{{}}}}{s}" if s % 5 == 0 else str(s): {
                f'a}}}}\\"}},{{{i}_{1704067200000 + i}.txt': {"x}": "}\"}:{" * (i % 7), "count": i, "l": ["}", {"}}": "}"}]} for i in range(40)
            } for s in range(20)
        } for d in range(1, 11)
    }
    (tmp_path / "all.json").write_text(json.dumps(doc))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = sources.read_history(spark, str(tmp_path))
        got = Counter(map(tuple, rows.select("ts", "sensor_id", "count", "tie").collect()))
        bad = Counter(r.sensor for r in sources.read_history_rejects(spark, str(tmp_path)).collect())
        per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    docs = _docs(spark, json.dumps(doc))
    assert got == Counter(map(tuple, sources.flatten_history(docs).select("ts", "sensor_id", "count", "tie").collect()))
    assert sum(got.values()) == 10 * 16 * 40 and bad == {f"{{}}}}{s}": 400 for s in (0, 5, 10, 15)}
    assert len(per_task) > 20 and max(per_task) < 1000


def test_only_files_of_the_dates_are_read(spark, tmp_path):
    for day in range(1, 8):
        folder = tmp_path / f"dump_date=2024-01-0{day}"
        folder.mkdir()
        (folder / "part.json").write_text(json.dumps({"sensor_id": day, "count": 1, "ts": 1704067200000}))
        (folder / "history.json").write_text("{}")
    (tmp_path / "undated.json").write_text(json.dumps({"sensor_id": 99, "count": 1, "ts": 1704067200000}))

    def files_read(df):
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = df._jdf.queryExecution().executedPlan().collectLeaves()
        return rows, plan, scans.apply(0).metrics().apply("numFiles").value()

    read = sources.read_archive(spark, str(tmp_path), "{part,undated}.json", since=date(2024, 1, 3), until=date(2024, 1, 4))
    rows, _, files = files_read(read)
    assert {r.sensor_id for r in rows} == {"3", "4", "99"} and files == 3
    docs = read_documents(spark, str(tmp_path), since=date(2024, 1, 6))
    assert files_read(docs)[2] == 5


def test_strict_records(spark):
    files = {
        "a_1704067200000.txt": {"count": 1, "timestamp": [7, 0]},
        "b_1704067200000.txt": {"count": 2, "timestamp": [7]},
        "c_1704067200000.txt": {"count": 3},
        "d.txt": {"count": 4, "timestamp": [7, 0]},
        "e_1704067200000_x.txt": {"timestamp": [9, 30]},
    }
    docs = _docs(spark, {"2024-01-01": {"5": files}})
    got = {r.filename[0]: r for r in sources.flatten_strict(docs, "+07:00").collect()}
    assert got.keys() == {"a", "e"}
    assert got["a"].datetime == "2024-01-01 07:00:00" and got["a"].hour == 7
    assert got["e"]["count"] is None and got["e"].minute == 30
    marked = sources.flatten_strict(docs, "+07:00", keep_skipped=True)
    assert marked.where("NOT ok").count() == 3


def test_archive_files(spark, tmp_path):
    day = tmp_path / "2024-01-01"
    day.mkdir()
    good = [
        {"sensor_id": "node_007", "count": 3, "ts": 1704067200000, "extra": 1, "kafka_offset": 5},
        {"sensor_id": 8, "count": "x", "ts": 1704067200000},
    ]
    (day / "kafka-dump-2024-01-01.json").write_text("\n".join(map(json.dumps, good)) + "\nbroken\n")
    (day / "kafka-dump-2024-01-02.json").write_text("")
    (day / "kafka-dump-x.json").write_text("broken first\n{}\n")
    (day / "blank-2024-01-03.json").write_text("\n{}\n")
    (day / "other.txt").write_text("{}")
    raw = sources.read_archive(spark, str(tmp_path), "*.json")
    assert raw.where("_corrupt IS NOT NULL").count() >= 2
    rows = {r.sensor_id: r for r in sources.as_readings(raw.where("ts IS NOT NULL")).collect()}
    assert rows[7]["count"] == 3.0 and rows[7].seq == 5 and rows[8]["count"] is None and rows[8].seq == -1
    # The empty file of January 2nd is not listed at all.
    valid = {r.file_name: r.valid for r in sources.validate_files(spark, str(tmp_path), "*.json").collect()}
    assert valid == {
        "kafka-dump-2024-01-01.json": True,
        "kafka-dump-x.json": False,
        "blank-2024-01-03.json": True,
    }
    files = sources.archive_files(spark, str(tmp_path))
    assert [r.file_name for r in sources.select_by_date(files, date(2024, 1, 1)).collect()] == ["kafka-dump-2024-01-01.json"]
    assert [r.file_name for r in sources.select_by_date(files, date(2024, 1, 3)).collect()] == ["blank-2024-01-03.json"]
    checked = sources.validate_files(spark, str(tmp_path), "*.json")
    lines = spark.read.option("recursiveFileLookup", True).text(str(tmp_path)).select(
        F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("path"), "value"
    )
    target = str(tmp_path / "landed")
    for _ in range(2):  # a retry replaces what it landed
        assert sinks.land_archives(lines, checked, target) == 2
    landed = spark.read.text(target)
    assert {(str(r.dump_date), r.n) for r in landed.groupBy("dump_date").agg(F.count("*").alias("n")).collect()} == {
        ("2024-01-01", 3), ("unknown", 2),
    }
    with pytest.raises(ValueError):
        sinks.land_archives(lines, checked.where("NOT valid"), target)
    keys = spark.createDataFrame([("kafka-dump-2024-02-30.json",), ("kafka-dump-2024-02-29.json",)], "f STRING")
    assert [r[0] for r in keys.select(sinks.partition_key(F.col("f"))).collect()] == ["unknown", "2024-02-29"]


def test_empty_readings(spark):
    empty = sources.empty_readings(spark)
    assert empty.count() == 0 and empty.columns == ["ts", "sensor_id", "count", "source", "seq", "tie"]


def test_landing_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "sub" / "b.weird").write_text("12345")
    got = {r.rel_path: r for r in sinks.landing_manifest(spark, str(tmp_path), "/raw/").collect()}
    assert got["a.json"].key == "raw/a.json" and got["a.json"].content_type == "application/json"
    assert got["sub/b.weird"].size == 5 and got["sub/b.weird"].content_type == "application/octet-stream"


def test_graph_documents(spark, tmp_path):
    doc = {
        "adjacency-matrix": [[1, 1], [1, 1]],
        "distance-matrix": [[0.0, 0.5], [0.5, 0.0]],
        "camera-dictionary": {"1": [[10.0, 100.0], "Sensor 1"], "2": ["here", "Sensor 2"], "3": "bad", "4": [[1, 2]]},
    }
    path = tmp_path / "graph.json"
    path.write_text(json.dumps(doc))
    got = {(r.src, r.dst): (r.weight, r.distance) for r in sources.read_graph(spark, str(path)).collect()}
    assert got == {(0, 0): (1.0, 0.0), (0, 1): (1.0, 0.5), (1, 0): (1.0, 0.5), (1, 1): (1.0, 0.0)}
    meta = {r.sensor_id: (r.location, r.name) for r in sources.read_metadata(spark, str(path)).collect()}
    assert meta == {1: ([10.0, 100.0], "Sensor 1"), 2: (None, "Sensor 2")}
    path.write_text(json.dumps({"adjacency-matrix": [[0, 1], [1]]}))
    with pytest.raises(Exception, match="not square"):
        sources.read_graph(spark, str(path)).collect()
    path.write_text(json.dumps({"adjacency-matrix": []}))
    with pytest.raises(Exception, match="no adjacency-matrix"):
        sources.read_graph(spark, str(path)).collect()


def test_config(spark, tmp_path):
    assert sources.read_config(spark, str(tmp_path / "none.json")).count() == 0
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"max_flow": 117.0, "node_ids": ["1", "10", "2"]}))
    nodes = sources.canonical_nodes_from_config(sources.read_config(spark, str(path))).collect()
    assert [(r.pos, r.node_id) for r in nodes] == [(0, "1"), (1, "10"), (2, "2")]


@pytest.mark.parametrize(
    "payload, status",
    [
        ({"timestamp": "t", "data": {"1": 2.5}}, "ok"),
        ({"timestamp": "t", "data": [1]}, "old_format"),
        ({"timestamp": "t", "data": 3}, "invalid"),
        ({"timestamp": "t"}, "invalid"),
        ("not json", "invalid"),
        (None, "empty"),
    ],
)
def test_latest_prediction(spark, payload, status):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    old = json.dumps({"timestamp": "old", "data": {"9": 1.0}})
    rows = [] if payload is None else [(datetime(2024, 1, 1), old), (datetime(2024, 1, 2), text)]
    got = sources.latest_prediction(spark.createDataFrame(rows, "timestamp TIMESTAMP, payload STRING")).first()
    assert got.status == status
    if status == "ok":
        assert got.timestamp == "t" and got.data == {"1": 2.5}
    if status == "empty":
        assert got.timestamp == "" and got.data == {}


def test_wide_scan(spark):
    wide = spark.createDataFrame([(1, 5.0, None), (2, None, 7.0)], "time INT, `10` DOUBLE, `2` DOUBLE")
    got = {(r.bucket, r.sensor_id, r.value) for r in sources.wide_to_long(wide).collect()}
    assert got == {(1, 10, 5.0), (1, 2, None), (2, 10, None), (2, 2, 7.0)}
    with pytest.raises(ValueError):
        sources.wide_to_long(wide.withColumnRenamed("time", "when"))


def test_one_graph_document(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"adjacency-matrix": [[1, 1], [1, 1]]}))
    with pytest.raises(ValueError, match="more than one"):
        sources.read_graph(spark, str(tmp_path))
    got = sources.read_graph(spark, str(tmp_path / "a.json")).collect()
    assert len(got) == 4 and all(r.distance is None for r in got)


@pytest.mark.parametrize("size", ["64", "1000", "100m"])
@pytest.mark.parametrize("indent", [None, 1])
def test_graph_document_in_ranges(spark, tmp_path, size, indent):
    rng = random.Random(4)
    n = 23
    weights = [[rng.choice([0, 0, 1, 2.5, -3e-2]) for _ in range(n)] for _ in range(n)]
    far = [[rng.randint(0, 900) / 4 for _ in range(n)] for _ in range(n)]
    odd = {"1": [[10.0, 100.0], 'a ] [ "adjacency-matrix": [[7]] b'], "2": [[], "]]"]}
    want = {(i, j): (weights[i][j], far[i][j]) for i in range(n) for j in range(n) if weights[i][j]}
    path = tmp_path / "graph.json"
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        for doc in (
            {"adjacency-matrix": weights, "distance-matrix": far, "camera-dictionary": odd},
            {"camera-dictionary": odd, "distance-matrix": far, "adjacency-matrix": weights},
        ):
            path.write_text(json.dumps(doc, indent=indent))
            frame = sources.read_graph(spark, str(path))
            assert {(r.src, r.dst): (r.weight, r.distance) for r in frame.collect()} == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("separator", [",", ", "])
@pytest.mark.parametrize("zero", [0, 0.0])
def test_runs_of_zeros_in_graph_documents(spark, tmp_path, separator, zero):
    """Runs are told by signs before a row is parsed; a number that begins with 0 may follow one."""
    rng = random.Random(7)
    n = 600
    cells = [0.5, 0.05, 3, -0.25, 1e-7, 40, -0.0]
    weights = [[rng.choice(cells) if rng.random() < (0.004, 0.1)[i % 2] else zero for _ in range(n)] for i in range(n)]
    weights[3], weights[4] = [zero] * n, [zero] * (n - 1) + [0.5]
    far = [[rng.choice([7, 0.5, None]) if rng.random() < 0.05 else zero for _ in range(n)] for _ in range(n - 2)]
    far[5], far[6] = far[5][:300], [zero] * 300
    doc = {"adjacency-matrix": weights, "distance-matrix": far}
    (tmp_path / "graph.json").write_text(json.dumps(doc, separators=(separator, ":")))
    got = {(r.src, r.dst): (r.weight, r.distance) for r in sources.read_graph(spark, str(tmp_path)).collect()}
    distance = lambda i, j: far[i][j] if i < len(far) and j < len(far[i]) else None
    assert got == {(i, j): (weights[i][j], distance(i, j)) for i in range(n) for j in range(n) if weights[i][j]}


@pytest.mark.parametrize("row", ["{},", ",{}", "{},,{}", "{} 1", "{},true"])
def test_faults_beside_runs_of_zeros(spark, tmp_path, row):
    path = tmp_path / "graph.json"
    path.write_text(f'{{"adjacency-matrix": [[1], [{row.replace("{}", ",".join("0" * 272))}]]}}')
    with pytest.raises(ValueError, match="no list of numbers: row 1"):
        sources.read_graph(spark, str(path))


def test_graph_document_in_parts(spark, tmp_path):
    doc = {"adjacency-matrix": [[0, 2, 0], [1, 0, 0], [0, 0, 3]], "distance-matrix": [[0, 4, 0], [5, 0, 0], [0, 0, 6]]}
    want = {(0, 1): (2, 4), (1, 0): (1, 5), (2, 2): (3, 6)}
    lines = json.dumps(doc).replace("],", "]\n,").replace("]]", "]\n]").splitlines(keepends=True)
    for k, cuts in enumerate(([2], [1, 3, 4, 5], range(1, len(lines)))):
        folder = tmp_path / str(k)
        folder.mkdir()
        ends = [*cuts, len(lines)]
        for i, (a, b) in enumerate(zip([0, *cuts], ends, strict=True)):
            (folder / f"part-{i:05d}.txt.gz").write_bytes(gzip.compress("".join(lines[a:b]).encode()))
        got = {(r.src, r.dst): (r.weight, r.distance) for r in sources.read_graph(spark, str(folder), parts=True).collect()}
        assert got == want
        with pytest.raises(ValueError, match="more than one"):
            sources.read_graph(spark, str(folder))
    whole, twice, torn = json.dumps(doc) + "\n", tmp_path / "twice", tmp_path / "torn"
    for folder, texts, message in ((twice, (whole, whole), "more than one"), (torn, (whole[:40], whole[40:]), "line break")):
        folder.mkdir()
        for i, text in enumerate(texts):
            (folder / f"{i}.json").write_text(text)
        with pytest.raises(ValueError, match=message):
            sources.read_graph(spark, str(folder), parts=True)


def test_faulty_graph_documents(spark, tmp_path):
    path = tmp_path / "graph.json"
    whole = json.dumps({"adjacency-matrix": [[1, 2], [3, 4]]})
    for text, message in (
        (whole[:-1], "cut off"),
        (whole[:-3], "cut off"),
        ("{}", "no adjacency-matrix"),
        ('{"adjacency-matrix": null}', "no adjacency-matrix"),
        ('{"adjacency-matrix": [[1]], "adjacency-matrix": [[1]]}', "given twice"),
        ('{"adjacency-matrix": [[1, 2], [3, x]]}', "no list of numbers"),
        ('{"adjacency-matrix": [[1, 2], "a", [3, 4]]}', "no list of numbers"),
    ):
        path.write_text(text)
        with pytest.raises(Exception, match=message):
            sources.read_graph(spark, str(path)).collect()


def test_wide_panel_lists_all_sensors(spark):
    cells = spark.createDataFrame([(1, 10, 1.0), (1, 2, 2.0), (2, 10, 3.0)], "bucket INT, sensor_id BIGINT, value DOUBLE")
    assert wide_panel(cells).columns == ["timestamp", "10", "2"]
    assert wide_panel(cells, [2, 10, 7]).columns == ["timestamp", "10", "2", "7"]
    with pytest.raises(ValueError, match="not among"):
        wide_panel(cells, [2])
