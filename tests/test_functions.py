import random
from datetime import datetime, timedelta, timezone
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sensorgrid import functions as fn
from tests.helpers import at, utc


@pytest.mark.parametrize(
    "text, micros", [("15s", 15e6), ("5m", 300e6), ("1h30m", 5400e6), ("1d", 86400e6), ("2w", 14 * 86400e6)]
)
def test_parse_duration(text, micros):
    assert fn.parse_duration(text) == micros


@pytest.mark.parametrize("text", ["", "5", "m5", "5 m", "0m", "5x"])
def test_parse_duration_rejects(text):
    with pytest.raises(ValueError):
        fn.parse_duration(text)


def test_round_half_even_is_python_round(spark):
    rng = random.Random(7)
    values = [2.675, 0.125, 0.375, 1.005, 1.015, 0.025, -2.675, -0.125, 0.0, 119.995, 1e6 + 0.005]
    values += [rng.randrange(0, 100000) / rng.choice([7, 8, 40, 200, 1000]) for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for digits in (0, 2, 3):
        got = [r[0] for r in rows.select(fn.round_half_even(F.col("v"), digits)).collect()]
        assert got == [float(round(v, digits)) for v in values]
    assert Fraction(2.675) < Fraction(2675, 1000)


def test_calendar_does_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([(at(m),) for m in (0, 1019, 1020, 10080)], "ts TIMESTAMP")
    df = rows.select(
        fn.local_date(F.col("ts"), "+07:00").alias("d"),
        fn.time_of_day(F.col("ts"), "+07:00").alias("t"),
        fn.iso_weekday(fn.local_date(F.col("ts"), "+07:00")).alias("w"),
        fn.floor_to(F.col("ts"), "1d", "+07:00").cast("long").alias("day"),
        fn.floor_to(F.col("ts"), "1w", "+07:00").cast("long").alias("week"),
        fn.local_wall(F.col("ts"), "+07:00").cast("string").alias("wall"),
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        results = []
        for other in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", other)
            results.append([tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert results[0] == results[1] == results[2]
    tz = timezone(timedelta(hours=7))
    for row, minute in zip(results[0], (0, 1019, 1020, 10080)):
        local = at(minute).astimezone(tz)
        midnight = local.replace(hour=0, minute=0)
        monday = midnight - timedelta(days=midnight.weekday())
        assert row[0] == local.date()
        assert row[1] == local.hour * 3600 + local.minute * 60
        assert row[2] == local.isoweekday()
        assert row[3] == midnight.timestamp()
        assert row[4] == monday.timestamp()
        assert row[5] == local.strftime("%Y-%m-%d %H:%M:%S")


def test_floor_to_minutes(spark):
    rows = spark.createDataFrame([(at(7.99),), (at(-0.01),)], "ts TIMESTAMP")
    got = [utc(r[0]) for r in rows.select(fn.floor_to(F.col("ts"), "5m", "+05:30")).collect()]
    assert got == [at(5), at(-5)]


def test_file_name_times(spark):
    names = [
        "5d8cd_1649154313885.txt",
        "a_b_12.txt",
        "nothing.txt",
        "x_1649154313885.json",
        "pre1649154313885mid_x.txt",
        "1649154313885",
        "_",
        None,
    ]
    rows = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = rows.select(fn.filename_epoch_lenient(F.col("n")), fn.filename_epoch_strict(F.col("n"))).collect()
    big = 1649154313885
    assert [r[0] for r in got] == [big, 12, None, None, None, big, None, None]
    assert [r[1] for r in got] == [big, None, None, big, big, big, None, None]


def test_sensor_ids(spark):
    raw = ["node_007", "12", "x_node_3_4", "cam", "node_", None, " 5 "]
    rows = spark.createDataFrame([(r,) for r in raw], "r STRING")
    got = [r[0] for r in rows.select(fn.normalize_sensor_id(F.col("r"))).collect()]
    assert got == [7, 12, 3, None, None, None, 5]


def test_wall_clock_round_trip(spark):
    rows = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS w")
    back = rows.select(fn.to_utc_wall(fn.from_utc_wall(F.col("w")))).first()[0]
    assert back == datetime(2024, 3, 10, 2, 30)
