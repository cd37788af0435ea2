import random

from pyspark.sql import functions as F

from sensorgrid.plans.catalog.registry import _decimal, rounded


def test_rounding_like_decimals(spark):
    """The shorter way gives the double of the decimal way, near ties, too; it is taken at all."""
    rng = random.Random(7)
    ties = [s * (n + 0.5) / 1e6 * (1 + e) for n in (0, 1, 7, 123456, 999999999) for s in (1, -1) for e in (0, 1e-16, 1e-12, 1e-9, -1e-9, 1e-5)]
    some = [rng.uniform(-m, m) for m in (1e-6, 1e-3, 1.0, 200.0, 1e6, 1e9) for _ in range(2000)]
    rows = [(x,) for x in [*ties, *some, 0.0, -0.0, -1e-7, None]]
    df = spark.createDataFrame(rows, "x DOUBLE").select("x", rounded(F.col("x")).alias("a"), _decimal(F.col("x")).alias("b"))
    wrong = [r for r in df.collect() if repr(r.a) != repr(r.b)]
    assert wrong == []
    assert "rint" in df._jdf.queryExecution().optimizedPlan().toString().lower()
