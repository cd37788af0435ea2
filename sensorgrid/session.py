"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Partition counts come from AQE: it coalesces small shuffle partitions and splits
    # skewed ones, so the same job runs at test size and on a large cluster.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of every column expression slow plan building down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str = "sensorgrid", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
