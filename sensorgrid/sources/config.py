"""Model configuration documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid import schemas


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The configuration row; no row if there is no file."""
    try:
        return spark.read.schema(schemas.MODEL_CONFIG).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.MODEL_CONFIG)


def canonical_nodes_from_config(config: DataFrame) -> DataFrame:
    """``pos, node_id`` in the order of the configuration."""
    return config.select(F.posexplode("node_ids").alias("pos", "node_id"))
