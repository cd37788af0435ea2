"""Fixed schemas of the data model."""

from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("sensor_id", T.LongType()),
    T.StructField("count", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("seq", T.LongType()),
    # Orders readings of equal seq.
    T.StructField("tie", T.StringType()),
])

# sensor_id and count are read as text: producers send both numbers and strings.
MESSAGE = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("count", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("src", T.StringType()),
    T.StructField("ingest_ts", T.LongType()),
])

ARCHIVE_META = [
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.LongType()),
    T.StructField("dumper_timestamp", T.LongType()),
]

CORRUPT = "_corrupt"
ARCHIVED_MESSAGE = T.StructType(
    list(MESSAGE.fields) + ARCHIVE_META + [T.StructField(CORRUPT, T.StringType())]
)

GRAPH_DOC = T.StructType([
    T.StructField("adjacency-matrix", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("distance-matrix", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

EDGES = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
])

MODEL_CONFIG = T.StructType([
    T.StructField("max_flow", T.DoubleType()),
    T.StructField("num_nodes", T.LongType()),
    T.StructField("node_ids", T.ArrayType(T.StringType())),
    T.StructField("input_len", T.IntegerType()),
    T.StructField("output_len", T.IntegerType()),
    T.StructField("train_ratio", T.DoubleType()),
])
