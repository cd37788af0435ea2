"""Training data: chronological split, scaling, sliding windows, batches, statistics.

``series(sensor_id, pos, value)`` is a complete panel with bucket positions.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.operators.indexing import dense_position

CHUNK = 1024


def to_series(panel: DataFrame, buckets: DataFrame) -> DataFrame:
    return panel.select("sensor_id", "bucket", "value").join(
        buckets.select("bucket", "pos", "local_date"), "bucket"
    ).select("sensor_id", "pos", "value", "local_date")


def chrono_split(buckets: DataFrame, ratio: float = 0.8) -> DataFrame:
    """``pos, split, step``: the first ``floor(T * ratio)`` buckets train, the rest validate;
    ``step`` counts from the start of the split."""
    total = buckets.agg(F.count(F.lit(1)).alias("n")).scalar()
    cut = F.floor(total * F.lit(ratio))
    train = F.col("pos") < F.col("cut")
    return buckets.select("pos", cut.alias("cut")).select(
        "pos",
        F.when(train, "train").otherwise("val").alias("split"),
        F.when(train, F.col("pos")).otherwise(F.col("pos") - F.col("cut")).alias("step"),
    )


def max_flow(series: DataFrame, split: DataFrame) -> DataFrame:
    """Largest training value; 1.0 instead of 0."""
    train = split.where("split = 'train'").select("pos")
    top = series.join(train, "pos", "left_semi").agg(F.max("value").alias("m"))
    return top.select(F.when(F.col("m") == 0, 1.0).otherwise(F.col("m")).alias("max_flow"))


def scale(value: Column, factor: Column) -> Column:
    return value / factor


def unscale(value: Column, factor: Column) -> Column:
    return value * factor


def chunked_series(
    series: DataFrame, split: DataFrame, need: int, factor: Column | None = None, chunk: int = CHUNK, columns: tuple[str, ...] = ("value",)
) -> DataFrame:
    """``sensor_id, split, chunk, first``, an array of each column, ``gaps`` and ``changes``.

    This is the form in which windows are stored: a window of ``need`` steps is a chunk and an
    offset into its arrays.  A chunk holds ``chunk`` steps from ``first`` on and the ``need - 1``
    steps after them, so every window lies in one chunk.  ``gaps`` lists offsets of steps that the
    series does not hold, ``changes`` those at which a new day begins.
    """
    if chunk < need:
        raise ValueError("chunk must hold at least one window")
    scaled = [(F.col(c) if factor is None else scale(F.col(c), factor)).alias(c) for c in columns]
    rows = series.join(split, "pos").select("sensor_id", "split", "step", "local_date", *scaled)
    own = F.floor(F.col("step") / chunk)
    halo = (F.col("step") % chunk < need - 1) & (own > 0)
    rows = rows.withColumn("chunk", F.explode(F.when(halo, F.array(own, own - 1)).otherwise(F.array(own))))
    # At most chunk + need - 1 rows.
    held = rows.groupBy("sensor_id", "split", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("step", "local_date", *columns))).alias("r")
    ).withColumn("first", F.col("chunk") * chunk)
    offsets = F.transform("r", lambda x: (x["step"] - F.col("first")).cast("int"))
    last = F.element_at("r", -1)["step"] - F.col("first")
    complete = F.size("r") == last + 1
    slots = F.sequence(F.lit(0), last.cast("int"))
    filled = F.transform(slots, lambda i: F.get("r", F.array_position(offsets, i).cast("int") - 1))
    held = held.withColumn("gaps", F.when(complete, F.array().cast("array<int>")).otherwise(F.array_except(slots, offsets)))
    held = held.withColumn("r", F.when(complete, F.col("r")).otherwise(filled))
    new_day = F.filter(slots, lambda i: (i > 0) & (F.get("r", i)["local_date"] != F.get("r", F.greatest(i - 1, F.lit(0)))["local_date"]))
    return held.select(
        "sensor_id", "split", "chunk", "first", *[F.col(f"r.{c}").alias(c) for c in columns], "gaps", new_day.alias("changes")
    )


def _covering(places: str, most: int, least: int) -> Column:
    """The offsets from ``most`` to ``least`` steps before each of these places."""
    return F.flatten(F.transform(places, lambda g: F.sequence((g - most).cast("int"), (g - least).cast("int"))))


def chunk_windows(chunks: DataFrame, input_len: int = 12, output_len: int = 3, within_day: bool = False, chunk: int = CHUNK) -> DataFrame:
    """``sensor_id, split, start_idx, x, y`` of all windows of ``chunked_series``."""
    need = input_len + output_len
    top = F.least(F.size("value") - need, F.lit(chunk - 1))
    # Offsets of windows with a gap or a change of day are struck out per chunk, not per window.
    spoilt = _covering("gaps", need - 1, 0)
    if within_day:
        spoilt = F.concat(spoilt, _covering("changes", need - 1, 1))
    offsets = F.when(top >= 0, F.array_except(F.sequence(F.lit(0), top), spoilt))
    rows = chunks.select("sensor_id", "split", "first", "value", F.explode(offsets).alias("o"))
    o = F.col("o")
    return rows.select(
        "sensor_id", "split", (F.col("first") + o).alias("start_idx"),
        F.slice("value", o + 1, input_len).alias("x"), F.slice("value", o + 1 + input_len, output_len).alias("y"),
    )


def training_windows(
    series: DataFrame,
    split: DataFrame,
    input_len: int = 12,
    output_len: int = 3,
    factor: Column | None = None,
    within_day: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """``sensor_id, split, start_idx, x, y`` with stride 1; no window crosses the split.

    An export form: each window is an array of its own.  What is stored are the chunks.
    """
    chunks = chunked_series(series, split, input_len + output_len, factor, chunk)
    return chunk_windows(chunks, input_len, output_len, within_day, chunk)


def check_length(split: DataFrame, input_len: int = 12, output_len: int = 3) -> None:
    """Raises if a split is too short for one window (runs a job)."""
    lengths = {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    for name in ("train", "val"):
        if lengths.get(name, 0) < input_len + output_len:
            raise ValueError(
                f"{name} split too short: {lengths.get(name, 0)} steps, needs {input_len + output_len}"
            )


def dataset_stats(
    series: DataFrame, split: DataFrame, input_len: int = 12, output_len: int = 3
) -> DataFrame:
    """Per split: samples, nodes, minimum, maximum, mean and population deviation."""
    return (
        series.join(split, "pos")
        .groupBy("split")
        .agg(
            (F.max("step") + 1 - input_len - output_len + 1).alias("num_samples"),
            F.count_distinct("sensor_id").alias("num_nodes"),
            F.min("value").alias("data_min"),
            F.max("value").alias("data_max"),
            F.avg("value").alias("data_mean"),
            F.stddev_pop("value").alias("data_std"),
        )
    )


def training_batches(
    split: DataFrame, input_len: int = 12, output_len: int = 3, batch_size: int = 32, seed: int = 42
) -> DataFrame:
    """``split, start_idx, batch, slot``: training samples in a seeded order, validation
    samples in time order, ``batch_size`` at a time.

    A sample is one window of all nodes.  The order is that of a digest of seed and index, so
    it does not depend on partitioning.
    """
    last = split.groupBy("split").agg((F.max("step") - (input_len + output_len) + 1).alias("last"))
    samples = split.join(last, "split").where("step <= last").select("split", F.col("step").alias("start_idx"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("start_idx").cast("string")))
    train = dense_position(
        samples.where("split = 'train'").withColumn("digest", digest),
        ["digest", "start_idx"],
        "rank",
    ).drop("digest")
    val = samples.where("split = 'val'").withColumn("rank", F.col("start_idx"))
    return train.unionByName(val).select(
        "split",
        "start_idx",
        F.floor(F.col("rank") / batch_size).alias("batch"),
        (F.col("rank") % batch_size).alias("slot"),
    )


