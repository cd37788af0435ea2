"""Landing of files below a prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Content types by file extension.
CONTENT_TYPES = {
    "json": "application/json",
    "csv": "text/csv",
    "txt": "text/plain",
    "html": "text/html",
    "xml": "text/xml",
    "png": "image/png",
    "jpg": "image/jpeg",
    "npy": "application/octet-stream",
    "parquet": "application/octet-stream",
}
DEFAULT_TYPE = "application/octet-stream"


def _content_type(name: Column) -> Column:
    out = F.lit(DEFAULT_TYPE)
    extension = F.lower(F.substring_index(name, ".", -1))
    for ext, kind in CONTENT_TYPES.items():
        out = F.when(extension == ext, kind).otherwise(out)
    return out


def landing_manifest(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """``rel_path, key, size, content_type`` of every file below ``folder``; the key keeps the
    relative path.  File contents are not read."""
    root = folder.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    plain = F.regexp_replace("path", r"^file:/+", "/")
    rel = F.substring(plain, F.lit(len(root) + 2), F.length(plain))
    clean = prefix.strip("/")
    return files.select(
        rel.alias("rel_path"),
        (F.concat(F.lit(clean + "/"), rel) if clean else rel).alias("key"),
        F.col("length").alias("size"),
        _content_type(rel).alias("content_type"),
    )


def partition_key(file_name: Column, path: Column | None = None) -> Column:
    """Date folder of an archive file: from its name, else from a ``dump_date=`` folder in its
    path; ``unknown`` if neither holds a valid date."""
    text = F.regexp_extract(file_name, r"^kafka-dump-(.*)\.json$", 1)
    days = [F.try_to_date(text, "yyyy-MM-dd")]
    if path is not None:
        days.append(F.try_to_date(F.regexp_extract(path, r"dump_date=([0-9-]+)/[^/]*$", 1), "yyyy-MM-dd"))
    return F.coalesce(*[day.cast("string") for day in days], F.lit("unknown"))


def land_archives(lines: DataFrame, files: DataFrame, target: str) -> int:
    """Write the lines of valid files below ``target/dump_date=<date>`` and return the
    number of files landed.

    ``lines`` has ``path, value``; ``files`` has ``path, file_name, valid``.  A date that lands
    again is replaced, so a retry changes nothing; ``files`` must hold all files of its dates.
    Raises if no file is valid.
    """
    good = files.where("valid").withColumn("dump_date", partition_key(F.col("file_name"), F.col("path")))
    n = good.count()
    if n == 0:
        raise ValueError("no valid archive file to land")
    (
        lines.join(good.select("path", "dump_date"), "path")
        .select("value", "dump_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dump_date")
        .text(target)
    )
    return n


def ingest_summary(manifest: DataFrame, ok: Column, elapsed_s: Column | None = None) -> DataFrame:
    """Files, landed files, errors, bytes landed and success percentage; with ``elapsed_s`` (an
    aggregate, the run time in seconds) also that time and the files landed per second."""
    timed = []
    if elapsed_s is not None:
        timed = [elapsed_s.alias("elapsed_s"), F.try_divide(F.count_if(ok), elapsed_s).alias("files_per_s")]
    return manifest.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(ok).alias("landed"),
        F.count_if(~ok).alias("errors"),
        F.coalesce(F.sum(F.when(ok, F.col("size"))), F.lit(0)).alias("bytes"),
        F.try_divide(F.count_if(ok) * 100.0, F.count(F.lit(1))).alias("success_pct"),
        *timed,
    )
