"""From documents to packed training sequences: five stages, each on all its predecessor kept.

1. quality classifier - documents scored below 0.5 go; null and empty texts are scored too;
2. line dedup - lines that other documents hold too stay in the smallest doc_id only;
3. near duplicates - of documents of five-word shingles with a similarity of 0.8 or more, the one
   with the smallest doc_id of each group stays;
4. benchmark decontamination - documents that hold a test item go;
5. best-fit packing - the remaining documents as packed token sequences, a row per piece.

Rows without a doc_id are kept by stages 2 to 4, as no other row can be told from them.  Stages 1
to 4 carry all other columns along, also those named like an operator's results; ``n_chars``, if
there, follows the text.  Empty tables pass through.

The first stage is a trained model and the third a search, which SQL cannot express, so
``ORACLE_SQL`` is None; the stages are tested against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.llm.common import free_name, quoted, table
from sensorgrid.llm.decontaminate import drop_contaminated
from sensorgrid.llm.linededup import drop_repeated_lines
from sensorgrid.llm.neardup import drop_near_duplicates
from sensorgrid.llm.packing import pack
from sensorgrid.llm.quality import fit, score
from sensorgrid.llm.queries import TOKENIZER
from sensorgrid.staging import release, stage


def aside(docs: DataFrame, *results: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` whose columns named like ``results`` have other names, and what names them back."""
    given, safe = docs.columns, docs
    for name in given:
        if name.lower() in results:
            safe = safe.withColumnRenamed(name, free_name(safe, f"given_{name}"))
    now = safe.columns
    return safe, lambda out: out.select([quoted(c).alias(name) for c, name in zip(now, given, strict=True)])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit(docs, table(spark, sf_dir, "labels"))
    docs, named_back = aside(docs, "score")
    return named_back(score(docs, model).where("score >= 0.5"))


def keep_first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, named_back = aside(docs, "n_lines", "n_dropped")
    out = named_back(drop_repeated_lines(docs))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, k=5, percent=80)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", keep_first_lines),
    ("near duplicates", keep_one_of_a_kind),
    ("benchmark decontamination", keep_unseen),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each result is written as Parquet and read again, and
    deleted when the next one is written."""
    rows = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        result = stage(apply(spark, rows, sf_dir), "corpus-" + name.replace(" ", "-"))
        release(rows)
        rows = result
    return rows
