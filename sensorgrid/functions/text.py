"""Identifiers and time stamps carried in text."""

from pyspark.sql import Column, functions as F


def filename_epoch_lenient(name: Column) -> Column:
    """Epoch ms after the last underscore of a ``.txt`` name, NULL if it is not a number."""
    tail = F.replace(F.substring_index(name, "_", -1), F.lit(".txt"), F.lit(""))
    return F.trim(tail).try_cast("bigint")


def filename_epoch_strict(name: Column) -> Column:
    """Thirteen digits at the end of the name, else the first thirteen digits anywhere."""
    trailing = F.regexp_extract(name, r"(\d{13})(?:\.\w+)?$", 1)
    anywhere = F.regexp_extract(name, r"(\d{13})", 1)
    digits = F.coalesce(F.nullif(trailing, F.lit("")), F.nullif(anywhere, F.lit("")))
    return digits.try_cast("bigint")


def normalize_sensor_id(raw: Column) -> Column:
    """``node_007`` and ``"7"`` both give 7; anything else gives NULL."""
    text = raw.cast("string")
    labelled = F.regexp_extract(text, r"(\d+)", 1)
    return F.when(F.contains(text, F.lit("node_")), labelled).otherwise(text).try_cast("bigint")
