"""Keeping an expensive expression from being evaluated several times."""

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with the named columns, each evaluated once per row.

    The optimizer copies a projection into every filter and expression above it; parsing a
    message would then be repeated for each use of a field.  It does not do so across a
    generator, and ``inline`` of one struct is a generator that keeps the rows as they are.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def fields_once(df: DataFrame, keep: list[str], struct: Column) -> DataFrame:
    """The columns in ``keep`` and all fields of ``struct``, which is evaluated once; a NULL
    struct gives NULL fields."""
    return df.select(*keep, F.inline(F.array(struct)))
