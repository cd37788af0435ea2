"""Name, builder and oracle SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sensorgrid.functions import to_utc_wall
from sensorgrid.plans.catalog.oracle import with_tables

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def _decimal(x: Column) -> Column:
    return F.round(x.cast("decimal(30,9)"), DIGITS).cast("double")


def rounded(x: Column) -> Column:
    """``x`` to 6 digits, snapped to 9 digits first, so that ties do not depend on the order of a sum.

    Only values near a tie need decimals.  Others of moderate size lie more than 0.002 steps from one,
    further than the snap and the error of the product can move them, and the quotient of two whole
    numbers is the double nearest to the decimal.
    """
    step = F.lit(float(10**DIGITS))
    near = F.rint(x * step)
    clear = (F.abs(x * step - near) < 0.498) & (F.abs(x) < 1e6)
    return F.when(clear, near / step + 0.0).otherwise(_decimal(x))


def comparable(df: DataFrame) -> DataFrame:
    """Result in a form other engines can be compared with: instants as UTC wall clock,
    doubles rounded to 6 digits."""
    columns = []
    # A row of many such columns makes a method that the JVM does not compile.
    few = sum(isinstance(field.dataType, T.DoubleType) for field in df.schema.fields) <= 4
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = to_utc_wall(column)
        elif isinstance(field.dataType, T.DoubleType):
            column = rounded(column) if few else _decimal(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Registers a builder; ``sql`` may use the derived tables listed in ``needs``."""

    def register(builder: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: comparable(builder(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_tables(needs, sql)
        return builder

    return register
