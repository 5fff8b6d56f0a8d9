"""Uniqueness as a row store has it: a key that holds a null never equals another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def unique_rows(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row for each complete key (the first by order, or any); rows with a null in the key all stay.

    The null rows get a key of their own, so it is one shuffle, and they don't meet in one task.
    """
    own = F.when(complete(keys), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    df = df.withColumn("__own", own)
    if not order:
        return df.dropDuplicates([*keys, "__own"]).drop("__own")
    from pyspark.sql import Window

    w = Window.partitionBy(*keys, "__own").orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "__own")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the row that comes last: one aggregate with map-side combine, no sort."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__x"))
    return best.select(*keys, *[F.col(f"__x.{c}").alias(c) for c in rest])
