"""What the training-data operators share: reading, Arrow mapping, rows' identities; shared-folder tables and components are the library's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.components import linked as components
from caseloom.sources.scratch import written

__all__ = ["components", "keep_rows", "keyed", "map_slices", "shielded", "table", "utf8", "written"]

#: Rows handled together inside a Python worker; bounds the Python copies of long texts.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply fn to Arrow slices of bounded row count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                yield fn(batch.slice(at, SLICE))

    return df.mapInArrow(run, schema)


def utf8(c: str | Column) -> Column:
    """The text's bytes; null counts as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("binary")


def shielded(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with its columns that begin with two underscores, as the operators' own do, under other names; and what gives rows docs' columns back."""
    names = {c: f"user{i}_{c}" if c.startswith("__") else c for i, c in enumerate(docs.columns)}
    while len({*names.values()} | {*docs.columns}) < len(docs.columns) + sum(a != b for a, b in names.items()):
        names = {c: n if c == n else f"u{n}" for c, n in names.items()}
    return docs.withColumnsRenamed(names), lambda df: df.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def keyed(docs: DataFrame) -> DataFrame:
    """With a row's identity: its id, its text's hash and length (ids can be null or come with several texts)."""
    return docs.withColumns({"__id": F.col("doc_id"), "__h": F.xxhash64("text"), "__n": F.coalesce(F.length("text"), F.lit(-1))})


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of docs that keys (a written table of distinct __id, __h, __n and __rep) names, all columns kept.

    Where __rep, the number of rows with that identity, is over one, one of them comes back.
    """
    d, k = keyed(docs), keys.select(*[F.col(c).alias(f"{c}k") for c in ("__id", "__h", "__n", "__rep")])
    on = d["__id"].eqNullSafe(k["__idk"]) & (d["__h"] == k["__hk"]) & (d["__n"] == k["__nk"])
    if not keys.where("__rep > 1").limit(1).count():
        return d.join(k, on, "left_semi").select(*docs.columns)
    found = d.join(k, on)
    once, more = found.where("__repk = 1"), found.where("__repk > 1").dropDuplicates(["__id", "__h", "__n"])
    return once.unionByName(more).select(*docs.columns)
