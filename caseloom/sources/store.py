"""The case store: named Parquet tables under one root, with a version and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.sources.jsonl import exists

VERSION = "8"
TABLES = (
    "files chunks chunk_text_refs entities events conversations identity_signals mentions person_observations person_clusters person_cluster_members person_resolution_edges event_times event_cases "
    "conversation_segments conversation_thread_edges conversation_threads conversation_thread_segments conversation_thread_participants cases kg_edges kg_edge_evidence meta"
).split()


class CaseStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(name)
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return exists(self.spark, f"{self.path(name)}/_SUCCESS")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(name))

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Columns may be added in later versions: readers merge schemas."""
        df.write.mode(mode).option("compression", "zstd").parquet(self.path(name))

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in TABLES if self.has(t)}

    def note(self, key: str, value: str) -> None:
        row = self.spark.createDataFrame([(key, value)], "key string, value string").withColumn("created_utc", F.current_timestamp())
        self.write("meta", row, "append")
