"""Streams: what the batch stages do, as files and events arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseloom.sources.jsonl import append_new


def jsonl_stream(spark: SparkSession, path: str, schema: str, files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema + ", _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").option("maxFilesPerTrigger", files).json(path)


def load_new(stream: DataFrame, target: str, checkpoint: str, key: str = "chunk_id") -> StreamingQuery:
    """Append records whose key isn't loaded yet. A batch that is run again after a failure adds nothing twice."""
    good = stream.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return good.writeStream.foreachBatch(lambda batch, _: append_new(batch, target, key) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _timed(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark; watermarks want a timestamp with a zone (the session's)."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def windowed_counts(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events and mean value by type and window; works on a table as on a stream."""
    e = _timed(events, late)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = e.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("avg_value"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "avg_value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions by user: start, end of the last event's gap, events."""
    e = _timed(events, late)
    out = e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(events: DataFrame, key: str = "event_id", late: str = "2 hours") -> DataFrame:
    return _timed(events, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def running_budget(stream: DataFrame, budget: int) -> DataFrame:
    """chunk_id, file_id, token_est, taken: a file's chunks until its budget is spent; one that doesn't fit is passed over. State is one number a file.

    Within a batch chunks are taken by chunk_id, so a batch that is run again after a failure takes the same ones; batches follow each other. A file's new
    chunks of one batch are held together in one task (as many as `files` of jsonl_stream bring). Works on a table as on a stream.
    """
    out = "chunk_id string, file_id string, token_est int, taken boolean"

    def walked(b: pd.DataFrame, spent: int) -> tuple[pd.DataFrame, int]:
        b = b[["chunk_id", "file_id", "token_est"]].sort_values("chunk_id", kind="stable")
        n = b["token_est"].to_numpy()
        if spent + int(n.sum()) <= budget:  # the whole batch fits
            return b.assign(taken=True), spent + int(n.sum())
        taken = np.zeros(len(n), bool)
        for i, k in enumerate(n.tolist()):
            if spent + k <= budget:
                taken[i], spent = True, spent + k
        return b.assign(taken=taken), spent

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (spent,) = state.get if state.exists else (0,)
        made, spent = walked(pd.concat(list(batches), ignore_index=True), spent)
        state.update((spent,))
        yield made

    if not stream.isStreaming:
        return stream.groupBy("file_id").applyInPandas(lambda b: walked(b, 0)[0], out)
    return stream.groupBy("file_id").applyInPandasWithState(step, out, "spent long", "append", "NoTimeout")
