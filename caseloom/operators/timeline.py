"""Events to dated timelines, and to the cases they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.dates import ANCHORED, absolute, anchor, in_calendar, is_relative, iso_day, relative


def chunk_anchors(chunks: DataFrame, most: int | None = ANCHORED) -> DataFrame:
    """chunk_id, chunk_anchor: the first absolute date of each chunk's text (of its first `most` characters; None: of all)."""
    return chunks.select("chunk_id", anchor(F.col("text"), most).alias("chunk_anchor"))


def event_times(events: DataFrame, chunks: DataFrame, files: DataFrame, most: int | None = ANCHORED) -> DataFrame:
    """event_id, date_raw, date_start, date_end, precision, status, parser.

    Absolute dates are read first; only the others that are relative look for an anchor: their chunk's first date, else
    their file's day. Chunks that no pending event is in are not parsed.
    """
    e = events.select("event_id", "file_id", "chunk_id", F.col("date").alias("date_raw")).withColumn("a", absolute(F.col("date_raw")))
    pending = F.col("a.status").isNull() & F.col("a.date_start").isNull() & is_relative(F.col("date_raw"))
    need = e.where(pending).select("chunk_id").distinct()
    found = chunk_anchors(chunks.join(need, "chunk_id", "left_semi"), most)
    days = files.select("file_id", iso_day(F.col("mtime")).alias("file_anchor"))
    e = e.join(found, "chunk_id", "left").join(days, "file_id", "left").withColumn("pending", pending)
    # Columns of their own, so that each is computed once.
    e = e.withColumn("base", F.coalesce("chunk_anchor", "file_anchor").try_cast("date"))
    e = e.withColumn("resolved", F.when(F.col("pending"), relative(F.col("date_raw"), F.col("base"))))
    e = e.withColumn("day", in_calendar(F.col("resolved")).cast("string"))
    base, day = F.col("base"), F.col("day")
    status = (
        F.when(F.col("a.status").isNotNull(), F.col("a.status")).when(F.col("a.date_start").isNotNull(), "ok").when(~F.col("pending"), "invalid_format")
        .when(base.isNull(), "missing_anchor").when(day.isNull(), "unresolved_relative").otherwise("ok")
    )
    return e.select(
        "event_id", "date_raw", F.coalesce("a.date_start", day).alias("date_start"), F.coalesce("a.date_end", day).alias("date_end"),
        F.when(F.col("a.precision").isNotNull(), F.col("a.precision")).when(day.isNotNull(), "day").otherwise("unknown").alias("precision"), status.alias("status"),
        F.when(F.col("a.date_start").isNotNull(), "absolute_v1").when(day.isNotNull(), "relative_v1").alias("parser"),
    )


def event_cases(events: DataFrame, signals: DataFrame, *rest: str) -> DataFrame:
    """event_id, case_id_norm, source and the columns `rest` of file_id, chunk_id: the cases signalled in the event's chunk, else file:<file_id>."""
    cases = signals.where("attribute = 'case_id' AND value_norm IS NOT NULL").select("file_id", "chunk_id", F.col("value_norm").alias("case_id_norm")).distinct()
    e = events.select("event_id", "file_id", "chunk_id").join(cases, ["file_id", "chunk_id"], "left")
    return e.select("event_id", F.coalesce("case_id_norm", F.concat(F.lit("file:"), "file_id")).alias("case_id_norm"), F.when(F.col("case_id_norm").isNull(), "fallback").otherwise("identity_signals").alias("source"), *rest)
