"""Ids and evidence references of the query contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import case_slug

#: Characters of a quote in an evidence reference.
QUOTE = 280


def chunk_id(file_id: Column, start: Column, end: Column) -> Column:
    return F.when(F.trim(file_id).isNotNull() & (F.trim(file_id) != "") & (start >= 0) & (end >= start), F.concat(file_id, F.lit(":"), start, F.lit("-"), end))


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 16 hex digits of the parts' hash; nulls count as empty."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 16))


def product_path(case: Column, kind: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("products"), case_slug(case), F.lower(F.regexp_replace(kind, "[^A-Za-z0-9]+", "_")), name)


def redacted_hash(c: Column, length: int = 8) -> Column:
    return F.when(c.isNull(), F.lit("0" * length)).otherwise(F.substring(F.sha2(c, 256), 1, length))


def edge_key(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def evidence_errors(refs: DataFrame) -> DataFrame:
    """refs with valid and error_code: the first rule that a reference breaks."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rules = [
        (blank("file_id"), "missing_file_id"), (blank("chunk_id"), "missing_chunk_id"),
        ((F.col("page_start") < 0) | (F.col("page_end") < 0) | (F.col("page_start").isNull() != F.col("page_end").isNull()) | (F.col("page_end") < F.col("page_start")), "invalid_page_range"),
        ((F.col("char_start") < 0) | (F.col("char_end") < F.col("char_start")) | (F.col("char_start").isNull() != F.col("char_end").isNull()), "invalid_char_range"),
        (F.length("quote") > QUOTE, "quote_too_long"), (blank("source_phase"), "missing_source_phase"),
        (F.col("prompt_hash").isNotNull() & ~F.col("prompt_hash").rlike("^[0-9a-f]{64}$"), "invalid_prompt_hash"),
        ((F.col("confidence") < 0) | (F.col("confidence") > 1) | F.isnan("confidence"), "invalid_confidence"),
    ]
    code = F.lit(None).cast("string")
    for bad, name in reversed(rules):
        code = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(code)
    return refs.withColumn("error_code", code).withColumn("valid", F.col("error_code").isNull())
