"""Extractor output to observation tables: explode, coerce, count what is wrong, keep unique rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import address_key, birth_key, case_key, clean, clean_float, clean_int, clean_quote
from caseloom.operators.nulls import unique_rows

_SPAN = "char_start string, char_end string, char_range array<string>, source_phase string, extractor_version string, prompt_hash string, model string"
_ITEM = {
    "entities": f"entity string, type string, quote string, confidence string, {_SPAN}",
    "events": f"event string, date string, quote string, confidence string, {_SPAN}",
    "conversations": f"speaker string, quote string, confidence string, {_SPAN}",
    "identity_signals": f"person string, attribute string, value string, quote string, confidence string, {_SPAN}",
}
_RECORD = "file_id string, chunk_id string, page_range array<string>, model string, error string, source_phase string, extractor_version string, prompt_hash string, _corrupt_record string"
#: What a row of each table is unique by.
KEYS = {
    "entities": ["entity", "type", "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote"],
    "events": ["event", "date", "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote"],
    "conversations": ["speaker", "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote"],
    "identity_signals": ["person_text", "attribute", "value", "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote"],
}
ATTRIBUTES = ("dob", "address", "case_id")


def record_schema(kind: str) -> str:
    """Of extractor JSON Lines; strings where types vary, so that nothing is lost in reading."""
    return f"items array<struct<{', '.join(f'{a}:{b}' for a, b in (x.rsplit(' ', 1) if 'array' not in x else x.split(' ', 1) for x in _ITEM[kind].split(', ')))}>>, {_RECORD}"


def _person_text() -> Column:
    return clean(F.col("item.person"))


def observations(records: DataFrame, kind: str) -> DataFrame:
    """Valid rows of a kind, unique by its key; item fields take precedence over the record's.

    identity_signals need a quote and a known attribute, and get value_norm.
    """
    r = records.where(F.col("_corrupt_record").isNull()) if "_corrupt_record" in records.columns else records
    r = r.where(clean(F.col("file_id")).isNotNull() & clean(F.col("chunk_id")).isNotNull() & F.col("items").isNotNull())
    r = r.withColumn("item", F.explode("items"))
    start = F.coalesce(clean_int(F.col("item.char_start")), clean_int(F.get("item.char_range", 0)))
    end = F.coalesce(clean_int(F.col("item.char_end")), clean_int(F.get("item.char_range", 1)))
    both = F.col("page_range").isNotNull() & (F.size("page_range") == 2)
    head = {
        "entities": [clean(F.col("item.entity")).alias("entity"), clean(F.col("item.type")).alias("type")],
        "events": [clean(F.col("item.event")).alias("event"), clean(F.col("item.date")).alias("date")],
        "conversations": [clean(F.col("item.speaker")).alias("speaker")],
        "identity_signals": [_person_text().alias("person_text"), F.lower(clean(F.col("item.attribute"))).alias("attribute"), clean(F.col("item.value")).alias("value")],
    }[kind]
    own = lambda name: F.coalesce(clean(F.col(f"item.{name}")), clean(F.col(name)))
    out = r.select(
        *head, clean_float(F.col("item.confidence")).alias("confidence"), "file_id", "chunk_id",
        F.when(both, clean_int(F.get("page_range", 0))).alias("page_start"), F.when(both, clean_int(F.get("page_range", 1))).alias("page_end"),
        clean_quote(F.col("item.quote")).alias("quote"), F.when(start <= end, start).alias("char_start"), F.when(start <= end, end).alias("char_end"),
        F.coalesce(own("source_phase"), F.lit("legacy")).alias("source_phase"), own("extractor_version").alias("extractor_version"), own("prompt_hash").alias("prompt_hash"), own("model").alias("model"),
    )
    must = {"entities": ["entity"], "events": ["event"], "conversations": ["quote"], "identity_signals": ["person_text", "value", "quote"]}[kind]
    for c in must:
        out = out.where(F.col(c).isNotNull())
    if kind == "identity_signals":
        norm = F.when(F.col("attribute") == "case_id", case_key(F.col("value"))).when(F.col("attribute") == "address", address_key(F.col("value"))).otherwise(birth_key(F.col("value")))
        out = out.where(F.col("attribute").isin(*ATTRIBUTES)).withColumn("value_norm", norm)
    return unique_rows(out, KEYS[kind])


def load_counts(records: DataFrame, kind: str = "entities", known: DataFrame | None = None) -> DataFrame:
    """One row: records_total, json_decode_errors, invalid_record_shape, rows_attempted, invalid_item_shape, rows_inserted, rows_skipped.

    Attempted are all items of well-formed records; inserted those that observations() keeps and `known`, the table so far, doesn't have.
    """
    bad = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in records.columns else F.lit(False)
    shape = ~bad & (clean(F.col("file_id")).isNull() | clean(F.col("chunk_id")).isNull() | F.col("items").isNull())
    must = {"entities": ["entity"], "events": ["event"], "conversations": ["quote"], "identity_signals": ["person", "value", "quote"]}[kind]
    odd = lambda i: i.isNull() | reduce(lambda a, b: a | b, [clean(i[m]).isNull() for m in must])
    counts = records.agg(
        F.count("*").alias("records_total"), F.count_if(bad).alias("json_decode_errors"), F.count_if(shape).alias("invalid_record_shape"),
        F.coalesce(F.sum(F.when(~bad & ~shape, F.size("items"))), F.lit(0)).alias("rows_attempted"), F.coalesce(F.sum(F.when(~bad & ~shape, F.size(F.filter("items", odd)))), F.lit(0)).alias("invalid_item_shape"),
    )
    rows = observations(records, kind)
    if known is not None:
        # As the table's own uniqueness: a key that holds a null equals none.
        rows = rows.join(known.select(*KEYS[kind]), KEYS[kind], "left_anti")
    return counts.join(rows.agg(F.count("*").alias("rows_inserted")), F.lit(True)).withColumn("rows_skipped", F.col("rows_attempted") - F.col("rows_inserted"))


def files(manifest: DataFrame) -> DataFrame:
    """The files table of a manifest: the first row of each id, by its other columns."""
    clean_ = lambda c: clean(F.col(c)) if c in manifest.columns else F.lit(None).cast("string")
    size = F.col("size_bytes").cast("long") if "size_bytes" in manifest.columns else F.lit(None).cast("long")
    rows = manifest.select(clean_("file_id").alias("file_id"), *[clean_(c).alias(c) for c in ("source_type", "container_path", "virtual_path")], clean_("mtime").alias("mtime_utc"), size.alias("size_bytes")).where("file_id IS NOT NULL")
    rest = [c for c in rows.columns if c != "file_id"]
    return rows.groupBy("file_id").agg(F.min(F.struct(*rest)).alias("x")).select("file_id", "x.*")


def mentions(entities: DataFrame) -> DataFrame:
    """Distinct entity in chunk."""
    return entities.select("entity", "file_id", "chunk_id").distinct()


def chunk_tables(chunks: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """chunks (the first row of an id stays) and chunk_text_refs (its last row counts)."""
    good = chunks.where(clean(F.col("chunk_id")).isNotNull() & clean(F.col("file_id")).isNotNull() & (F.col("page_start") <= F.col("page_end")))
    first = good.groupBy("chunk_id").agg(F.min_by(F.struct("file_id", "page_start", "page_end"), order).alias("x")).select("chunk_id", "x.*")
    last = good.groupBy("chunk_id").agg(F.max_by(F.struct("file_id", F.length("text").alias("char_count"), F.sha2("text", 256).alias("text_sha256")), order).alias("x")).select("chunk_id", "x.*")
    return first, last


def without_known(new: DataFrame, known: DataFrame, key: str = "file_id") -> DataFrame:
    """Resume: only rows whose key isn't there yet."""
    return new.join(known.select(key).distinct(), key, "left_anti")


def replaced(old: DataFrame, new: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows of old but for the keys that new has, then new's."""
    return without_known(old, new, key).unionByName(new, allowMissingColumns=True)
