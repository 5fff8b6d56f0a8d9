"""Quality reports over the stages' outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.triage import LLM_ROUTES, routes_of


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 3)).otherwise(F.lit(0.0))


def class_report(phase1: DataFrame) -> DataFrame:
    """Files by class: count, mean characters, sampled, with errors."""
    return phase1.groupBy("classification").agg(
        F.count("*").alias("files"), F.round(F.avg("text_char_count_total"), 2).alias("avg_chars"),
        F.count_if(F.coalesce("sampled", F.lit(False))).alias("sampled"), F.count_if(F.coalesce("errors", F.lit("")) != "").alias("with_errors"),
    )


def page_report(pages: DataFrame) -> DataFrame:
    """Pages by where their text is from: pages, empty ones, low-quality ones and their shares."""
    p = pages.select(F.coalesce("source", F.lit("unknown")).alias("source"), (F.trim(F.coalesce("text", F.lit(""))) == "").alias("empty"), (F.col("quality_score_page") < 0.5).alias("low"))
    out = p.groupBy("source").agg(F.count("*").alias("pages"), F.count_if("empty").alias("empty_pages"), F.count_if("low").alias("low_pages"))
    return out.withColumn("low_pct", percent(F.col("low_pages"), F.col("pages")))


def llm_rows(records: DataFrame, triage: DataFrame) -> DataFrame:
    """records (extractor, chunk_id, n_items, error, model) with their route and predicted route, "unknown" without triage."""
    t = triage.groupBy("chunk_id").agg(F.max("route").alias("route"), F.max("predicted_route").alias("predicted_route")) if "predicted_route" in triage.columns else triage.groupBy("chunk_id").agg(F.max("route").alias("route")).withColumn("predicted_route", F.col("route"))
    df = records.join(t, "chunk_id", "left").withColumn("route", F.coalesce("route", F.lit("unknown")))
    return df.withColumns({"predicted_route": F.coalesce("predicted_route", "route"), "model": F.coalesce(F.nullif("model", F.lit("")), F.lit("unknown")), "yielded": (F.col("n_items") > 0) & F.col("error").isNull(), "failed": F.coalesce("error", F.lit("")) != ""})


def yield_sets(rows: DataFrame) -> DataFrame:
    """Yield and errors by extractor, extractor and route, extractor and predicted route, predicted route, route and model: one scan."""
    return rows.sparkSession.sql(
        """
        SELECT extractor, route, predicted_route, model, count(*) AS records, count_if(yielded) AS with_items, count_if(failed) AS with_error,
               count_if(error = 'invalid_json') AS invalid_json, round(count_if(yielded) / count(*) * 100, 3) AS yield_pct,
               round(count_if(failed) / count(*) * 100, 3) AS error_pct, round(count_if(error = 'invalid_json') / count(*) * 100, 3) AS invalid_json_pct
        FROM {rows}
        GROUP BY GROUPING SETS ((extractor), (extractor, route), (extractor, predicted_route), (predicted_route), (route, model))
        """,
        rows=rows,
    )


def retry_chunks(records: DataFrame, extractors: int = 4) -> DataFrame:
    """Chunks to try again: an answer that was no JSON or a refusal, or no item from any of all extractors."""
    bad = F.lower(F.coalesce("error", F.lit(""))).rlike("invalid_json|refus")
    g = records.groupBy("chunk_id").agg(F.bool_or(bad).alias("bad"), F.count("*").alias("seen"), F.sum(F.coalesce("n_items", F.lit(0))).alias("items"))
    return g.where(F.col("bad") | ((F.col("seen") >= extractors) & (F.col("items") == 0))).select("chunk_id")


#: Flags of a page that is of low quality, and the share of such pages above which a report warns.
LOW_FLAGS, LOW_PAGES_PCT = ("empty_text", "low_text", "ocr_error", "missing_source"), 30.0


def routed_yields(rows: DataFrame) -> DataFrame:
    """Per extractor the records that were, and that were predicted to be, routed to a model: kind, extractor, records, with_items, with_error, yield_pct, error_rate_pct."""
    both = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("to")) for k in ("route", "predicted_route")]))
    sent = rows.select("extractor", "yielded", "failed", both.alias("k")).select("*", "k.*").withColumn("sent", F.col("to").isin(*LLM_ROUTES))
    out = sent.groupBy("kind", "extractor").agg(F.count_if("sent").alias("records"), F.count_if(F.col("sent") & F.col("yielded")).alias("with_items"), F.count_if(F.col("sent") & F.col("failed")).alias("with_error"))
    return out.withColumns({"yield_pct": percent(F.col("with_items"), F.col("records")), "error_rate_pct": percent(F.col("with_error"), F.col("records"))})


def rollup(pages: DataFrame, chunks: DataFrame, triage: DataFrame, records: DataFrame, decode_errors: dict[str, int] | None = None) -> DataFrame:
    """One row of all headline metrics, and warnings; each source is read once.

    pages may have source and quality_flags. records: extractor, chunk_id, n_items, error. decode_errors: lines that were no JSON, by source.
    """
    empty = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")) == ""
    source = F.col("source") if "source" in pages.columns else F.lit(None).cast("string")
    flagged = F.coalesce(F.arrays_overlap("quality_flags", F.array(*map(F.lit, LOW_FLAGS))), F.lit(False)) if "quality_flags" in pages.columns else F.lit(False)
    p = pages.agg(
        F.countDistinct("file_id").alias("docs"), F.count("*").alias("total_pages"), F.count_if(empty).alias("empty_text_pages"), F.count_if(source == "pdf_text").alias("pages_pdf_text"),
        F.count_if(source == "ocr").alias("pages_ocr"), F.count_if(flagged | empty).alias("pages_low_quality"),
    )
    c = chunks.agg(F.count("*").alias("total_chunks"), F.count_if("signals.likely_dialogue").alias("dialogue_chunks"), F.count_if("signals.low_quality").alias("low_quality_chunks"))
    sent, ahead = F.col("route").isin(*LLM_ROUTES), F.col("predicted_route").isin(*LLM_ROUTES)
    tokens = lambda cond: F.coalesce(F.sum(F.when(cond, F.coalesce("token_est", F.lit(0)))), F.lit(0)).cast("long")
    t = routes_of(triage).agg(
        F.count("*").alias("triage_records"), F.count_if(sent).alias("routed_to_llm_chunks"), tokens(sent).alias("routed_to_llm_tokens_est"),
        F.count_if(ahead).alias("predicted_routed_to_llm_chunks"), tokens(ahead).alias("predicted_routed_to_llm_tokens_est"),
    )
    items, own = F.coalesce("n_items", F.lit(0)) > 0, lambda k: F.col("extractor") == k
    good = items & F.col("error").isNull()
    r = records.agg(
        *[F.count_if(own(k)).alias(f"{one}_records") for k, one in (("entities", "entity"), ("events", "event"))],
        *[F.count_if(own(k) & items).alias(f"chunks_with_{k}") for k in ("entities", "events")],
        F.count_if(own("conversations") & good).alias("__conversations"),
        F.count_if(own("entities") | own("events") | own("conversations")).alias("llm_total_records"),
        F.count_if((own("entities") | own("events") | own("conversations")) & F.coalesce(F.col("error") == "invalid_json", F.lit(False))).alias("llm_invalid_json_records"),
        F.countDistinct(F.when((own("entities") | own("events") | own("conversations")) & good & (F.col("chunk_id") != ""), F.col("chunk_id"))).alias("__any"),
    )
    out = p.withColumn("__k", F.lit(1))
    for part in (c, t, r):
        out = out.join(part.withColumn("__k", F.lit(1)), "__k")
    per_1k = lambda n: F.when(F.col("total_chunks") > 0, F.round(F.col(n) * 1000 / F.col("total_chunks"), 3)).otherwise(0.0)
    pct = lambda a, b: percent(F.col(a), F.col(b))
    out = out.withColumns({
        "entity_yield_pct": pct("chunks_with_entities", "total_chunks"), "event_yield_pct": pct("chunks_with_events", "total_chunks"), "llm_invalid_json_rate_pct": pct("llm_invalid_json_records", "llm_total_records"),
        "empty_text_page_rate_pct": pct("empty_text_pages", "total_pages"), "ocr_page_rate_pct": pct("pages_ocr", "total_pages"), "low_quality_page_rate_pct": pct("pages_low_quality", "total_pages"),
        "routed_to_llm_pct": pct("routed_to_llm_chunks", "total_chunks"), "predicted_routed_to_llm_pct": pct("predicted_routed_to_llm_chunks", "total_chunks"),
        "entities_per_1k_chunks": per_1k("chunks_with_entities"), "events_per_1k_chunks": per_1k("chunks_with_events"), "conversations_per_1k_chunks": per_1k("__conversations"), "yield_per_1k_chunks": per_1k("__any"),
        **{f"json_decode_errors_{k}": F.lit(n) for k, n in (decode_errors or {}).items()},
    })
    warnings = F.array_compact(F.array(
        *[F.when(F.col(f"{one}_records") != F.col("total_chunks"), f"{k}_record_count_mismatch") for k, one in (("entities", "entity"), ("events", "event"))],
        F.when(F.col("low_quality_page_rate_pct") > LOW_PAGES_PCT, "phase3_low_quality_page_rate_high"),
    ))
    return out.withColumn("warnings", warnings).drop("__k", "__any", "__conversations")


def document_quality(pages: DataFrame) -> DataFrame:
    """file_id, page_count, quality_score: the mean of the pages' scores, each held to 0 to 1 (0 if unknown), six digits."""
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("quality_score_page").cast("double"), F.lit(0.0))))
    return pages.groupBy("file_id").agg(F.count("*").alias("page_count"), F.round(F.avg(score), 6).alias("quality_score"))


#: Tables that a check of threads needs.
THREAD_TABLES = ("conversation_segments", "conversation_threads", "conversation_thread_segments", "conversation_thread_participants")


def thread_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """check, n: rows of the thread tables, memberships without a segment, participant keys that are neither a person's nor a speaker's; or which tables are missing."""
    spark = next(iter(tables.values())).sparkSession if tables else None
    if gone := [t for t in THREAD_TABLES if t not in tables]:
        if spark is None:
            raise ValueError("no tables to check")
        return spark.createDataFrame([(f"missing_table:{t}", 1) for t in sorted(gone)], "check string, n long")
    segments, _, member, who = (tables[t] for t in THREAD_TABLES)
    n = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
    orphans = member.join(segments.select("segment_id").distinct(), "segment_id", "left_anti")
    bad = who.where(~(F.col("participant_key").startswith("p:") | F.col("participant_key").startswith("s:")))
    parts = [n(tables[t], t) for t in THREAD_TABLES] + [n(orphans, "missing_thread_segments"), n(bad, "invalid_participant_keys")]
    return reduce(DataFrame.unionByName, parts)
