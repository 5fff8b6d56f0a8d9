"""Read models: parameterised queries over the case store, with a status contract."""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SOURCES = {"entities": "entity_id", "events": "event_id", "conversations": "conversation_id", "identity_signals": "signal_id"}
SORTS = ("page_start", "confidence", "source_table", "file_id", "record_id")
PAGE_SIZES, PAGE_SIZE = (10, 25, 50, 100), 25

Store = dict[str, DataFrame]


@dataclass
class Filters:
    case_id: str | None = None
    person_id: int | None = None
    confidence_min: float | None = None
    confidence_max: float | None = None
    date_start: str | None = None
    date_end: str | None = None
    source_table: str | None = None
    query: str | None = None

    def over(self, shared: Filters | None) -> Filters:
        """These, and the shared ones where these say nothing; a shared case always counts."""
        if shared is None:
            return self
        both = {k: getattr(self, k) if getattr(self, k) is not None else getattr(shared, k) for k in self.__dataclass_fields__}
        return Filters(**(both | ({"case_id": shared.case_id} if shared.case_id else {})))


@dataclass
class Result:
    status: int
    code: str
    frames: dict[str, DataFrame] = field(default_factory=dict)
    widgets: dict[str, str] = field(default_factory=dict)
    page: dict[str, int | str] = field(default_factory=dict)


def _has(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def case_chunks(store: Store, case: str, signals: bool = True) -> DataFrame:
    """file_id, chunk_id of the case: through its events and, if asked for, its case signals."""
    e = store["events"].join(store["event_cases"].where(F.col("case_id_norm") == case).select("event_id"), "event_id", "left_semi").select("file_id", "chunk_id")
    if signals and "identity_signals" in store:
        s = store["identity_signals"].where((F.col("attribute") == "case_id") & (F.col("value_norm") == case)).select("file_id", "chunk_id")
        e = e.union(s)
    return e.distinct()


def evidence_union(store: Store) -> DataFrame:
    """All four observation tables as one, with source_table, record_id and, for events, date_start."""
    out = None
    for name, key in SOURCES.items():
        if name not in store:
            continue
        t = store[name]
        if name == "events" and "event_times" in store:
            t = t.join(store["event_times"].select("event_id", "date_start"), "event_id", "left")
        day = F.col("date_start") if "date_start" in t.columns else F.lit(None).cast("string")
        part = t.select(F.lit(name).alias("source_table"), F.col(key).cast("long").alias("record_id"), "file_id", "chunk_id", F.col("page_start").cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), F.col("confidence").cast("double").alias("confidence"), "quote", day.alias("date_start"))
        out = part if out is None else out.unionByName(part)
    return out


def evidence_filter(f: Filters) -> Column:
    """Nulls as the store has them: unknown confidence is -1, an unknown date the empty text (so an upper bound keeps it)."""
    ok = F.lit(True)
    c, d = F.coalesce("confidence", F.lit(-1.0)), F.coalesce("date_start", F.lit(""))
    ok = ok & (c >= f.confidence_min) if f.confidence_min is not None else ok
    ok = ok & (c <= f.confidence_max) if f.confidence_max is not None else ok
    ok = ok & (d >= f.date_start.strip()) if (f.date_start or "").strip() else ok
    ok = ok & (d <= f.date_end.strip()) if (f.date_end or "").strip() else ok
    ok = ok & (F.col("source_table") == f.source_table) if f.source_table in SOURCES else ok
    if (f.query or "").strip():
        like = f"%{f.query.strip().lower()}%"
        ok = ok & (F.lower(F.coalesce("quote", F.lit(""))).like(like) | F.lower("file_id").like(like) | F.lower("chunk_id").like(like))
    return ok


def evidence_browser(store: Store, case: str, page: int = 1, page_size: int = PAGE_SIZE, sort_by: str = "page_start", sort_dir: str = "asc", filters: Filters | None = None, shared: Filters | None = None) -> Result:
    """One page of the case's evidence; unknown paging and sorting fall back to page 1, 25 rows, page_start asc."""
    f = (filters or Filters()).over(shared)
    case = ((shared and shared.case_id) or case or "").strip()
    page = page if isinstance(page, int) and page >= 1 else 1
    page_size = page_size if page_size in PAGE_SIZES else PAGE_SIZE
    sort_by, sort_dir = sort_by if sort_by in SORTS else "page_start", sort_dir if sort_dir in ("asc", "desc") else "asc"
    if not case or "event_cases" not in store or not _has(store["event_cases"].where(F.col("case_id_norm") == case)):
        return Result(404, "case_not_found", widgets={"evidence": "case_not_found"})
    rows = evidence_union(store).join(case_chunks(store, case, signals=False), ["file_id", "chunk_id"], "left_semi").where(evidence_filter(f))
    total = rows.count()
    key = F.col(sort_by).asc_nulls_first() if sort_dir == "asc" else F.col(sort_by).desc_nulls_last()
    shown = rows.orderBy(key, "record_id", "source_table").offset((page - 1) * page_size).limit(page_size)
    return Result(200, "ok", {"evidence": shown}, {"evidence": "ready" if total else "empty"}, {"page": page, "page_size": page_size, "total": total, "pages": ceil(total / page_size), "sort_by": sort_by, "sort_dir": sort_dir})


def _events_of(store: Store, case: str, f: Filters) -> DataFrame:
    e = store["event_cases"].where(F.col("case_id_norm") == case).select("event_id").join(store["events"], "event_id")
    if "event_times" in store:
        e = e.join(store["event_times"].select("event_id", "date_start", "date_end", "status", "precision"), "event_id", "left")
    else:
        e = e.withColumns({"date_start": F.lit(None).cast("string"), "date_end": F.lit(None).cast("string"), "status": F.lit(None).cast("string"), "precision": F.lit(None).cast("string")})
    return e.withColumn("status", F.coalesce("status", F.lit("missing"))).withColumn("source_table", F.lit("events")).where(evidence_filter(Filters(confidence_min=f.confidence_min, date_start=f.date_start, date_end=f.date_end)))


def case_view(store: Store, case: str, entity_limit: int = 25, evidence_limit: int = 50, shared: Filters | None = None) -> Result:
    """Summary counts, linked entities and evidence of a case; a missing table costs its widget only."""
    f = Filters().over(shared)
    case = ((shared and shared.case_id) or case or "").strip()
    known = "cases" in store and _has(store["cases"].where(F.col("case_id_norm") == case))
    scope = case_chunks(store, case) if {"events", "event_cases"} <= set(store) else None
    if not case or not (known or scope is not None and _has(scope)):
        return Result(404, "case_not_found", widgets={"case_viewer": "case_not_found"})
    out = Result(200, "ok")
    key, sure = ["file_id", "chunk_id"], F.lit(True) if f.confidence_min is None else F.coalesce("confidence", F.lit(-1.0)) >= f.confidence_min
    if scope is None:
        return Result(200, "ok", widgets={w: "missing_required_tables" for w in ("summary", "linked_entities", "evidence")})
    everything = evidence_union(store).join(scope, key, "left_semi").where(sure)
    events = _events_of(store, case, f)
    parts = [events.agg(F.countDistinct("event_id").alias("event_count"), F.count_if(F.col("status") != "ok").alias("unresolved_date_count")), everything.agg(F.count("*").alias("evidence_count"))]
    if "entities" in store:
        own = store["entities"].join(scope, key, "left_semi").where((F.trim("entity") != "") & sure)
        parts.append(own.where(F.lower("type") == "person").agg(F.countDistinct(F.lower(F.trim("entity"))).alias("people_count")))
        out.frames["linked_entities"] = own.groupBy("entity", "type").agg(F.count("*").alias("occurrences"), F.max(F.coalesce("confidence", F.lit(0.0))).alias("max_confidence")).orderBy(F.desc("occurrences"), F.lower("entity"), F.lower(F.coalesce("type", F.lit("")))).limit(entity_limit)
    else:
        out.widgets["linked_entities"] = "missing_entities_table"
    summary = parts[0]
    for p in parts[1:]:  # each is one row
        summary = summary.withColumn("__k", F.lit(1)).join(p.withColumn("__k", F.lit(1)), "__k").drop("__k")
    out.frames["summary"] = summary
    order = ["file_id", "chunk_id", F.coalesce("page_start", F.lit(0)), F.coalesce("page_end", F.lit(0)), "source_table", "record_id"]
    out.frames["evidence"] = everything.orderBy(*order).limit(evidence_limit)
    return out


def case_timeline(store: Store, case: str, limit: int = 500, shared: Filters | None = None) -> Result:
    """Two lanes: dated events by day, others by status. The limit counts before the filters; undated rows fail any date bound."""
    f = Filters().over(shared)
    case = ((shared and shared.case_id) or case or "").strip()
    own = store["event_cases"].where(F.col("case_id_norm") == case)
    if not case or not _has(own):
        return Result(404, "case_not_found", widgets={"timeline": "case_not_found"})
    rows = _events_of(store, case, Filters()).orderBy("event_id").limit(limit)
    if f.confidence_min is not None:
        rows = rows.where(F.coalesce("confidence", F.lit(-1.0)) >= f.confidence_min)
    for bound, low in ((f.date_start, True), (f.date_end, False)):
        if (bound or "").strip():
            rows = rows.where(F.col("date_start").isNotNull() & (F.col("date_start") >= bound if low else F.col("date_start") <= bound))
    ok = F.col("status") == "ok"
    return Result(200, "ok", {"normalised": rows.where(ok).orderBy("date_start", "event_id"), "unresolved": rows.where(~ok).orderBy("status", F.coalesce("date", F.lit("")), "event_id")}, {"timeline": "ready"})


def person_profile(store: Store, case: str, person_id: int, event_limit: int = 100, evidence_limit: int = 100, shared: Filters | None = None) -> Result:
    """Identity, merge status, events and evidence of a person in the case's chunks that they were seen in."""
    f = Filters().over(shared)
    case, person_id = ((shared and shared.case_id) or case or "").strip(), (shared and shared.person_id) or person_id
    if not {"person_clusters", "person_cluster_members", "person_observations"} <= set(store):
        return Result(404, "person_not_found", widgets={"profile": "missing_person_tables"})
    me = store["person_clusters"].where(F.col("person_id") == person_id)
    if not case or person_id <= 0 or not _has(me):
        return Result(404, "person_not_found", widgets={"profile": "person_not_found"})
    key = ["file_id", "chunk_id"]
    obs = store["person_observations"].join(store["person_cluster_members"].where(F.col("person_id") == person_id).select("obs_id"), "obs_id", "left_semi")
    scope = obs.select(*key).distinct().join(case_chunks(store, case), key, "left_semi")
    if not _has(scope):
        return Result(404, "person_not_in_case", widgets={"profile": "person_not_in_case"})
    out = Result(200, "ok", {"identity": me}, {"identity": "ready"})
    seen = obs.join(scope, key, "left_semi")
    out.frames["aliases"] = seen.where(F.trim("name") != "").select("name").distinct().orderBy(F.lower("name"), "name")
    if "person_resolution_edges" in store:
        mine = store["person_cluster_members"].where(F.col("person_id") == person_id).select("obs_id")
        e = store["person_resolution_edges"].join(mine.withColumnRenamed("obs_id", "left"), "left", "left_semi").join(mine.withColumnRenamed("obs_id", "right"), "right", "left_semi")
        every = store["person_clusters"].sparkSession.createDataFrame([(d,) for d in ("auto_merge", "needs_review", "no_merge")], "decision string")
        out.frames["merge_status"] = every.join(e.groupBy("decision").agg(F.count("*").alias("n")), "decision", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    events = _events_of(store, case, f).join(scope, key, "left_semi")
    out.frames["linked_events"] = events.orderBy(F.when(F.col("status") == "ok", 0).otherwise(1), F.coalesce("date_start", F.lit("")), "event_id").limit(event_limit)
    everything = evidence_union(store).join(scope, key, "left_semi").where(evidence_filter(Filters(confidence_min=f.confidence_min)))
    if "entities" in store:
        # An entity counts once for each of the person's observations that has its name.
        names = obs.select(F.lower(F.trim("name")).alias("__n"))
        named = store["entities"].select(F.col("entity_id").cast("long").alias("record_id"), F.lower(F.trim("entity")).alias("__n")).join(names, "__n").select("record_id")
        ents = everything.where("source_table = 'entities'").join(named, "record_id")
        everything = everything.where("source_table <> 'entities'").unionByName(ents.select(*everything.columns))
    out.frames["linked_evidence"] = everything.orderBy("file_id", "chunk_id", F.coalesce("page_start", F.lit(0)), F.coalesce("page_end", F.lit(0)), "source_table", "record_id").limit(evidence_limit)
    return out


def case_indicators(store: Store, case: str) -> Result:
    """Counters of de-duplication and threading for a case that has events."""
    case = (case or "").strip()
    if not case or not _has(store["event_cases"].where(F.col("case_id_norm") == case)):
        return Result(404, "case_not_found", widgets={"indicators": "case_not_found"})
    out, key = Result(200, "ok"), ["file_id", "chunk_id"]
    if {"person_cluster_members", "person_observations", "person_resolution_edges"} <= set(store):
        inside = store["person_observations"].join(case_chunks(store, case), key, "left_semi").join(store["person_cluster_members"], "obs_id").select("obs_id", "person_id")
        e = store["person_resolution_edges"].join(inside.select(F.col("obs_id").alias("left")), "left").join(inside.select(F.col("obs_id").alias("right")), "right")
        counts = e.agg(*[F.count_if(F.col("decision") == d).alias(f"merge_{d}") for d in ("auto_merge", "needs_review", "no_merge")])
        out.frames["dedupe"] = inside.agg(F.countDistinct("person_id").alias("people_clusters")).withColumn("__k", F.lit(1)).join(counts.withColumn("__k", F.lit(1)), "__k").drop("__k")
    else:
        out.widgets["dedupe_indicators"] = "missing_dedupe_tables"
    if {"conversation_threads", "conversation_thread_segments"} <= set(store):
        t = store["conversation_threads"].where(F.col("case_id_norm") == case).select("thread_id")
        n = t.join(store["conversation_thread_segments"], "thread_id", "left").groupBy("thread_id").agg(F.count("segment_id").alias("n"))
        out.frames["threading"] = n.agg(F.count("*").alias("threads_total"), F.sum("n").alias("segments_total"))
        out.frames["top_threads"] = n.orderBy(F.desc("n"), "thread_id").limit(5)
    else:
        out.widgets["thread_indicators"] = "missing_thread_tables"
    return out
