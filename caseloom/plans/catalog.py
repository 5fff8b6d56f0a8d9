"""All queries of the library over the test tables, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import ids as I
from caseloom.functions import text as T
from caseloom.operators import chunking, graph, loading, nulls, readmodels, resolve, routeml, threads, triage, validate
from caseloom.plans import adapters as A
from caseloom.plans import oracle as O
from caseloom.sources.export import cypher_edges
from caseloom.sources.scratch import written
from caseloom.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Parameters of the example queries.
CASE, BUDGET, PER_FILE, OVERALL = "CASE2", 20_000, 2, 300


def query(ctes: str | None, select: str = "") -> Callable[[Query], Query]:
    """Register a query by its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if ctes is not None:
            ORACLE[f.__name__] = O.sql(ctes, select)
        return f

    return add



# Chunks and triage


@query(O.CHUNKS, f"SELECT chunk_id, page_start, page_end, length(t) AS n_chars, dialogue AS likely_dialogue, regexp_matches(regexp_replace(t, '[À-ɏ]', '_', 'g'), {O._q(T.DATE)}) AS has_dates, regexp_matches(regexp_replace(t, '[À-ɏ]', '_', 'g'), {O._q(chunking.NAME)}) AS has_names, length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) < 40 AS low_quality FROM chunks")
def chunk_windows(spark: SparkSession, sf: str) -> DataFrame:
    return A.chunks(spark, sf).select("chunk_id", "page_start", "page_end", F.length("text").alias("n_chars"), "signals.likely_dialogue", "signals.has_dates", "signals.has_names", "signals.low_quality")


_QUALITY = "char_len non_ws_ratio punctuation_ratio replacement_char_count max_repeated_char_run tokens_sampled_for_shapes unique_word_shapes word_shape_diversity".split()
_STRUCTURE = "line_count nonempty_line_count bullet_line_count bullet_density tableish_line_count table_like dialogue_marker_count".split()
_ENTITY = "honorific_count capitalized_name_count initials_count org_suffix_count badge_id_count".split()
_EVENT = "date_like_count time_like_count time_of_day_word_count on_at_by_date_count incident_verb_count".split()
_WORDS = [*(f"kw_{p}" for p in T.PACKS), "keyword_hit_total"]


def _features(name: str, cols: list[str]) -> None:
    QUERIES[name] = lambda spark, sf: triage.features(A.chunks(spark, sf), most=None, shaped=None).select("chunk_id", *cols)
    ORACLE[name] = O.sql(O.FEATURES, f"SELECT chunk_id, {', '.join(cols)} FROM flags")


for _name, _cols in (("text_quality", _QUALITY), ("structure_hints", _STRUCTURE), ("entity_hints", _ENTITY), ("event_hints", _EVENT), ("keyword_hits", _WORDS)):
    _features(_name, _cols)


@query(O.TRIAGE, "SELECT chunk_id, round(score, 6) AS score, token_est, low_quality, complex_narrative, route FROM triage")
def triage_score(spark: SparkSession, sf: str) -> DataFrame:
    return A.triaged(spark, sf).select("chunk_id", F.round("score", 6).alias("score"), "token_est", "low_quality", "complex_narrative", "route")


#: A second record of every fifth chunk, with another route, or none, and another estimate; predictions are there for some.
_AGAIN = """recs AS (SELECT chunk_id, 0 AS seq, route, token_est, CASE WHEN token_est % 3 = 0 THEN 'llm_large' WHEN token_est % 3 = 1 THEN '' END AS predicted FROM triage
  UNION ALL SELECT chunk_id, 1, CASE WHEN token_est % 2 = 0 THEN 'skip' END, token_est + 7, NULL FROM triage WHERE token_est % 5 = 0),
named AS (SELECT chunk_id, seq, token_est, coalesce(route, 'unknown') AS route, coalesce(nullif(predicted, ''), coalesce(route, 'unknown')) AS predicted FROM recs),
final AS (SELECT * FROM named n WHERE NOT EXISTS (SELECT 1 FROM named m WHERE m.chunk_id = n.chunk_id AND m.seq > n.seq)),
sides AS (SELECT 'route' AS kind, route, count(*) AS c FROM named GROUP BY ALL UNION ALL SELECT 'predicted_route', predicted, count(*) FROM named GROUP BY ALL)"""


@query(f"{O.TRIAGE}, {_AGAIN}", "SELECT kind, route, c AS count, round(c / (SELECT count(*) FROM triage) * 100, 3) AS pct_of_chunks, coalesce(CASE kind WHEN 'route' THEN (SELECT sum(token_est) FROM final f WHERE f.route = s.route) ELSE (SELECT sum(token_est) FROM final f WHERE f.predicted = s.route) END, 0)::BIGINT AS tokens_est FROM sides s")
def triage_route_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    """Routes and estimates are written once: records and last records both read them, and texts are looked at once."""
    t = written(A.triaged(spark, sf).select("chunk_id", "route", "token_est"))
    n = F.col("token_est")
    first = F.struct(F.lit(0).alias("seq"), "route", n.alias("token_est"), F.when(n % 3 == 0, "llm_large").when(n % 3 == 1, "").alias("predicted_route"))
    second = F.struct(F.lit(1).alias("seq"), F.when(n % 2 == 0, "skip").alias("route"), (n + 7).alias("token_est"), F.lit(None).cast("string").alias("predicted_route"))
    return triage.route_breakdown(t.select("chunk_id", F.explode(F.array_compact(F.array(first, F.when(n % 5 == 0, second)))).alias("x")).select("chunk_id", "x.*"), ["seq"])


@query(O.TRIAGE, "SELECT chunk_id, r.gate, r.predicted, CASE WHEN route = 'skip' AND r.predicted <> 'skip' THEN r.predicted ELSE route END AS effective FROM (SELECT chunk_id, route, CASE WHEN ps >= 0.9 THEN {'gate': 'p_skip_high', 'predicted': 'skip'} WHEN pl >= 0.6 THEN {'gate': 'p_large_high', 'predicted': 'llm_large'} WHEN complex_narrative THEN {'gate': 'complex_narrative', 'predicted': 'llm_large'} WHEN low_quality AND score >= 0.75 THEN {'gate': 'low_quality_high_heuristic_score', 'predicted': 'llm_large'} ELSE {'gate': 'default_llm_small', 'predicted': 'llm_small'} END AS r FROM (SELECT *, (token_est % 20) / 20 AS ps, (token_est % 7) / 10 AS pl FROM triage))")
def route_policy_shadow(spark: SparkSession, sf: str) -> DataFrame:
    p = triage.model_route(F.col("token_est") % 20 / 20, F.col("token_est") % 7 / 10, F.col("route"), "shadow", large=0.6)
    return A.triaged(spark, sf).withColumn("p", p).select("chunk_id", F.col("p.gate").alias("gate"), F.col("p.predicted_route").alias("predicted"), F.col("p.effective_route").alias("effective"))


@query(O.TRIAGE, f"SELECT chunk_id, token_est FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY score DESC, chunk_id) AS r FROM triage) WHERE r <= {PER_FILE} ORDER BY score DESC, chunk_id LIMIT {OVERALL}")
def budget_count_caps(spark: SparkSession, sf: str) -> DataFrame:
    return triage.count_caps(A.triaged(spark, sf), PER_FILE, OVERALL).select("chunk_id", "token_est")


@query(f"{O.TRIAGE}, ord AS (SELECT chunk_id, file_id, token_est, row_number() OVER (ORDER BY score DESC, chunk_id) AS r FROM triage), walk(r, room) AS (SELECT 0::BIGINT, {BUDGET}::BIGINT UNION ALL SELECT r, room FROM (SELECT o.r, w.room - o.token_est AS room, row_number() OVER (ORDER BY o.r) AS k FROM walk w JOIN ord o ON o.r > w.r AND o.token_est <= w.room) WHERE k = 1)", "SELECT chunk_id, file_id, token_est FROM ord SEMI JOIN walk USING (r)")
def budget_token_greedy(spark: SparkSession, sf: str) -> DataFrame:
    scored = written(A.triaged(spark, sf).select("chunk_id", "file_id", "token_est", "score"))
    return triage.token_budget(scored, BUDGET).select("chunk_id", "file_id", "token_est")


@query(O.CHUNKS, "SELECT chunk_id, substr(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[email]', 'g'), '\\+?\\d[\\d() .-]{7,}\\d', '[phone]', 'g'), '\\d', '0', 'g'), '\\s+', ' ', 'g')), 1, 120) AS preview FROM chunks")
def redact_preview(spark: SparkSession, sf: str) -> DataFrame:
    return A.chunks(spark, sf).select("chunk_id", T.redacted_preview(F.col("text")).alias("preview"))


# Loading


_LOAD = "rows AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event, user_id % 50 AS u, CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 3)::INT END AS page FROM events)"


@query(_LOAD, "SELECT DISTINCT event, u, page FROM rows WHERE event IS NOT NULL AND page IS NOT NULL UNION ALL SELECT event, u, page FROM rows WHERE event IS NULL OR page IS NULL")
def load_dedupe_nulls(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    rows = e.select(F.when(F.col("event_id") % 7 != 0, F.col("event_type")).alias("event"), (F.col("user_id") % 50).alias("u"), F.when(F.col("event_id") % 11 != 0, (F.col("event_id") % 3).cast("int")).alias("page"))
    return nulls.unique_rows(rows, ["event", "u", "page"])


_ITEMS = """rec AS (SELECT conv_id, turn, 'c' || conv_id AS file_id, 'c' || conv_id || ':' || turn AS chunk_id, turn FROM conversations)"""


@query(_ITEMS, "SELECT DISTINCT 'E' || (conv_id % 9) AS entity, 'person' AS type, (turn % 5) / 10 AS confidence, file_id, chunk_id, turn::INT AS page_start, (turn + 1)::INT AS page_end, 'said ' || turn AS quote, CASE WHEN turn % 2 = 0 THEN 3 END::INT AS char_start, 'legacy' AS source_phase FROM rec WHERE conv_id % 9 <> 4")
def load_entities(spark: SparkSession, sf: str) -> DataFrame:
    return loading.observations(_entity_records(spark, sf), "entities").select("entity", "type", "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote", "char_start", "source_phase")


def _entity_records(spark: SparkSession, sf: str) -> DataFrame:
    """Extractor records written to text and read again: mixed types, blank entities, repeats."""
    c = A.table(spark, sf, "conversations")
    i, t = F.col("conv_id"), F.col("turn")
    text = lambda x: x.cast("string")
    span = {n: F.lit(None).cast("string") for n in ("char_end", "source_phase", "extractor_version", "prompt_hash", "model")}
    item = F.struct(
        F.when(i % 9 == 4, "  ").otherwise(F.concat(F.lit(" E"), text(i % 9))).alias("entity"), F.lit("person").alias("type"), F.concat(F.lit("said   "), text(t)).alias("quote"), text(t % 5 / 10).alias("confidence"),
        F.when(t % 2 == 0, "3").alias("char_start"), F.when(t % 2 == 0, "9").alias("char_end"), F.lit(None).cast("array<string>").alias("char_range"), *[span[n].alias(n) for n in ("source_phase", "extractor_version", "prompt_hash", "model")],
    )
    return c.select(F.concat(F.lit("c"), text(i)).alias("file_id"), F.concat(F.lit("c"), text(i), F.lit(":"), text(t)).alias("chunk_id"), F.array(F.concat(text(t), F.lit(".0")), text(t + 1)).alias("page_range"), F.array(item, item).alias("items"), *[F.lit(None).cast("string").alias(n) for n in ("model", "error", "source_phase", "extractor_version", "prompt_hash", "_corrupt_record")])


@query(f"{_ITEMS}, rows AS (SELECT DISTINCT conv_id % 9 AS e, turn, chunk_id FROM rec WHERE conv_id % 9 <> 4)", "SELECT n AS records_total, 0 AS json_decode_errors, 0 AS invalid_record_shape, 2 * n AS rows_attempted, 2 * bad AS invalid_item_shape, kept AS rows_inserted, 2 * n - kept AS rows_skipped FROM (SELECT (SELECT count(*) FROM rec) AS n, (SELECT count(*) FROM rec WHERE conv_id % 9 = 4) AS bad, (SELECT count(*) FROM rows) AS kept)")
def load_counters(spark: SparkSession, sf: str) -> DataFrame:
    return loading.load_counts(written(_entity_records(spark, sf)), "entities")


@query(O.EVENTS, "SELECT DISTINCT entity, file_id, chunk_id FROM ent")
def mentions_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return loading.mentions(A.entities(spark, sf))


@query("x AS (SELECT 1)", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    known = A.table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return loading.without_known(A.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), known, "o_orderkey")


@query("n AS (SELECT c_custkey, c_name, -1.0 AS c_acctbal FROM customer WHERE c_nationkey = 3)", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM n) UNION ALL SELECT * FROM n")
def replace_by_file(spark: SparkSession, sf: str) -> DataFrame:
    c = A.table(spark, sf, "customer")
    new = c.where("c_nationkey = 3").select("c_custkey", "c_name", F.lit(-1.0).alias("c_acctbal"))
    return loading.replaced(c.select("c_custkey", "c_name", "c_acctbal"), new, "c_custkey")


@query("x AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id)", "SELECT * FROM x")
def last_record_wins(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return nulls.last_wins(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("r AS (SELECT event_id, CASE WHEN event_id % 23 = 0 THEN '' ELSE 'f' || user_id END AS file_id, (event_id % 7 - 1)::INT AS page_start, (event_id % 5)::INT AS page_end, (event_id % 13) / 10 AS confidence, length(props) AS n FROM events)", "SELECT event_id, CASE WHEN file_id = '' THEN 'missing_file_id' WHEN page_start < 0 OR page_end < page_start THEN 'invalid_page_range' WHEN confidence > 1 THEN 'invalid_confidence' END AS error_code FROM r")
def evidence_ref_errors(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("event_id")
    r = A.table(spark, sf, "events").select(i, F.when(i % 23 == 0, "").otherwise(F.concat(F.lit("f"), F.col("user_id").cast("string"))).alias("file_id"), F.lit("c").alias("chunk_id"), (i % 7 - 1).cast("int").alias("page_start"), (i % 5).cast("int").alias("page_end"), F.lit(None).cast("int").alias("char_start"), F.lit(None).cast("int").alias("char_end"), F.lit("q").alias("quote"), F.lit("p").alias("source_phase"), F.lit(None).cast("string").alias("prompt_hash"), (i % 13 / 10).alias("confidence"))
    return I.evidence_errors(r).select("event_id", "error_code")


# People


@query("x AS (SELECT 1)", "SELECT c_custkey, trim(regexp_replace(lower(c_name || ' -- ' || c_mktsegment), '[^a-z0-9]+', ' ', 'g')) AS name_norm FROM customer")
def name_norm(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "customer").select("c_custkey", T.normal_name(F.concat_ws(" -- ", "c_name", "c_mktsegment")).alias("name_norm"))


@query(O.PEOPLE, 'SELECT key_type, "left", "right" FROM pairs')
def blocking_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return A.pairs(written(A.observations(spark, sf))).select("key_type", "left", "right")


@query(O.PEOPLE, "SELECT key_type, count(*) AS n_groups, sum(n)::BIGINT AS n_members FROM (SELECT key_type, key, count(*) AS n FROM keys GROUP BY ALL HAVING count(*) > 50) GROUP BY key_type")
def oversized_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Groups that a cap of 50 would leave out."""
    return resolve.oversized(resolve.blocking_keys(A.observations(spark, sf)), 50)


@query(O.PEOPLE, "SELECT * FROM sp")
def pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    obs = written(A.observations(spark, sf))
    found, scored = A.scored(obs)
    return resolve.expanded(scored.withColumn("reasons", F.array_join("reasons", "|")), resolve.profile_members(obs, found), "score", "decision", "reasons")


@query(O.PEOPLE, 'SELECT decision, count(*) AS attempted, count(DISTINCT ("left", "right")) AS n_pairs FROM pairs JOIN sp USING ("left", "right") GROUP BY decision')
def decision_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.decision_histogram(A.scored(written(A.observations(spark, sf)))[1])


@query(O.PEOPLE, "SELECT obs_id, person_id FROM mem")
def person_components(spark: SparkSession, sf: str) -> DataFrame:
    return A.people(spark, sf)[1]


_DISPLAY = """SELECT person_id, (SELECT name_norm FROM obs o JOIN mem USING (obs_id) WHERE mem.person_id = m.person_id GROUP BY name_norm ORDER BY count(*) DESC, name_norm LIMIT 1) AS display_name_norm,
  arg_min(name, (length(name), lower(name), name)) AS display_name, CASE WHEN count(DISTINCT dob) = 1 THEN min(dob) END AS dob, count(*) AS n_observations FROM mem m JOIN osig USING (obs_id) GROUP BY person_id"""


@query(O.PEOPLE, _DISPLAY)
def person_display(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.people(A.people(spark, sf)[0].withColumnRenamed("person_id", "root")).withColumnRenamed("root", "person_id")


@query(O.PEOPLE, f"SELECT * EXCLUDE (person_id), row_number() OVER (ORDER BY display_name_norm, coalesce(dob, ''), person_id) AS person_no FROM ({_DISPLAY})")
def person_numbers(spark: SparkSession, sf: str) -> DataFrame:
    people = resolve.people(A.people(spark, sf)[0].withColumnRenamed("person_id", "root"))
    return resolve.person_ids(people).withColumnRenamed("person_id", "person_no").drop("root")


# Dates and timelines


@query(O.TIMES, "SELECT event_id, date_start, date_end, precision, status, parser FROM et WHERE parser = 'absolute_v1' OR parser IS NULL")
def date_absolute(spark: SparkSession, sf: str) -> DataFrame:
    return A.event_times(spark, sf).where("parser = 'absolute_v1' OR parser IS NULL").drop("date_raw")


@query(O.TIMES, "SELECT event_id, date_raw, date_start FROM et WHERE parser = 'relative_v1'")
def date_relative(spark: SparkSession, sf: str) -> DataFrame:
    return A.event_times(spark, sf).where("parser = 'relative_v1'").select("event_id", "date_raw", "date_start")


@query(O.CASES, "SELECT case_id_norm, status, count(*) AS n, min(date_start) AS first_day, max(date_start) AS last_day FROM ec JOIN et USING (event_id) GROUP BY ALL")
def timeline_lanes(spark: SparkSession, sf: str) -> DataFrame:
    t = A.event_cases(spark, sf).join(A.event_times(spark, sf), "event_id")
    return t.groupBy("case_id_norm", "status").agg(F.count("*").alias("n"), F.min("date_start").alias("first_day"), F.max("date_start").alias("last_day"))


@query(O.CASES, "SELECT * FROM ec")
def event_case_links(spark: SparkSession, sf: str) -> DataFrame:
    return A.event_cases(spark, sf)


# Threads


@query(O.TALK, "SELECT segment_id, utterance_count, page_start, page_end, array_to_string(list_transform(pk, lambda x: substr(x, 3)), '|') AS speakers FROM seg")
def segments(spark: SparkSession, sf: str) -> DataFrame:
    s = threads.segments(A.utterances(spark, sf))
    return s.select(F.col("chunk_id").alias("segment_id"), "utterance_count", "page_start", "page_end", F.array_join("speakers", "|").alias("speakers"))


@query(O.TALK, "SELECT chunk_id, array_to_string(top_tokens, ' ') AS top_tokens, substr(sha256(array_to_string(top_tokens, ' ')), 1, 16) AS topic_signature FROM tops")
def segment_top_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return threads.segment_tokens(A.utterances(spark, sf)).select("chunk_id", F.array_join("top_tokens", " ").alias("top_tokens"), "topic_signature")


@query(O.TALK, 'SELECT "left", "right", round(participant_j, 6) AS participant_j, round(topic_j, 6) AS topic_j, score, decision, reasons FROM tp')
def thread_pairs_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return threads.thread_pairs(A.segments(spark, sf)).select("left", "right", F.round("participant_j", 6).alias("participant_j"), F.round("topic_j", 6).alias("topic_j"), "score", "decision", F.array_join("reasons", "|").alias("reasons"))


@query(O.TALK, "SELECT root, case_id_norm, n_segments, sha256(case_id_norm || '|' || names) AS thread_key FROM (SELECT root, case_id_norm, count(*) AS n_segments, string_agg(file_id || ':' || chunk_id, ',' ORDER BY file_id || ':' || chunk_id) AS names FROM tm JOIN seg USING (segment_id) GROUP BY root, case_id_norm)")
def thread_components(spark: SparkSession, sf: str) -> DataFrame:
    s = written(A.segments(spark, sf))
    return threads.threads(s, threads.thread_pairs(s))[1].select("root", "case_id_norm", "n_segments", "thread_key")


_LABELS = """SELECT DISTINCT tm.root, coalesce(a.label, b.label) AS label FROM tm
  LEFT JOIN (SELECT root, string_agg(x, ' ' ORDER BY r) AS label FROM (SELECT root, x, row_number() OVER (PARTITION BY root ORDER BY count(*) DESC, x) AS r FROM (SELECT root, unnest(tt) AS x FROM tm JOIN seg USING (segment_id)) GROUP BY root, x) WHERE r <= 3 GROUP BY root) a USING (root)
  LEFT JOIN (SELECT root, x AS label FROM (SELECT root, x, row_number() OVER (PARTITION BY root ORDER BY count(*) DESC, x) AS r FROM (SELECT root, unnest(pk) AS x FROM tm JOIN seg USING (segment_id)) GROUP BY root, x) WHERE r = 1) b USING (root)"""


@query(O.TALK, _LABELS)
def thread_labels(spark: SparkSession, sf: str) -> DataFrame:
    s = written(A.segments(spark, sf))
    return threads.threads(s, threads.thread_pairs(s))[1].select("root", "label")


# Graph


_EVID = "src_id, dst_id, file_id, chunk_id, page_start, page_end, confidence, source_phase"


@query(O.GRAPH, f"SELECT {_EVID} FROM ev_case")
def kg_event_in_case(spark: SparkSession, sf: str) -> DataFrame:
    return graph.event_in_case(A.events(spark, sf), A.event_cases(spark, sf)).select(*_EVID.split(", "))


@query(O.GRAPH, f"SELECT {_EVID} FROM p_ev")
def kg_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mentioned_in_event(*A.people(spark, sf)[::-1], A.events(spark, sf)).select(*_EVID.split(", "))


@query(O.GRAPH, f"SELECT {_EVID} FROM p_ev JOIN (SELECT chunk_id FROM ev GROUP BY chunk_id HAVING count(*) <= 2) USING (chunk_id)")
def kg_mentions_capped(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mentioned_in_event(*A.people(spark, sf)[::-1], A.events(spark, sf), 5, 2).select(*_EVID.split(", "))


@query(O.GRAPH, f"SELECT {_EVID} FROM p_case")
def kg_person_in_case(spark: SparkSession, sf: str) -> DataFrame:
    who, s = A.found_once(spark, sf)
    return graph.person_in_case(*A.resolved(written(A.observed(who, s)))[::-1], s, T.normal_name(F.col("person_text"))).select(*_EVID.split(", "))


@query(O.GRAPH, "SELECT src_type, src_id, edge_type, dst_type, dst_id, file_id, chunk_id, page_start, page_end, source_phase, max(confidence) AS confidence FROM evid GROUP BY ALL")
def kg_evidence_unique(spark: SparkSession, sf: str) -> DataFrame:
    return graph.unique_evidence(A.evidence(spark, sf)).drop("extractor_version")


@query(O.GRAPH, "SELECT src_type AS type, src_id AS id, count(*) AS n FROM edges WHERE src_type = 'Event' AND src_id::BIGINT % 3 = 0 GROUP BY ALL UNION ALL SELECT dst_type, dst_id, count(*) FROM edges WHERE dst_type = 'Event' AND dst_id::BIGINT % 3 = 0 GROUP BY ALL")
def kg_integrity_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Against nodes that lack every third event."""
    e = written(A.edges(spark, sf))
    ends = e.select(F.col("src_type").alias("type"), F.col("src_id").alias("id")).union(e.select("dst_type", "dst_id")).distinct()
    return graph.dangling(e, ends.where("NOT (type = 'Event' AND try_cast(id AS bigint) % 3 = 0)")).select("type", "id", "n")


def _rank_sql(index: str) -> str:
    at = lambda p: f"min(CASE WHEN r = {index.format(p=p)} + 1 THEN n END)"
    return f"SELECT edge_type, {at(0.5)} AS p50, {at(0.9)} AS p90, {at(0.99)} AS p99, max(n) AS max, count(*) AS n_keys FROM (SELECT edge_type, n, row_number() OVER (PARTITION BY edge_type ORDER BY n) AS r, count(*) OVER (PARTITION BY edge_type) AS c FROM (SELECT edge_type, src_type, src_id, count(*) AS n FROM edges GROUP BY ALL)) GROUP BY edge_type"


@query(O.GRAPH, _rank_sql("floor((c - 1) * {p}::DOUBLE)"))
def edge_volume_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edge_volumes(A.edges(spark, sf))


@query(O.GRAPH, _rank_sql("round_even((c - 1) * {p}::DOUBLE, 0)"))
def edge_volume_percentiles_rounded(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edge_volumes(A.edges(spark, sf), rounded=True)


@query(O.GRAPH, "SELECT edge_type, count(*) AS n FROM edges GROUP BY edge_type ORDER BY n DESC, edge_type LIMIT 20")
def top_edge_types(spark: SparkSession, sf: str) -> DataFrame:
    return graph.top_edge_types(A.edges(spark, sf))


@query(O.GRAPH, "SELECT person, other FROM (SELECT *, row_number() OVER (PARTITION BY person ORDER BY other) AS r FROM (SELECT DISTINCT a.src_id AS person, b.src_id AS other FROM edges a JOIN edges b ON a.dst_id = b.dst_id AND a.src_type = 'Person' AND b.src_type = 'Person' AND a.edge_type = 'IN_CASE' AND b.edge_type = 'IN_CASE' AND a.src_id <> b.src_id)) WHERE r <= 200")
def two_hop(spark: SparkSession, sf: str) -> DataFrame:
    """Only people's cases are written: the filter passes through to the evidence, where other kinds drop out."""
    return graph.two_hop(written(A.edges(spark, sf).where("src_type = 'Person' AND edge_type = 'IN_CASE'")))


@query(O.GRAPH, "SELECT 'case_events' AS kind, 'only_left' AS side, count(*) AS n FROM edges WHERE src_type = 'Event' AND src_id::BIGINT % 50 = 0 UNION ALL SELECT 'case_events', 'only_right', 0")
def parity_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Against an export that lost every fiftieth event. All edges from events are those to their cases, so people aren't resolved for it."""
    e = written(graph.edges(A.case_evidence(spark, sf)))
    return graph.parity(e, e.where("CAST(src_id AS bigint) % 50 <> 0"), "case_events")


@query(O.CASES, "SELECT coalesce(min(d), c) AS case_id_display, c AS case_id_norm, string_agg(DISTINCT s, '|' ORDER BY s) AS sources, starts_with(c, 'file:') AS is_fallback FROM (SELECT value_norm AS c, value AS d, 'identity_signals' AS s FROM sig WHERE attribute = 'case_id' UNION ALL SELECT case_id_norm, NULL, 'event_cases' FROM ec) GROUP BY c")
def case_discovery(spark: SparkSession, sf: str) -> DataFrame:
    return graph.cases(A.signals(spark, sf), A.event_cases(spark, sf)).withColumn("sources", F.array_join("sources", "|"))


@query(O.GRAPH, f"(SELECT src_type, src_id FROM edges WHERE edge_type = 'IN_CASE' AND dst_id = '{CASE}' AND src_type = 'Person' ORDER BY src_id LIMIT 50) UNION ALL (SELECT src_type, src_id FROM edges WHERE edge_type = 'IN_CASE' AND dst_id = '{CASE}' AND src_type = 'Event' ORDER BY src_id LIMIT 50)")
def case_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Only the case's edges are written."""
    return graph.case_overview(written(A.edges(spark, sf).where((F.col("edge_type") == "IN_CASE") & (F.col("dst_id") == CASE))), CASE)


@query(O.GRAPH, f"SELECT event_id, date_start, status FROM ec JOIN et USING (event_id) WHERE case_id_norm = '{CASE}' ORDER BY date_start NULLS LAST, event_id LIMIT 500")
def event_storyline(spark: SparkSession, sf: str) -> DataFrame:
    e = graph.edges(graph.event_in_case(A.events(spark, sf), A.event_cases(spark, sf)))
    return graph.event_storyline(e, A.event_times(spark, sf), CASE).select("event_id", "date_start", "status")


@query(O.GRAPH, "SELECT src_type, edge_type, dst_type, count(*) AS n_items FROM edges GROUP BY ALL")
def cypher_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Edges in the statements of each kind."""
    n = (F.length("statement") - F.length(F.replace("statement", F.lit("{edge_key: '"), F.lit("")))) / F.lit(len("{edge_key: '"))
    return cypher_edges(written(A.edges(spark, sf))).groupBy("src_type", "edge_type", "dst_type").agg(F.sum(n).cast("long").alias("n_items"))


@query(O.GRAPH, "SELECT 'node' AS kind, type, count(*) AS n FROM (SELECT src_type AS type, src_id AS id FROM edges UNION SELECT dst_type, dst_id FROM edges) GROUP BY type UNION ALL SELECT 'edge', edge_type, count(*) FROM edges GROUP BY edge_type UNION ALL SELECT 'evidence', edge_type, count(*) FROM evid GROUP BY edge_type")
def kg_counts(spark: SparkSession, sf: str) -> DataFrame:
    evidence = written(A.evidence(spark, sf).select(*graph.EDGE))
    e = written(graph.edges(evidence))
    nodes = e.select(F.col("src_type").alias("type"), F.col("src_id").alias("id")).union(e.select("dst_type", "dst_id")).distinct()
    return graph.counted(e, evidence, nodes)


_LOST = "src_type = 'Person' AND src_id LIKE '%5' OR src_type = 'Event' AND right(src_id, 2) = '07'"
_SETS = """SELECT '{side}' AS side, 'case_events' AS kind, dst_id AS key, src_id AS value FROM {t} WHERE edge_type = 'IN_CASE' AND src_type = 'Event' UNION ALL SELECT '{side}', 'case_people', dst_id, src_id FROM {t} WHERE edge_type = 'IN_CASE' AND src_type = 'Person'
  UNION ALL SELECT '{side}', 'person_cases', src_id, dst_id FROM {t} WHERE edge_type = 'IN_CASE' AND src_type = 'Person' UNION ALL SELECT '{side}', 'person_events', src_id, dst_id FROM {t} WHERE edge_type = 'MENTIONED_IN_EVENT'
  UNION ALL SELECT '{side}', 'person_twohop_via_case', a.src_id, b.src_id FROM {t} a JOIN {t} b ON a.dst_id = b.dst_id AND a.src_type = 'Person' AND b.src_type = 'Person' AND a.edge_type = 'IN_CASE' AND b.edge_type = 'IN_CASE' AND a.src_id <> b.src_id"""


@query(f"{O.GRAPH}, less AS (SELECT * FROM edges WHERE NOT ({_LOST})), sides AS ({_SETS.format(side='L', t='edges')} UNION ALL {_SETS.format(side='R', t='less')}), held AS (SELECT kind, key, value, bool_or(side = 'L') AS l, bool_or(side = 'R') AS r FROM sides GROUP BY ALL)", "SELECT kind, substr(sha256(key), 1, 12) AS key, count(*) FILTER (l) AS only_left, count(*) FILTER (r) AS only_right FROM held WHERE l <> r GROUP BY ALL UNION ALL SELECT 'count', 'kg_edges', 1, 1 UNION ALL SELECT 'count', 'kg_edge_evidence', 1, 1")
def kg_parity_report(spark: SparkSession, sf: str) -> DataFrame:
    """Against an export that lost some people's and events' edges and evidence."""
    evidence = written(A.evidence(spark, sf).select(*graph.EDGE))
    e = written(graph.edges(evidence))
    kept = F.expr(f"NOT ({_LOST})")
    return graph.parity_report(e, e.where(kept), evidence, evidence.where(kept))


_WHO = "(SELECT min(src_id) FROM edges WHERE src_type = 'Person' AND edge_type = 'IN_CASE')"


@query(O.GRAPH, f"(SELECT dst_type, dst_id FROM edges WHERE src_type = 'Person' AND src_id = {_WHO} AND edge_type = 'IN_CASE' ORDER BY dst_id LIMIT 50) UNION ALL (SELECT dst_type, dst_id FROM edges WHERE src_type = 'Person' AND src_id = {_WHO} AND edge_type = 'MENTIONED_IN_EVENT' ORDER BY dst_id LIMIT 50)")
def kg_person_profile(spark: SparkSession, sf: str) -> DataFrame:
    e = written(A.edges(spark, sf).where("src_type = 'Person'"))
    who = e.where("src_type = 'Person' AND edge_type = 'IN_CASE'").agg(F.min("src_id")).first()[0]
    return graph.person_profile(e, who)


@query(f"{O.CASES}, k AS (SELECT DISTINCT value_norm AS c FROM sig WHERE attribute = 'case_id'), n AS (SELECT DISTINCT case_id_norm AS c FROM ec WHERE event_id % 2 = 0)", "SELECT coalesce(k.c, n.c) AS case_id_norm, coalesce('known ' || k.c, n.c) AS case_id_display, CASE WHEN n.c IS NOT NULL THEN 'event_cases' ELSE 'identity_signals' END AS sources, starts_with(coalesce(n.c, k.c), 'file:') AS is_fallback FROM k FULL JOIN n USING (c)")
def case_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Cases that signals named, with names of their own, then those that half of the events are in."""
    none = A.event_cases(spark, sf).limit(0)
    known = graph.cases(A.signals(spark, sf), none).withColumn("case_id_display", F.concat(F.lit("known "), "case_id_norm"))
    new = graph.cases(A.signals(spark, sf).limit(0), A.event_cases(spark, sf).where("event_id % 2 = 0"))
    return graph.merged_cases(known, new).withColumn("sources", F.array_join("sources", "|"))


@query(O.GRAPH, "SELECT count(*) AS n FROM (SELECT chunk_id FROM ev WHERE chunk_id IN (SELECT chunk_id FROM obs) GROUP BY chunk_id HAVING count(*) > 2)")
def kg_skipped_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return graph.skipped_chunks(*A.people(spark, sf)[::-1], A.events(spark, sf), 5, 2)


@query(f"{O.CASES}, part AS (SELECT e.*, ec.case_id_norm FROM ev e JOIN ec USING (event_id) WHERE user_id % 5 <> 4)", "SELECT chunk_id, coalesce(a, b, 'file:' || file_id) AS case_id_norm, CASE WHEN a IS NOT NULL THEN 'identity_signals' WHEN b IS NOT NULL THEN 'event_cases' ELSE 'fallback_file' END AS case_source FROM (SELECT chunk_id, file_id, (SELECT min(value_norm) FROM sig WHERE sig.chunk_id = c.chunk_id AND attribute = 'case_id') AS a, (SELECT min(case_id_norm) FROM part WHERE part.chunk_id = c.chunk_id) AS b FROM evc c)")
def segment_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of events as segments; no case is known of every fifth user's events."""
    e = A.events(spark, sf)
    known = A.event_cases(spark, sf).join(e.where("user_id % 5 <> 4").select("event_id"), "event_id", "left_semi")
    return threads.segment_cases(A.event_chunks(spark, sf).select("file_id", "chunk_id"), A.signals(spark, sf), e, known).select("chunk_id", "case_id_norm", "case_source")


@query(f"{O.PEOPLE}, {O.TALK}, who AS (SELECT name_norm, min(obs_id) AS person_id FROM obs GROUP BY name_norm)", f"SELECT chunk_id, array_to_string(list_sort(list_distinct(list(coalesce('p:' || person_id, 's:' || n)))), '|') AS participant_keys FROM (SELECT DISTINCT chunk_id, {O._NORM.format('speaker')} AS n FROM ut) u LEFT JOIN who ON who.name_norm = u.n GROUP BY chunk_id")
def segment_participants(spark: SparkSession, sf: str) -> DataFrame:
    """Speakers who have the name of someone seen in the events are that person."""
    people = A.observations(spark, sf).groupBy(F.col("name_norm").alias("display_name_norm")).agg(F.min("obs_id").alias("person_id"))
    return threads.participants(threads.segments(A.utterances(spark, sf)), people).select("chunk_id", F.array_join("participant_keys", "|").alias("participant_keys"))


# Read models


_SCOPE = f"scope AS (SELECT DISTINCT file_id, chunk_id FROM ev WHERE event_id IN (SELECT event_id FROM ec WHERE case_id_norm = '{CASE}') UNION SELECT file_id, chunk_id FROM sig WHERE attribute = 'case_id' AND value_norm = '{CASE}')"
_ALL = "everything AS (SELECT 'entities' AS source_table, file_id, chunk_id, page_start::INT AS page_start, page_end::INT AS page_end, confidence, quote, NULL AS date_start FROM ent UNION ALL SELECT 'events', e.file_id, chunk_id, page_start::INT, page_end::INT, confidence, quote, date_start FROM ev e LEFT JOIN et USING (event_id) UNION ALL SELECT 'identity_signals', file_id, chunk_id, page_start::INT, page_end::INT, confidence, quote, NULL FROM sig)"


@query(f"{O.CASES}, {_SCOPE}, {_ALL}", f"SELECT (SELECT count(*) FROM ec WHERE case_id_norm = '{CASE}') AS event_count, (SELECT count(*) FROM ec JOIN et USING (event_id) WHERE case_id_norm = '{CASE}' AND status <> 'ok') AS unresolved_date_count, (SELECT count(*) FROM everything SEMI JOIN scope USING (file_id, chunk_id)) AS evidence_count, (SELECT count(DISTINCT lower(trim(entity))) FROM ent SEMI JOIN scope USING (file_id, chunk_id) WHERE type = 'person') AS people_count")
def case_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = A.store(spark, sf)
    return readmodels.case_view(s, CASE).frames["summary"]


@query(f"{O.CASES}, {_SCOPE}", "SELECT entity, type, count(*) AS occurrences, max(confidence) AS max_confidence FROM ent SEMI JOIN scope USING (file_id, chunk_id) GROUP BY entity, type ORDER BY occurrences DESC, lower(entity), lower(type) LIMIT 25")
def case_entities(spark: SparkSession, sf: str) -> DataFrame:
    return readmodels.case_view(A.store(spark, sf), CASE).frames["linked_entities"]


@query(f"{O.CASES}, {_ALL}", f"SELECT source_table, chunk_id, page_start, page_end, confidence, quote FROM everything SEMI JOIN (SELECT DISTINCT file_id, chunk_id FROM ev JOIN ec USING (event_id) WHERE case_id_norm = '{CASE}') c USING (file_id, chunk_id) WHERE coalesce(confidence, -1.0) >= 0.2 AND coalesce(date_start, '') <= '2024-01-20' AND lower(coalesce(quote, '')) LIKE '%e%'")
def evidence_filtered(spark: SparkSession, sf: str) -> DataFrame:
    s, f = A.store(spark, sf), readmodels.Filters(confidence_min=0.2, date_end="2024-01-20", query="E")
    rows = readmodels.evidence_union(s).join(readmodels.case_chunks(s, CASE, signals=False), ["file_id", "chunk_id"], "left_semi")
    return rows.where(readmodels.evidence_filter(f)).select("source_table", "chunk_id", "page_start", "page_end", "confidence", "quote")


@query(f"{O.CASES}, {_ALL}", f"SELECT page_start, count(*) AS n FROM (SELECT page_start FROM everything SEMI JOIN (SELECT DISTINCT file_id, chunk_id FROM ev JOIN ec USING (event_id) WHERE case_id_norm = '{CASE}') c USING (file_id, chunk_id) ORDER BY page_start NULLS FIRST LIMIT 10 OFFSET 10) GROUP BY page_start")
def evidence_page(spark: SparkSession, sf: str) -> DataFrame:
    """The second page; rows of one page number tie, so they are counted."""
    return readmodels.evidence_browser(A.store(spark, sf), CASE, page=2, page_size=10).frames["evidence"].groupBy("page_start").agg(F.count("*").alias("n"))


@query(O.CASES, f"SELECT event_id, date_raw AS date, date_start, status FROM (SELECT event_id FROM ec WHERE case_id_norm = '{CASE}' ORDER BY event_id LIMIT 500) JOIN et USING (event_id)")
def case_timeline(spark: SparkSession, sf: str) -> DataFrame:
    r = readmodels.case_timeline(A.store(spark, sf), CASE).frames
    return r["normalised"].unionByName(r["unresolved"]).select("event_id", "date", "date_start", "status")


@query(f"{O.PEOPLE}, {_SCOPE}", "SELECT DISTINCT m.person_id, o.name FROM mem m JOIN obs o USING (obs_id) SEMI JOIN scope ON scope.file_id = o.file_id AND scope.chunk_id = o.chunk_id")
def profile_aliases(spark: SparkSession, sf: str) -> DataFrame:
    s = A.store(spark, sf)
    return A.people(spark, sf)[0].join(readmodels.case_chunks(s, CASE), ["file_id", "chunk_id"], "left_semi").select("person_id", "name").distinct()


@query(f"{O.PEOPLE}, {_SCOPE}, ins AS (SELECT obs_id, person_id FROM mem JOIN obs USING (obs_id) SEMI JOIN scope USING (file_id, chunk_id))", "SELECT (SELECT count(DISTINCT person_id) FROM ins) AS people_clusters, count(*) FILTER (decision = 'auto_merge') AS merge_auto_merge, count(*) FILTER (decision = 'needs_review') AS merge_needs_review, count(*) FILTER (decision = 'no_merge') AS merge_no_merge FROM sp WHERE \"left\" IN (SELECT obs_id FROM ins) AND \"right\" IN (SELECT obs_id FROM ins)")
def indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs are made of the case's observations alone: others don't count there."""
    obs = written(A.observations(spark, sf))
    found, scored = A.scored(obs)
    scored = written(scored)
    members = resolve.clustered_profiles(obs, found, scored).withColumnRenamed("root", "person_id")
    s = A.store(spark, sf) | {"person_cluster_members": members, "person_observations": obs}
    own = written(obs.join(readmodels.case_chunks(s, CASE), ["file_id", "chunk_id"], "left_semi"))
    s["person_resolution_edges"] = resolve.expanded(scored, resolve.profile_members(own, found), "decision")
    return readmodels.case_indicators(s, CASE).frames["dedupe"]


# Quality and route model


_REC = """rec AS (SELECT ['entities', 'events', 'conversations', 'identity_signals'][k + 1] AS extractor, chunk_id, token_est, ((token_est + k) % 4)::INT AS n_items,
  CASE WHEN (token_est + k) % 13 = 0 THEN 'invalid_json' WHEN (token_est + k) % 17 = 0 THEN 'rules_error' END AS error, CASE WHEN token_est % 2 = 0 THEN 'm1' ELSE '' END AS model, route, CASE WHEN token_est % 3 = 0 THEN 'llm_large' ELSE route END AS predicted_route FROM triage, (SELECT unnest([0, 1, 2, 3]) AS k))"""


def _records(spark: SparkSession, sf: str, chunks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    t = written(triage.triaged(chunks if chunks is not None else A.chunks(spark, sf), most=None, shaped=None).select("chunk_id", "file_id", "text", "token_est", "route", "low_quality", "score"))
    k, n = F.col("k"), F.col("token_est") + F.col("k")
    rows = t.withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    error = F.when(n % 13 == 0, "invalid_json").when(n % 17 == 0, "rules_error")
    recs = rows.select(F.element_at(F.array(*map(F.lit, routeml.EXTRACTORS)), k + 1).alias("extractor"), "chunk_id", (n % 4).cast("int").alias("n_items"), error.alias("error"), F.when(F.col("token_est") % 2 == 0, "m1").otherwise("").alias("model"))
    return recs, t.withColumn("predicted_route", F.when(F.col("token_est") % 3 == 0, "llm_large").otherwise(F.col("route")))


@query(f"{O.TRIAGE}, {_REC}", "SELECT extractor, route, predicted_route, model, count(*) AS records, count(*) FILTER (n_items > 0 AND error IS NULL) AS with_items, count(*) FILTER (error IS NOT NULL) AS with_error, count(*) FILTER (error = 'invalid_json') AS invalid_json, round(count(*) FILTER (n_items > 0 AND error IS NULL) / count(*) * 100, 3) AS yield_pct, round(count(*) FILTER (error IS NOT NULL) / count(*) * 100, 3) AS error_pct, round(count(*) FILTER (error = 'invalid_json') / count(*) * 100, 3) AS invalid_json_pct FROM (SELECT * REPLACE (coalesce(nullif(model, ''), 'unknown') AS model) FROM rec) GROUP BY GROUPING SETS ((extractor), (extractor, route), (extractor, predicted_route), (predicted_route), (route, model))")
def yield_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    recs, t = _records(spark, sf)
    return validate.yield_sets(validate.llm_rows(recs, t))


@query(f"{O.TRIAGE}, {_REC}", "SELECT chunk_id FROM rec GROUP BY chunk_id HAVING bool_or(coalesce(error = 'invalid_json', false)) OR sum(n_items) = 0")
def retry_set(spark: SparkSession, sf: str) -> DataFrame:
    return validate.retry_chunks(_records(spark, sf)[0])


_PAGE_FACTS = "facts AS (SELECT *, CASE page_index % 3 WHEN 0 THEN 'pdf_text' WHEN 1 THEN 'ocr' END AS source, page_index % 7 = 5 AS flagged FROM pages), asked AS (SELECT * FROM rec WHERE extractor <> 'identity_signals')"
_ROLLUP = """SELECT *, round(chunks_with_entities / total_chunks * 100, 3) AS entity_yield_pct, round(chunks_with_events / total_chunks * 100, 3) AS event_yield_pct, round(llm_invalid_json_records / llm_total_records * 100, 3) AS llm_invalid_json_rate_pct,
  round(empty_text_pages / total_pages * 100, 3) AS empty_text_page_rate_pct, round(pages_ocr / total_pages * 100, 3) AS ocr_page_rate_pct, round(pages_low_quality / total_pages * 100, 3) AS low_quality_page_rate_pct,
  round(routed_to_llm_chunks / total_chunks * 100, 3) AS routed_to_llm_pct, round(predicted_routed_to_llm_chunks / total_chunks * 100, 3) AS predicted_routed_to_llm_pct, round(chunks_with_entities * 1000 / total_chunks, 3) AS entities_per_1k_chunks,
  round(chunks_with_events * 1000 / total_chunks, 3) AS events_per_1k_chunks, round((SELECT count(*) FROM rec WHERE extractor = 'conversations' AND n_items > 0 AND error IS NULL) * 1000 / total_chunks, 3) AS conversations_per_1k_chunks,
  round((SELECT count(DISTINCT chunk_id) FROM asked WHERE n_items > 0 AND error IS NULL) * 1000 / total_chunks, 3) AS yield_per_1k_chunks, 4 AS json_decode_errors_chunks,
  CASE WHEN pages_low_quality / total_pages > 0.3 THEN 'phase3_low_quality_page_rate_high' ELSE '' END AS warnings FROM (SELECT
  (SELECT count(DISTINCT file_id) FROM facts) AS docs, (SELECT count(*) FROM facts) AS total_pages, (SELECT count(*) FROM facts WHERE NOT regexp_matches(text, '\\S')) AS empty_text_pages, (SELECT count(*) FROM facts WHERE source = 'pdf_text') AS pages_pdf_text,
  (SELECT count(*) FROM facts WHERE source = 'ocr') AS pages_ocr, (SELECT count(*) FROM facts WHERE flagged OR NOT regexp_matches(text, '\\S')) AS pages_low_quality, (SELECT count(*) FROM triage) AS total_chunks, (SELECT count(*) FROM triage WHERE dialogue) AS dialogue_chunks,
  (SELECT count(*) FROM triage) AS triage_records, (SELECT count(*) FROM triage WHERE route LIKE 'llm%') AS routed_to_llm_chunks, (SELECT sum(token_est)::BIGINT FROM triage WHERE route LIKE 'llm%') AS routed_to_llm_tokens_est,
  (SELECT count(*) FROM triage WHERE route LIKE 'llm%' OR token_est % 3 = 0) AS predicted_routed_to_llm_chunks, (SELECT sum(token_est)::BIGINT FROM triage WHERE route LIKE 'llm%' OR token_est % 3 = 0) AS predicted_routed_to_llm_tokens_est,
  (SELECT count(*) FROM rec WHERE extractor = 'entities') AS entity_records, (SELECT count(*) FROM rec WHERE extractor = 'events') AS event_records, (SELECT count(*) FROM rec WHERE extractor = 'entities' AND n_items > 0) AS chunks_with_entities,
  (SELECT count(*) FROM rec WHERE extractor = 'events' AND n_items > 0) AS chunks_with_events, (SELECT count(*) FROM asked) AS llm_total_records, (SELECT count(*) FROM asked WHERE error = 'invalid_json') AS llm_invalid_json_records)"""


@query(f"{O.TRIAGE}, {_REC}, {_PAGE_FACTS}", _ROLLUP)
def qa_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Pages get a source and a flag by their number. Pages and chunks are written once, as several parts read them."""
    i = F.col("page_index")
    pages = written(A.pages(spark, sf))
    chunks = written(A.whole_chunks(pages))
    recs, t = _records(spark, sf, chunks)
    facts = pages.withColumns({"source": F.when(i % 3 == 0, "pdf_text").when(i % 3 == 1, "ocr"), "quality_flags": F.array_compact(F.array(F.lit("review"), F.when(i % 7 == 5, "low_text")))})
    return validate.rollup(facts, chunks, t, recs, {"chunks": 4}).drop("low_quality_chunks").withColumn("warnings", F.array_join("warnings", "|"))


@query(f"{O.TRIAGE}, {_REC}, ways AS (SELECT 'route' AS kind, route AS dest, extractor, n_items, error FROM rec UNION ALL SELECT 'predicted_route', predicted_route, extractor, n_items, error FROM rec)", "SELECT *, CASE WHEN records > 0 THEN round(with_items / records * 100, 3) ELSE 0.0 END AS yield_pct, CASE WHEN records > 0 THEN round(with_error / records * 100, 3) ELSE 0.0 END AS error_rate_pct FROM (SELECT kind, extractor, count(*) FILTER (dest LIKE 'llm%') AS records, count(*) FILTER (dest LIKE 'llm%' AND n_items > 0 AND error IS NULL) AS with_items, count(*) FILTER (dest LIKE 'llm%' AND error IS NOT NULL) AS with_error FROM ways GROUP BY ALL)")
def yield_of_routed(spark: SparkSession, sf: str) -> DataFrame:
    recs, t = _records(spark, sf)
    return validate.routed_yields(validate.llm_rows(recs, t))


@query("p AS (SELECT doc_id AS file_id, chunk AS i FROM documents, (SELECT unnest(generate_series(0, 3)) AS chunk) WHERE chunk <= doc_id % 4)", "SELECT file_id, count(*) AS page_count, round(avg(greatest(0.0, least(1.0, coalesce(CASE WHEN (file_id + i) % 6 <> 5 THEN ((file_id + i) % 6 - 1) / 3 END, 0.0)))), 6) AS quality_score FROM p GROUP BY file_id")
def document_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Up to four pages a document; scores below 0, above 1 and missing."""
    p = A.table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int"))).alias("i"))
    n = (F.col("file_id") + F.col("i")) % 6
    return validate.document_quality(p.withColumn("quality_score_page", F.when(n != 5, (n - 1) / 3)))


@query(O.TALK, "SELECT 'conversation_segments' AS \"check\", (SELECT count(*) FROM seg) AS n UNION ALL SELECT 'conversation_threads', (SELECT count(DISTINCT root) FROM tm) UNION ALL SELECT 'conversation_thread_segments', (SELECT count(*) FROM seg) UNION ALL SELECT 'conversation_thread_participants', (SELECT count(*) FROM seg, unnest(pk)) UNION ALL SELECT 'missing_thread_segments', (SELECT count(*) FROM seg WHERE utterance_count = 1) UNION ALL SELECT 'invalid_participant_keys', (SELECT count(*) FROM seg, unnest(pk) AS u(k) WHERE k LIKE 's:assistant%')")
def thread_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Against segments that lost those of one utterance, and participants of whom some lost their prefix."""
    s = written(A.segments(spark, sf))
    members, heads = threads.threads(s, threads.thread_pairs(s))
    who = threads.participant_rows(members, s).withColumn("participant_key", F.regexp_replace("participant_key", "^s:assistant", "assistant"))
    return validate.thread_checks({"conversation_segments": s, "conversation_threads": heads, "conversation_thread_segments": members, "conversation_thread_participants": who} | {"conversation_segments": s.where("utterance_count > 1").unionByName(s.where("utterance_count = 1").withColumn("segment_id", F.concat(F.lit("lost "), "segment_id")))})


@query(f"{O.TRIAGE}, {_REC}, y AS (SELECT chunk_id, sum(CASE WHEN error IS NULL THEN n_items ELSE 0 END) AS s, sum(CASE WHEN error IS NULL AND n_items = 3 THEN 1 ELSE 0 END) AS l FROM rec GROUP BY chunk_id)", "SELECT chunk_id, s > 0 AS any_yield, l > 0 AS any_large_yield, CASE WHEN token_est % 29 = 0 THEN 'llm_large' WHEN l > 0 AND s = 0 THEN 'llm_large' WHEN s > 0 OR token_est % 5 > 2 THEN 'llm_small' ELSE 'skip' END AS label_route, CASE WHEN token_est % 29 = 0 THEN 'human' WHEN l > 0 AND s = 0 THEN 'empirical_large_yield' WHEN s > 0 THEN 'heuristic_from_yield' WHEN token_est % 5 > 2 THEN 'downstream_utility' ELSE 'heuristic_from_yield' END AS label_source FROM triage JOIN y USING (chunk_id)")
def route_dataset(spark: SparkSession, sf: str) -> DataFrame:
    recs, t = _records(spark, sf)
    one = recs.withColumn("order", F.lit(0))
    big = one.withColumn("n_items", F.when(F.col("n_items") == 3, 1).otherwise(0))
    human = t.where("token_est % 29 = 0").select("chunk_id", F.sha2("text", 256).alias("chunk_text_hash"), F.lit("llm_large").alias("label_route"))
    useful = t.select("chunk_id", F.greatest(F.lit(0), F.col("token_est") % 5 - 2).alias("utility"))
    return routeml.route_dataset(t, t, routeml.outcomes(one, "order"), routeml.outcomes(big, "order"), human, useful).select("chunk_id", "any_yield", "any_large_yield", "label_route", "label_source")


_DOCS = "docs AS (SELECT doc_id AS row_id, lang AS label, text FROM documents), tok AS (SELECT row_id, label, lower(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+'))) AS token FROM docs), vocab AS (SELECT token, count(*) AS tf, count(DISTINCT row_id) AS df FROM tok GROUP BY token HAVING count(DISTINCT row_id) >= 2 ORDER BY tf DESC, token LIMIT 500)"
LANGS = ("en", "de", "fr", "es")


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return A.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), "text")


@query(_DOCS, "SELECT * FROM vocab")
def vocab_tf_df(spark: SparkSession, sf: str) -> DataFrame:
    return routeml.vocabulary(_docs(spark, sf), 500)


@query(_DOCS, "SELECT label, token, round(ln((n + 1.0) / (total + 1.0 * (SELECT count(*) FROM vocab))), 9) AS log_prob FROM (SELECT label, token, count(*) AS n, sum(count(*)) OVER (PARTITION BY label) AS total FROM tok SEMI JOIN vocab USING (token) GROUP BY label, token)")
def nb_log_probs(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf)
    return routeml.bayes(d, written(routeml.vocabulary(d, 500)), classes=LANGS)[1].select("label", "token", F.round("log_prob", 9).alias("log_prob"))


_BAYES = f"""{_DOCS}, nd AS (SELECT label, count(*) AS d FROM docs GROUP BY label), hits AS (SELECT label, token, count(*) AS n FROM tok SEMI JOIN vocab USING (token) GROUP BY ALL), size AS (SELECT label, sum(n) AS total FROM hits GROUP BY label),
cls AS (SELECT label, ln((d + 1.0) / ((SELECT sum(d) FROM nd) + 4.0)) AS prior, total + (SELECT count(*) FROM vocab) AS denom FROM nd JOIN size USING (label) WHERE label IN ('en', 'de', 'fr', 'es')),
mine AS (SELECT row_id, token, count(*) AS n FROM tok GROUP BY ALL),
weigh AS (SELECT row_id, cls.label AS c, any_value(prior) + sum(mine.n * ln((coalesce(hits.n, 0) + 1.0) / denom)) AS s FROM mine CROSS JOIN cls LEFT JOIN hits ON hits.label = cls.label AND hits.token = mine.token GROUP BY ALL
  UNION ALL SELECT row_id, cls.label, prior FROM docs CROSS JOIN cls WHERE row_id NOT IN (SELECT row_id FROM mine)),
said AS (SELECT row_id, arg_max(c, (s, -list_position(['en', 'de', 'fr', 'es'], c))) AS predicted FROM weigh GROUP BY row_id)"""


@query(_BAYES, "SELECT label AS actual, predicted, count(*) AS n FROM docs JOIN said USING (row_id) GROUP BY ALL")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf)
    v = written(routeml.vocabulary(d, 500))
    got = routeml.bayes_predict(d, v, *map(written, routeml.bayes(d, v, classes=LANGS)), classes=LANGS)
    return routeml.confusion(d.join(got, "row_id").select(F.col("label").alias("actual"), "predicted"))


@query("m AS (SELECT l.toxic AS actual, (l.quality + d.n_chars % 2) % 2 AS predicted, count(*) AS n FROM labels l JOIN documents d USING (doc_id) WHERE l.toxic IS NOT NULL AND l.quality IS NOT NULL GROUP BY ALL)", "SELECT label, s::BIGINT AS support, round(tp / c, 9) AS precision, round(tp / s, 9) AS recall, round(2 * (tp / c) * (tp / s) / (tp / c + tp / s), 9) AS f1 FROM (SELECT x.label, (SELECT sum(n) FROM m WHERE actual = x.label) AS s, (SELECT sum(n) FROM m WHERE predicted = x.label) AS c, (SELECT sum(n) FROM m WHERE actual = x.label AND predicted = x.label) AS tp FROM (SELECT unnest([0, 1]) AS label) x)")
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.table(spark, sf, "labels").where("toxic IS NOT NULL AND quality IS NOT NULL").join(A.table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    m = routeml.confusion(rows.withColumn("p", ((F.col("quality") + F.col("n_chars") % 2) % 2).cast("int")), "toxic", "p")
    return routeml.class_metrics(m).select(F.col("label").cast("int").alias("label"), "support", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


_EVAL = "x AS (SELECT CASE token_est % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'llm_large' ELSE 'llm_small' END AS actual, CASE token_est % 3 WHEN 0 THEN 'skip' WHEN 1 THEN 'llm_large' ELSE 'llm_small' END AS predicted, route, token_est FROM triage)"
_F1 = " + ".join(f"coalesce((SELECT 2.0 * count(*) FILTER (actual = '{c}' AND predicted = '{c}') / nullif(count(*) FILTER (actual = '{c}') + count(*) FILTER (predicted = '{c}'), 0) FROM x), 0.0)" for c in routeml.ROUTES)


@query(f"{O.TRIAGE}, {_EVAL}", f"SELECT round(count(*) FILTER (actual = predicted) / count(*), 9) AS accuracy, round(({_F1}) / 3, 9) AS macro_f1, round(count(*) FILTER (actual <> 'skip' AND predicted <> 'skip') / count(*) FILTER (actual <> 'skip'), 9) AS llm_send_recall_model, round(count(*) FILTER (actual <> 'skip' AND route <> 'skip') / count(*) FILTER (actual <> 'skip'), 9) AS llm_send_recall_heuristic, count(*) FILTER (actual <> 'skip') AS llm_send_support, count(*) FILTER (predicted <> 'skip') AS predicted_llm_chunks, round(count(*) FILTER (predicted <> 'skip') / count(*), 9) AS predicted_llm_ratio, sum(token_est) FILTER (predicted <> 'skip')::BIGINT AS predicted_llm_tokens_est, count(*) FILTER (predicted = 'skip') AS predicted_skip, count(*) FILTER (predicted = 'llm_small') AS predicted_llm_small, count(*) FILTER (predicted = 'llm_large') AS predicted_llm_large FROM x")
def model_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    n, names = F.col("token_est"), F.array(*map(F.lit, ("skip", "llm_large", "llm_small", "llm_small")))
    rows = A.triaged(spark, sf).select("token_est", F.col("route").alias("triage_route"), F.get(names, n % 4).alias("actual"), F.get(names, n % 3).alias("predicted"))
    got = routeml.evaluated(rows)
    return got.withColumns({c: F.round(c, 9) for c in ("accuracy", "macro_f1", "llm_send_recall_model", "llm_send_recall_heuristic", "predicted_llm_ratio")})


@query(None)
def label_bands(spark: SparkSession, sf: str) -> DataFrame:
    t = written(A.triaged(spark, sf).select("chunk_id", "file_id", "text", "score"))
    return routeml.label_bands(t, (0.0, 0.4), (0.6, 1.0), 50)


# Streams, as tables


@query("x AS (SELECT 1)", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    return streams.windowed_counts(A.table(spark, sf, "events"))


@query("g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), h AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)", "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM h GROUP BY user_id, k")
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return streams.sessions(A.table(spark, sf, "events"))


@query("w AS (SELECT user_id, event_id, (event_id % 40 + 1)::INT AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id::VARCHAR) AS r FROM events), walk(user_id, r, spent, taken) AS (SELECT user_id, 0::BIGINT, 0, false FROM (SELECT DISTINCT user_id FROM w) UNION ALL SELECT w.user_id, w.r, CASE WHEN k.spent + w.t <= 500 THEN k.spent + w.t ELSE k.spent END, k.spent + w.t <= 500 FROM walk k JOIN w ON w.user_id = k.user_id AND w.r = k.r + 1)", "SELECT 'u' || user_id AS file_id, event_id::VARCHAR AS chunk_id, t AS token_est, taken FROM w JOIN walk USING (user_id, r)")
def stream_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events as a file's chunks, in order of their ids' text."""
    e = A.table(spark, sf, "events")
    rows = e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_id"), F.col("event_id").cast("string").alias("chunk_id"), (F.col("event_id") % 40 + 1).cast("int").alias("token_est"))
    return streams.running_budget(rows, 500)
