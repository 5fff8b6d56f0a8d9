"""python -m caseloom.cli <verb>: the stages over a case store, one verb each.

Every verb reads what the stages before it wrote below --root and writes its own tables there.
"""

from __future__ import annotations

import argparse
import functools
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import normal_name
from caseloom.operators import chunking, extract, graph, ingest, loading, nulls, resolve, routeml, threads, timeline, triage, validate
from caseloom.sources import export, jsonl
from caseloom.sources.scratch import written
from caseloom.sources.store import CaseStore

KINDS = ("entities", "events", "conversations", "identity_signals")
#: Score bands to label by hand.
LOW_BAND, HIGH_BAND = (0.05, 0.20), (0.65, 0.85)
IDS = {"entities": "entity_id", "events": "event_id", "conversations": "conversation_id", "identity_signals": "signal_id"}


def _spark() -> SparkSession:
    return SparkSession.builder.appName("caseloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def manifest(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return jsonl.append_new(ingest.manifest(spark, a.input), f"{a.root}/manifest", "file_id")


def detect(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    probe = ingest.classified(ingest.probed(ingest.contents(spark, a.input)))
    return _save(spark.read.parquet(f"{a.root}/manifest").join(probe, "file_id"), f"{a.root}/phase1")


def phase2(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    targets = ingest.ocr_targets(spark.read.parquet(f"{a.root}/phase1"), a.include_unknown)
    files = ingest.contents(spark, a.input)
    plan = _save(ingest.ocr_plan(targets, ingest.page_texts(files), a.ocr_mode), f"{a.root}/ocr_plan")
    return _save(ingest.ocr_files(files, plan), f"{a.root}/phase2")


def extract_text(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    texts = written(ingest.page_texts(ingest.contents(spark, a.input)))
    scanned = spark.read.parquet(f"{a.root}/phase2") if jsonl.exists(spark, f"{a.root}/phase2") else spark.createDataFrame([], "file_id string, page_index int, text string, status string")
    return _save(ingest.document_pages(spark.read.parquet(f"{a.root}/phase1"), texts, scanned), f"{a.root}/pages")


def pipeline(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Listing, classes and OCR in one go."""
    manifest(spark, a)
    detect(spark, a)
    return phase2(spark, a)


def report(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return validate.class_report(spark.read.parquet(f"{a.root}/phase1"))


def chunk(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    pages = spark.read.parquet(f"{a.root}/pages")
    return _save(chunking.chunks(pages, a.size, a.overlap), f"{a.root}/chunks")


def run_triage(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    packs = jsonl.read_packs(spark, a.packs) if a.packs else None
    rows = spark.read.parquet(f"{a.root}/chunks")
    scored = triage.triaged(triage.with_entities(rows) if a.ner else rows, packs)
    if a.ml_route_mode != "off":
        state, tables = routeml.load_model(spark, a.ml_route_model, a.ml_route_mode)
        scored = triage.with_model(scored, state, tables, a.ml_route_mode, a.ml_route_skip, a.ml_route_large)
    scored = triage.allowed_files(scored, jsonl.read_ids(spark, a.allow), jsonl.read_ids(spark, a.deny))
    out = _save(scored.drop("text"), f"{a.root}/triage")
    live = out.where("route <> 'skip'")
    if a.per_file or a.most:
        live = triage.count_caps(live, a.per_file, a.most)
    if a.tokens:
        live = triage.token_budget(written(live.select("chunk_id", "file_id", "token_est", "score", "route")), a.tokens)
    return _save(live.select("chunk_id", "file_id", "route", "token_est", "score"), f"{a.root}/selected")


def _kinds(a: argparse.Namespace) -> tuple[str, ...]:
    return KINDS if a.kind in (None, "all") else () if a.kind in ("manifest", "chunks") else (a.kind.replace("-", "_"),)


def _asked(spark: SparkSession, a: argparse.Namespace, chunks: DataFrame, kind: str, model: str | None, folder: str) -> DataFrame:
    """Answers for chunks, from the cache where it has them; new ones go there. A cached error is asked again with --retry-errors."""
    cache = f"{a.root}/llm_cache/{folder}/{kind}"
    held = None
    if not a.no_cache and jsonl.exists(spark, cache):
        rows = spark.read.parquet(cache)
        held = nulls.last_wins(rows, ["extractor_version", "chunk_id", "text_hash"], ["cached_at"])
    got = _save(extract.extracted(chunks, kind, extract.provider(a.provider, model), held, version=f"v1:{a.provider}:{model or ''}", retry_errors=a.retry_errors).withColumn("extractor", F.lit(kind)), f"{a.root}/{folder}/{kind}")
    if not a.no_cache:
        key = ["extractor_version", "chunk_id", "text_hash"]
        known = held.where("error IS NULL") if held is not None and a.retry_errors else held
        fresh = got if known is None else got.join(written(known.select(*key)), key, "left_anti")
        fresh.withColumn("cached_at", F.current_timestamp()).write.mode("append").parquet(cache)
    return got


def llm(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The small model over the selected chunks; with --large-model another pass over what failed or is routed to it."""
    chosen = spark.read.parquet(f"{a.root}/selected").select("chunk_id", "route")
    chunks = spark.read.parquet(f"{a.root}/chunks").join(chosen.select("chunk_id"), "chunk_id", "left_semi")
    out = None
    for kind in _kinds(a):
        got = _asked(spark, a, chunks, kind, a.model, "llm")
        out = got if out is None else out.unionByName(got)
    if a.large_model:
        again = written(validate.retry_chunks(out, len(_kinds(a))).union(chosen.where("route = 'llm_large'").select("chunk_id")).distinct())
        for kind in _kinds(a):
            out = out.unionByName(_asked(spark, a, chunks.join(again, "chunk_id", "left_semi"), kind, a.large_model, "llm_large"))
    return out


def _records(spark: SparkSession, a: argparse.Namespace, folder: str, kinds: tuple[str, ...] = KINDS) -> DataFrame | None:
    """What the models answered, of all kinds that were asked for."""
    there = [spark.read.parquet(p) for k in kinds if jsonl.exists(spark, p := f"{a.root}/{folder}/{k}")]
    return functools.reduce(DataFrame.unionByName, there) if there else None


def _load_manifest(spark: SparkSession, a: argparse.Namespace, store: CaseStore) -> DataFrame:
    rows = spark.read.parquet(f"{a.root}/manifest")
    known = store.read("files") if store.has("files") else None
    fresh = written(loading.files(rows) if known is None else loading.files(rows).join(known.select("file_id"), "file_id", "left_anti"))
    store.write("files", fresh, "append")
    return rows.agg(F.count("*").alias("records_total"), F.count_if(F.trim(F.coalesce("file_id", F.lit(""))) == "").alias("invalid_record_shape")).join(fresh.agg(F.count("*").alias("rows_inserted")), F.lit(True))


def _load_chunks(spark: SparkSession, a: argparse.Namespace, store: CaseStore) -> DataFrame:
    rows = spark.read.parquet(f"{a.root}/chunks")
    first, last = loading.chunk_tables(rows, "chunk_id")
    store.write("chunks", first)
    store.write("chunk_text_refs", last)
    return rows.agg(F.count("*").alias("records_total")).join(store.read("chunks").agg(F.count("*").alias("rows_inserted")), F.lit(True)).join(store.read("chunk_text_refs").agg(F.count("*").alias("text_refs_upserted")), F.lit(True))


def load(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """One kind, the manifest, the chunks, or all that is there; a row of counters for each table."""
    store = CaseStore(spark, f"{a.root}/store")
    counts = []
    for name, step in (("manifest", _load_manifest), ("chunks", _load_chunks)):
        if a.kind == name or a.kind == "all" and jsonl.exists(spark, f"{a.root}/{name}"):
            counts.append(step(spark, a, store).withColumn("table", F.lit(name)))
            store.note(f"loader_run:{name}", "ok")
    for kind in _kinds(a):
        raw = spark.read.parquet(f"{a.root}/llm/{kind}")
        if (large := _records(spark, a, "llm_large", (kind,))) is not None:
            raw = raw.unionByName(large)
        items = loading.record_schema(kind).split(">>, ")[0].removeprefix("items ") + ">>"
        none = F.lit(None).cast("string")
        records = raw.select("file_id", "chunk_id", F.col("page_range").cast("array<string>").alias("page_range"), F.from_json("items", items).alias("items"), "model", "error", none.alias("source_phase"), "extractor_version", none.alias("prompt_hash"))
        counts.append(written(loading.load_counts(records, kind, store.read(kind) if store.has(kind) else None)).withColumn("table", F.lit(kind)))
        rows = written(loading.observations(records, kind).withColumn(IDS[kind], F.xxhash64(*loading.KEYS[kind])))
        store.write(kind, rows)
        store.note(f"loader_run:{kind}", "ok")
    if "entities" in _kinds(a):
        store.write("mentions", loading.mentions(store.read("entities")))
    return functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), counts)


def run_resolve(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    s = CaseStore(spark, f"{a.root}/store")
    obs = written(resolve.with_signals(resolve.observed(s.read("entities")), s.read("identity_signals")))
    found = written(resolve.profiles(obs))
    scored = written(resolve.profile_scores(found, a.group))
    clusters = written(resolve.clustered_profiles(obs, found, scored))
    people = written(resolve.person_ids(resolve.people(obs, clusters)))
    s.write("person_observations", obs)
    s.write("person_resolution_edges", resolve.expanded(scored, resolve.profile_members(obs, found, a.group), "score", "decision", "reasons"))
    s.write("person_clusters", people)
    s.write("person_cluster_members", clusters.join(people.select("root", "person_id"), "root").select("obs_id", "person_id"))
    return people


def run_timeline(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    s = CaseStore(spark, f"{a.root}/store")
    ev = s.read("events")
    files = spark.read.parquet(f"{a.root}/manifest").select("file_id", "mtime") if jsonl.exists(spark, f"{a.root}/manifest") else spark.createDataFrame([], "file_id string, mtime string")
    s.write("event_times", timeline.event_times(ev, spark.read.parquet(f"{a.root}/chunks"), files))
    s.write("event_cases", timeline.event_cases(ev, s.read("identity_signals")))
    return s.read("event_times").groupBy("status").count()


def thread(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    s = CaseStore(spark, f"{a.root}/store")
    talk = s.read("conversations")
    segs = threads.segments(talk).join(threads.segment_tokens(talk), ["file_id", "chunk_id"], "left").withColumn("top_tokens", F.coalesce("top_tokens", F.array().cast("array<string>")))
    segs = threads.segment_cases(segs, s.read("identity_signals"), s.read("events"), s.read("event_cases"))
    segs = threads.participants(segs, s.read("person_clusters")).join(timeline.chunk_anchors(spark.read.parquet(f"{a.root}/chunks")).withColumnRenamed("chunk_anchor", "anchor_date"), "chunk_id", "left")
    segs = written(segs.withColumn("segment_id", F.xxhash64("file_id", "chunk_id")))
    pairs = written(threads.thread_pairs(segs))
    members, heads = threads.threads(segs, pairs)
    s.write("conversation_segments", segs)
    s.write("conversation_thread_edges", pairs)
    s.write("conversation_thread_segments", members.withColumnRenamed("root", "thread_id"))
    s.write("conversation_threads", heads.withColumnRenamed("root", "thread_id"))
    s.write("conversation_thread_participants", threads.participant_rows(members, segs))
    return heads


def kg(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Edges and cases of the store, then their export, import text and comparison with the export."""
    kg_materialize(spark, a)
    kg_export(spark, a)
    kg_mirror(spark, a)
    return kg_parity(spark, a)


def kg_materialize(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    s = CaseStore(spark, f"{a.root}/store")
    ev, m, o, sig = s.read("events"), s.read("person_cluster_members"), s.read("person_observations"), s.read("identity_signals")
    rows = graph.event_in_case(ev, s.read("event_cases")).unionByName(graph.mentioned_in_event(m, o, ev, a.people, a.events)).unionByName(graph.person_in_case(m, o, sig, normal_name(F.col("person_text"))))
    s.write("kg_edge_evidence", graph.unique_evidence(rows))
    s.write("kg_edges", graph.edges(s.read("kg_edge_evidence")))
    found = graph.cases(sig, s.read("event_cases"))
    s.write("cases", written(graph.merged_cases(s.read("cases"), found)) if s.has("cases") else found)
    if a.people is not None or a.events is not None:
        s.note("person_event_chunks_skipped_high_fanout", str(graph.skipped_chunks(m, o, ev, a.people, a.events).first().n))
    return s.read("kg_edges")


def _nodes(s: CaseStore) -> DataFrame:
    """type, id of all nodes of the store."""
    node = lambda table, kind, col: s.read(table).select(F.lit(kind).alias("type"), F.col(col).cast("string").alias("id"))
    return node("person_clusters", "Person", "person_id").union(node("events", "Event", "event_id")).union(node("cases", "Case", "case_id_norm")).distinct()


def kg_export(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The graph's five files; with --strict an inconsistent graph is refused."""
    s = CaseStore(spark, f"{a.root}/store")
    graph.validated(s.read("kg_edges"), _nodes(s), a.strict)
    times = s.read("event_times") if s.has("event_times") else None
    export.export_graph(f"{a.root}/kg", s.read("person_clusters"), s.read("events"), times, s.read("cases"), s.read("kg_edges"), s.read("kg_edge_evidence"))
    return graph.counted(s.read("kg_edges"), s.read("kg_edge_evidence"), _nodes(s))


_EXPORTED = {
    "nodes/person": "node_type string, node_id string, display_name string, display_name_norm string, dob string", "nodes/event": "node_type string, node_id string, event string, date_raw string, date_start string, date_end string, precision string, status string",
    "nodes/case": "node_type string, node_id string, case_id_display string, sources array<string>", "edges/edges": "src_type string, src_id string, edge_type string, dst_type string, dst_id string",
    "edges/edge_evidence": "src_type string, src_id string, edge_type string, dst_type string, dst_id string, file_id string, chunk_id string, page_start int, page_end int, confidence double, source_phase string, extractor_version string",
}


def _exported(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    return {name: written(jsonl.good_and_bad(jsonl.read_jsonl(spark, path, _EXPORTED[name]))[0]) for name, path in export.export_paths(spark, f"{a.root}/kg").items()}


def kg_mirror(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The export as Cypher text: constraints, nodes, edges, evidence."""
    files = _exported(spark, a)
    steps = [export.cypher_nodes(files[f"nodes/{k.lower()}"], k) for k in ("Person", "Event", "Case")] + [export.cypher_edges(files["edges/edges"]), export.cypher_evidence(files["edges/edge_evidence"])]
    rows = spark.createDataFrame([(0, t) for t in export.constraints()], "step int, statement string")
    for i, step in enumerate(steps, 1):
        rows = rows.unionByName(step.select(F.lit(i).alias("step"), "statement"))
    rows.orderBy("step", "statement").select("statement").write.mode("overwrite").text(f"{a.root}/kg/cypher")
    return rows


def kg_parity(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Differences of the store's graph and the exported one; with --strict any is an error."""
    s, files = CaseStore(spark, f"{a.root}/store"), _exported(spark, a)
    found = _save(graph.parity_report(s.read("kg_edges"), files["edges/edges"], s.read("kg_edge_evidence"), files["edges/edge_evidence"], a.max_cases, a.max_people), f"{a.root}/kg/parity")
    if a.strict and (n := found.count()):
        raise SystemExit(f"{n} differences between store and export")
    return found


def publish(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """All of kg, and build_manifest.json: counts, volumes, differences."""
    diffs = kg(spark, a)
    s = CaseStore(spark, f"{a.root}/store")
    counts = {f"{r.kind}:{r.type}": r.n for r in graph.counted(s.read("kg_edges"), s.read("kg_edge_evidence"), _nodes(s)).collect()}
    volumes = [r.asDict() for r in graph.edge_volumes(s.read("kg_edges"), rounded=True).orderBy("edge_type").collect()]
    text = export.build_manifest(counts, volumes, diffs.count())
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.root}/kg/build_manifest.json")
    return diffs


def route_dataset(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    s = CaseStore(spark, f"{a.root}/store")
    none = spark.createDataFrame([], "chunk_id string, extractor string, n_items int, error string")
    asked = lambda folder: routeml.outcomes((none if (r := _records(spark, a, folder)) is None else r).withColumn("order", F.lit(0)), "order")
    human = spark.read.schema("chunk_id string, chunk_text_hash string, label_route string").json(a.labels).where(F.col("label_route").isin(*routeml.ROUTES)) if a.labels else None
    used = [s.has(t) for t in ("events", "event_times", "person_observations", "person_cluster_members")]
    useful = routeml.utility(*[s.read(t) for t in ("events", "event_times", "person_observations", "person_cluster_members")]) if all(used) else None
    chunks, scored = spark.read.parquet(f"{a.root}/chunks"), spark.read.parquet(f"{a.root}/triage")
    return _save(routeml.route_dataset(chunks, scored, asked("llm"), asked("llm_large"), human, useful), f"{a.root}/route_dataset")


def route_train(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Fit on the training files, save vocabulary and model; per-class figures of the test files."""
    rows = spark.read.parquet(f"{a.root}/route_dataset").select(F.col("chunk_id").alias("row_id"), "file_id", F.col("label_route").alias("label"), "text")
    rows = written(routeml.group_split(rows, "file_id", a.test_fraction, a.seed))
    train, test = rows.where("NOT is_test"), rows.where("is_test")
    vocab = _save(routeml.vocabulary(train, a.max_features, a.min_df), f"{a.root}/route_model/vocabulary")
    prior, seen = routeml.bayes(train, vocab, alpha=a.alpha)
    prior, seen = _save(prior, f"{a.root}/route_model/prior"), _save(seen, f"{a.root}/route_model/tokens")
    got = routeml.bayes_predict(test, vocab, prior, seen).join(test.select("row_id", F.col("label").alias("actual")), "row_id")
    matrix = _save(routeml.confusion(got), f"{a.root}/route_model/confusion")
    facts = spark.read.parquet(f"{a.root}/route_dataset").select(F.col("chunk_id").alias("row_id"), F.col("route").alias("triage_route"), "token_est")
    _save(routeml.evaluated(got.join(facts, "row_id", "left")), f"{a.root}/route_model/evaluation")
    return _save(routeml.class_metrics(matrix), f"{a.root}/route_model/metrics")


def route_sample_labels(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    rows = spark.read.parquet(f"{a.root}/route_dataset").where("label_source <> 'human' AND score IS NOT NULL")
    return _save(routeml.label_bands(rows, LOW_BAND, HIGH_BAND, a.per_band, a.seed), f"{a.root}/labels_queue")


def run_validate(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """Headline metrics, yields and pages; page texts are reported where pages are."""
    records = [r for r in (_records(spark, a, "llm"), _records(spark, a, "llm_large")) if r is not None]
    none = spark.createDataFrame([], "chunk_id string, extractor string, n_items int, error string, model string")
    recs = functools.reduce(DataFrame.unionByName, records) if records else none
    scored, pages = spark.read.parquet(f"{a.root}/triage"), spark.read.parquet(f"{a.root}/pages")
    rows = written(validate.llm_rows(recs, scored))
    _save(validate.yield_sets(rows), f"{a.root}/validate/yields")
    _save(validate.routed_yields(rows), f"{a.root}/validate/routed")
    _save(triage.route_breakdown(scored), f"{a.root}/validate/routes")
    store = CaseStore(spark, f"{a.root}/store")
    if tables := {t: store.read(t) for t in validate.THREAD_TABLES if store.has(t)}:
        _save(validate.thread_checks(tables), f"{a.root}/validate/threads")
    if "quality_score_page" in pages.columns:
        _save(validate.page_report(pages), f"{a.root}/validate/pages")
        _save(validate.document_quality(pages), f"{a.root}/validate/documents")
    return _save(validate.rollup(pages, spark.read.parquet(f"{a.root}/chunks"), scored, recs), f"{a.root}/validate/rollup")


def _save(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


VERBS = {
    "manifest": manifest, "phase1": detect, "report": report, "phase2": phase2, "pipeline": pipeline, "extract-text": extract_text, "chunk": chunk, "triage": run_triage, "llm": llm, "load": load, "route-dataset": route_dataset,
    "route-train": route_train, "route-sample-labels": route_sample_labels, "validate": run_validate, "resolve": run_resolve, "timeline": run_timeline, "thread": thread, "kg": kg,
    "kg-materialize": kg_materialize, "kg-export": kg_export, "kg-mirror": kg_mirror, "kg-parity": kg_parity, "publish": publish,
}
#: What `run` does, in order.
DEFAULT = ("chunk", "triage", "llm", "load", "resolve", "timeline", "thread", "kg", "validate")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="caseloom", description=__doc__)
    p.add_argument("verb", choices=[*VERBS, "run"])
    p.add_argument("kind", nargs="?", choices=["all", "manifest", "chunks", *(k.replace("_", "-") for k in KINDS)], help="of llm and load: one kind only (manifest and chunks: of load)")
    p.add_argument("--root", required=True, help="where tables are read and written")
    p.add_argument("--input", help="files to list or probe")
    p.add_argument("--steps", default=",".join(DEFAULT), help="of run, in order")
    p.add_argument("--include-unknown", action="store_true", help="of phase2: files of no known class too")
    p.add_argument("--ocr-mode", choices=["image-heavy", "all"], default="image-heavy")
    p.add_argument("--provider", choices=["rules", *extract.Http.SERVERS], default="rules")
    p.add_argument("--model")
    p.add_argument("--large-model")
    p.add_argument("--no-cache", action="store_true", help="of llm: neither read nor write cached answers")
    p.add_argument("--retry-errors", action="store_true", help="of llm: ask again where the cached answer is an error")
    p.add_argument("--ml-route-model", help="of triage: a model that route-train saved")
    p.add_argument("--ml-route-mode", choices=["off", "report-only", "shadow", "full"], default="off")
    p.add_argument("--ml-route-skip", type=float, default=0.9)
    p.add_argument("--ml-route-large", type=float, default=0.8)
    p.add_argument("--strict", action="store_true", help="of kg verbs: what is inconsistent or differs is an error")
    p.add_argument("--max-cases", type=int)
    p.add_argument("--max-people", type=int)
    p.add_argument("--labels", help="of route-dataset: JSON Lines of labels by hand")
    p.add_argument("--test-fraction", type=float, default=0.2)
    p.add_argument("--seed", type=int, default=17)
    p.add_argument("--max-features", type=int, default=5000)
    p.add_argument("--min-df", type=int, default=1)
    p.add_argument("--alpha", type=float, default=1.0)
    p.add_argument("--per-band", type=int, default=100)
    p.add_argument("--size", type=int, default=2)
    p.add_argument("--overlap", type=int, default=1)
    p.add_argument("--packs")
    p.add_argument("--ner", action="store_true", help="of triage: named entities count, where spaCy is")
    p.add_argument("--allow")
    p.add_argument("--deny")
    p.add_argument("--per-file", type=int)
    p.add_argument("--most", type=int)
    p.add_argument("--tokens", type=int)
    p.add_argument("--group", type=int, default=resolve.MAX_GROUP)
    p.add_argument("--people", type=int)
    p.add_argument("--events", type=int)
    a = p.parse_args(argv)
    spark, timings, counts = _spark(), {}, {}
    for verb in a.steps.split(",") if a.verb == "run" else [a.verb]:
        t = time.perf_counter()
        counts[verb] = VERBS[verb](spark, a).count()
        timings[verb] = round((time.perf_counter() - t) * 1000)
    print(json.dumps({"timings_ms": timings, "rows": counts}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
