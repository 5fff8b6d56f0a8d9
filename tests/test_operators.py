import json

import pytest
from pyspark.sql import functions as F

from caseloom.functions.text import normal_name
from caseloom.operators import chunking, extract, graph, ingest, loading, nulls, readmodels, resolve, routeml, shell, threads, timeline, triage, validate
from caseloom.plans import adapters as A
from tests.conftest import SF


def pages(spark, *texts):
    return spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "file_id string, page_index int, text string")


def spans(df):
    return sorted((r.page_start, r.page_end) for r in df.collect())


def test_chunks(spark):
    assert spans(chunking.chunks(pages(spark, "one", "two", "Bob: hi", "four", "five"))) == [(0, 1), (1, 1), (2, 2), (3, 4), (4, 4)]
    by_fold = chunking.chunks(pages(spark, "a", "b", "c", "d", "e", "f", "g"), 3, 1)
    assert spans(by_fold) == [(0, 2), (2, 4), (4, 6), (6, 6)]
    # the fold and the window agree where both apply
    p = pages(spark, "a", "Q: x", "b", "c", "d \"quoted\"", "e", "")
    fold = chunking.chunks(p, 2, 0)
    assert spans(fold)[0] == (0, 0) and chunking.chunks(p.limit(0)).count() == 0
    r = chunking.chunks(pages(spark, "seen 2024-01-05 with Dana Reed at the long river bank", "x")).orderBy("page_start").first()
    assert r.signals.has_dates and r.signals.has_names and not r.signals.low_quality and r.text.endswith("\n\nx")


def test_triage_of_a_narrative(spark):
    text = "\n".join(f"On 2024-01-0{i} Officer Dana Reed reported to Acme Inc. at 10:30 about Case #A12." + " words" * 15 for i in range(1, 9))
    r = triage.triaged(spark.createDataFrame([("c", "f", text), ("d", "f", ""), ("e", "f", "!!!!!!!!!!!!")], "chunk_id string, file_id string, text string")).orderBy("chunk_id").collect()
    assert r[0].route == "llm_large" and r[0].complex_narrative and r[0].date_like_count == 8 and r[0].max_repeated_char_run == 2
    assert [x.route for x in r[1:]] == ["skip", "skip"] and r[2].low_quality and r[1].char_len == 0 and r[2].max_repeated_char_run == 12


def test_budgets(spark):
    rows = [("a", "f", 25, 0.9), ("b", "f", 25, 0.8), ("c", "g", 5, 0.7), ("d", "g", 1, 0.6)]
    df = spark.createDataFrame(rows, "chunk_id string, file_id string, token_est int, score double")
    ids = lambda d: sorted(r.chunk_id for r in d.collect())
    assert ids(triage.token_budget(df, 25)) == ["a"] and ids(triage.token_budget(df, 31)) == ["a", "c", "d"] and ids(triage.token_budget(df, 100, 1)) == ["a", "c"]
    assert ids(triage.count_caps(df, 1, None)) == ["a", "c"] and ids(triage.count_caps(df, 2, 3)) == ["a", "b", "c"]
    lists = spark.createDataFrame([("g",)], "file_id string")
    assert ids(triage.allowed_files(df, lists, None)) == ["c", "d"] and ids(triage.allowed_files(df, lists.limit(0), lists)) == ["a", "b"]
    assert ids(triage.by_route(df, ["x"], None)) == ["a", "b", "c", "d"]


def test_greedy_budget_against_brute_force(spark):
    df = triage.triaged(A.chunks(spark, SF)).select("chunk_id", "file_id", "token_est", "score")
    left, want = 5000, set()
    for r in sorted(df.collect(), key=lambda r: (-r.score, r.chunk_id)):
        if r.token_est <= left:
            left -= r.token_est
            want.add(r.chunk_id)
    assert {r.chunk_id for r in triage.token_budget(df, 5000).collect()} == want


def test_greedy_budget_with_files_over_many_parts(spark):
    rows = [(f"c{i:04d}", f"f{i * i % 23}", (i * 7919) % 97, (i * 31 % 50) / 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "chunk_id string, file_id string, token_est int, score double")
    for budget, per_file in ((0, None), (50, 2), (3000, None), (9000, 5), (20_000, 40), (10**6, 3), (10**6, None)):
        left, want, files = budget, set(), {}
        for c, f, n, _ in sorted(rows, key=lambda r: (-r[3], r[0])):
            if n <= left and (per_file is None or files.get(f, 0) < per_file):
                left, files[f] = left - n, files.get(f, 0) + 1
                want.add(c)
        assert {r.chunk_id for r in triage.token_budget(df, budget, per_file).collect()} == want, (budget, per_file)


def test_route_breakdown_counts_records_and_tokens_of_last_ones(spark):
    rows = [("a", 0, "skip", 5, None), ("a", 1, "llm_small", 7, "llm_large"), ("b", 0, None, 3, ""), ("", 0, "skip", 100, None)]
    got = triage.route_breakdown(spark.createDataFrame(rows, "chunk_id string, seq int, route string, token_est int, predicted_route string"), ["seq"], 4)
    assert {(r.kind, r.route): (r["count"], r.pct_of_chunks, r.tokens_est) for r in got.collect()} == {
        ("route", "skip"): (2, 50.0, 0), ("route", "llm_small"): (1, 25.0, 7), ("route", "unknown"): (1, 25.0, 3),
        ("predicted_route", "skip"): (2, 50.0, 0), ("predicted_route", "llm_large"): (1, 25.0, 7), ("predicted_route", "unknown"): (1, 25.0, 3),
    }


def test_given_packs_come_beside_the_default_ones(spark):
    from caseloom.functions import text as T

    df = spark.createDataFrame([("zebra zebra police",)], "t string")
    name = next(iter(T.PACKS))
    hits = T.keyword_hits(F.col("t"), {"own": ["zebra"], name: ["police"]})
    assert set(hits) == {*T.PACKS, "own"} and df.select(hits["own"], hits[name]).first() == (2, 1)


def test_rows_with_nulls_in_their_key_stay(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("a", None)], "x string, y int")
    assert nulls.unique_rows(df, ["x", "y"]).count() == 3


def people(spark, rows, signals):
    ent = spark.createDataFrame([(n, "person", f, f"{f}:1", 1, 1) for n, f in rows], "entity string, type string, file_id string, chunk_id string, page_start int, page_end int")
    sig = spark.createDataFrame([(n, a, v, f, f"{f}:1") for n, a, v, f in signals], "person_text string, attribute string, value_norm string, file_id string, chunk_id string")
    obs = resolve.with_signals(resolve.observed(ent), sig)
    return obs, resolve.scored_pairs(resolve.candidate_pairs(resolve.blocking_keys(obs)), obs)


@pytest.mark.parametrize(
    ("names", "signals", "decision", "clusters"),
    [
        (("Bob Smith", "Robert Smith"), [("dob", "1980-01-01")] * 2, "auto_merge", 1),
        (("Ann Lee", "Carl Poe"), [("case_id", "C1")] * 2, "needs_review", 2),
        (("Ann Lee", "Ann Lee"), [("dob", "1980-01-01"), ("dob", "1990-01-01")], "no_merge", 2),
        (("Ann Lee", "Ann Lee"), [("address", "1 main")] * 2, "auto_merge", 1),
        (("Ann Lee", "Ann Lee"), [("dob", None)] * 2, "no_merge", 2),
    ],
)
def test_people(spark, names, signals, decision, clusters):
    rows = [(n, f"f{i}") for i, n in enumerate(names)]
    obs, scored = people(spark, rows, [(n, a, v, f) for (n, f), (a, v) in zip(rows, signals)])
    assert [r.decision for r in scored.collect()] == [decision]
    found = resolve.clustered(obs, scored)
    assert found.select("root").distinct().count() == clusters and resolve.people(obs, found).count() == clusters


def plain_people(spark):
    """Observations of which several agree, with the pairs, scores and clusters of the operators that know no profiles."""
    rows = [(n, f"f{i}") for i, n in enumerate(["Bob Smith"] * 4 + ["Robert Smith"] * 3 + ["Ann Lee"] * 3 + ["Carl Poe", "Bea Poe", "Dan"])]
    signs = [("dob", "1980-01-01")] * 4 + [("dob", "1980-01-01")] * 2 + [("dob", "1990-01-01")] + [("case_id", "C1")] * 3 + [("case_id", "C1"), ("dob", "1990-01-01"), ("dob", None)]
    obs, scored = people(spark, rows, [(n, a, v, f) for (n, f), (a, v) in zip(rows, signs)])
    return obs.select("obs_id", "name", *resolve.PROFILE), scored


@pytest.mark.parametrize("most", [200, 6, 3])
def test_pairs_of_profiles_stand_for_all_pairs(spark, most):
    """the same pairs, scores and reasons, whichever groups are too large."""
    obs, _ = plain_people(spark)
    plain = resolve.scored_pairs(resolve.candidate_pairs(resolve.blocking_keys(obs), most), obs)
    found = resolve.profiles(obs)
    scores = resolve.profile_scores(found, most)
    got = resolve.expanded(scores, resolve.profile_members(obs, found, most), "score", "decision", "reasons")
    rows = lambda df: sorted((r.left, r.right, r.score, r.decision, tuple(r.reasons)) for r in df.select("left", "right", "score", "decision", "reasons").collect())
    assert rows(got) == rows(plain) and (most < 6 or got.count() > scores.count())


@pytest.mark.parametrize("most", [200, 6, 3])
def test_clusters_of_profiles(spark, most):
    """profiles that merge with themselves, with others and not at all."""
    obs, _ = plain_people(spark)
    plain = resolve.clustered(obs, resolve.scored_pairs(resolve.candidate_pairs(resolve.blocking_keys(obs), most), obs))
    found = resolve.profiles(obs)
    got = resolve.clustered_profiles(obs, found, resolve.profile_scores(found, most))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select("obs_id", "root").collect()))


def test_histogram_of_profiles(spark):
    """a pair counts once, and in each group that it is attempted in."""
    obs, scored = plain_people(spark)
    pairs = resolve.candidate_pairs(resolve.blocking_keys(obs))
    want = pairs.join(scored.select("left", "right", "decision"), ["left", "right"]).groupBy("decision").agg(F.count("*"), F.countDistinct("left", "right"))
    got = resolve.decision_histogram(resolve.profile_scores(resolve.profiles(obs)))
    assert sorted(map(tuple, got.select("decision", "attempted", "n_pairs").collect())) == sorted(map(tuple, want.collect()))


def test_oversized_groups_give_no_pairs(spark):
    keys = spark.createDataFrame([(i, "k", "x") for i in range(5)], "obs_id long, key_type string, key string")
    assert resolve.candidate_pairs(keys, 4).count() == 0 and resolve.candidate_pairs(keys, 5).count() == 10


def test_timeline(spark):
    ev = spark.createDataFrame([(1, "f1", "c1", "2024-01-05"), (2, "f1", "c1", "last Tuesday"), (3, "f2", "c2", "yesterday"), (4, "f3", "c3", "today"), (5, "f1", "c1", "2024-01-05 and 2024-01-06"), (6, "f1", "c1", None), (7, "f1", "c1", "later")], "event_id long, file_id string, chunk_id string, date string")
    ch = spark.createDataFrame([("c1", "report of 2026-02-20."), ("c2", "nothing")], "chunk_id string, text string")
    fi = spark.createDataFrame([("f2", "2024-03-01T10:00:00Z")], "file_id string, mtime string")
    got = {r.event_id: (r.status, r.date_start) for r in timeline.event_times(ev, ch, fi).collect()}
    assert got == {1: ("ok", "2024-01-05"), 2: ("ok", "2026-02-17"), 3: ("ok", "2024-02-29"), 4: ("missing_anchor", None), 5: ("unresolved_ambiguous", None), 6: ("empty", None), 7: ("invalid_format", None)}
    sig = spark.createDataFrame([("f1", "c1", "case_id", "C1")], "file_id string, chunk_id string, attribute string, value_norm string")
    cases = {(r.event_id, r.case_id_norm, r.source) for r in timeline.event_cases(ev.where("event_id in (1, 3)"), sig).collect()}
    assert cases == {(1, "C1", "identity_signals"), (3, "file:f2", "fallback")}


def segs(spark, n, key="s:a", token="t"):
    return spark.createDataFrame([(f"s{i}", "f", f"c{i}", "K", [key], [token], "2024-01-01") for i in range(n)], "segment_id string, file_id string, chunk_id string, case_id_norm string, participant_keys array<string>, top_tokens array<string>, anchor_date string")


def test_threads(spark):
    s = segs(spark, 3)
    members, heads = threads.threads(s, threads.thread_pairs(s))
    assert heads.count() == 1 and heads.first().n_segments == 3 and heads.first().label == "t" and members.count() == 3
    again = threads.threads(s, threads.thread_pairs(s))[1].first().thread_key
    assert again == heads.first().thread_key
    assert threads.thread_pairs(s, fanout=1).count() == 0 and threads.threads(s, threads.thread_pairs(s, fanout=1))[1].count() == 3


def test_topics_alone_need_review(spark):
    a = segs(spark, 1, "s:a").union(segs(spark, 2, "s:b").where("segment_id = 's1'"))
    r = threads.thread_pairs(a).collect()
    assert [(x.decision, x.score) for x in r] == [("needs_review", 0.4)]


def test_graph(spark):
    ev = A.evidence(spark, SF)
    e = graph.edges(ev).cache()
    ends = e.select(F.col("src_type").alias("type"), F.col("src_id").alias("id")).union(e.select("dst_type", "dst_id")).distinct()
    assert {r.issue: r.n for r in graph.validated(e, ends, strict=True).collect()} == {"missing_field": 0, "unknown_type": 0, "dangling_end": 0}
    with pytest.raises(ValueError):
        graph.validated(e, ends.where("type <> 'Case'"), strict=True)
    assert graph.unique_evidence(ev.union(ev)).count() == graph.unique_evidence(ev).count()
    assert {r.side: r.n for r in graph.parity(e, e, "all").collect()} == {"only_left": 0, "only_right": 0}


def test_percentiles_by_rank(spark):
    n = spark.createDataFrame([("k", i) for i in (1, 2, 3, 4)], "k string, n long")
    assert graph.rank_percentiles(n, "k").first()[1:4] == (2, 3, 3) and graph.rank_percentiles(n, "k", rounded=True).first()[1:4] == (3, 4, 4)


def test_read_models(spark):
    s = A.store(spark, SF)
    case = s["event_cases"].where("source = 'identity_signals'").first().case_id_norm
    r = readmodels.evidence_browser(s, case, page=-1, page_size=7, sort_by="x", sort_dir="up")
    assert (r.status, r.page["page"], r.page["page_size"], r.page["sort_by"], r.page["sort_dir"]) == (200, 1, 25, "page_start", "asc") and r.page["total"] > 0
    assert readmodels.evidence_browser(s, case, shared=readmodels.Filters(case_id="none")).code == "case_not_found"
    v = readmodels.case_view({k: x for k, x in s.items() if k != "entities"}, case)
    assert v.status == 200 and v.widgets["linked_entities"] == "missing_entities_table" and v.frames["summary"].first().evidence_count > 0
    assert readmodels.case_view(s, "  ").status == 404 and readmodels.case_timeline(s, case).status == 200
    assert readmodels.person_profile(s, case, 1).widgets == {"profile": "missing_person_tables"}
    full = s | {"person_observations": A.observations(spark, SF), "person_clusters": spark.createDataFrame([(1, "n")], "person_id int, display_name string")}
    seen = full["person_observations"].join(readmodels.case_chunks(s, case), ["file_id", "chunk_id"], "left_semi").limit(1).select("obs_id", F.lit(1).alias("person_id"))
    p = readmodels.person_profile(full | {"person_cluster_members": seen}, case, 1)
    assert p.status == 200 and p.frames["aliases"].count() == 1 and p.frames["linked_evidence"].count() > 0
    assert readmodels.person_profile(full | {"person_cluster_members": seen.limit(0)}, case, 1).code == "person_not_in_case"
    assert readmodels.case_indicators(s, case).widgets == {"dedupe_indicators": "missing_dedupe_tables", "thread_indicators": "missing_thread_tables"}


def test_loading(spark, tmp_path):
    from caseloom.sources.jsonl import good_and_bad, read_jsonl

    item = {"entity": " Ann ", "type": "person", "quote": "a  b", "confidence": 0.5, "char_range": [1, 4]}
    lines = [{"file_id": "f", "chunk_id": "c", "page_range": [3.0, "4"], "items": [item, {**item, "quote": "a b"}, {"entity": " "}], "model": "m"}, {"file_id": "", "chunk_id": "c", "items": []}]
    (tmp_path / "x.jsonl").write_text("\n".join([*map(json.dumps, lines), "", "{broken"]))
    rec = read_jsonl(spark, f"file://{tmp_path}/x.jsonl", loading.record_schema("entities")).cache()
    got = loading.observations(rec, "entities").collect()
    assert [(r.entity, r.quote, r.page_start, r.page_end, r.char_start, r.char_end, r.source_phase, r.model) for r in got] == [("Ann", "a b", 3, 4, 1, 4, "legacy", "m")]
    assert loading.load_counts(rec).first().asDict() == {"records_total": 3, "json_decode_errors": 1, "invalid_record_shape": 1, "rows_attempted": 3, "invalid_item_shape": 1, "rows_inserted": 1, "rows_skipped": 2}
    assert good_and_bad(rec)[1].count() == 1
    signal = {"person": "Ann", "attribute": "DOB", "value": "1/2/1980", "quote": "q"}
    (tmp_path / "s.jsonl").write_text(json.dumps({"file_id": "f", "chunk_id": "c", "items": [signal, {**signal, "quote": None}, {**signal, "attribute": "x"}]}))
    s = loading.observations(read_jsonl(spark, f"file://{tmp_path}/s.jsonl", loading.record_schema("identity_signals")), "identity_signals").collect()
    assert [(r.attribute, r.value_norm) for r in s] == [("dob", "1980-01-02")]


class Bad:
    name = "bad"

    def ask(self, kind, text):
        raise {"v": ValueError, "o": OSError, "k": KeyError}[text] if text in "vok" else AssertionError


def test_extraction_and_cache(spark):
    ch = spark.createDataFrame([("f", "c1", 1, 2, "Dana Reed arrived on 2024-01-05"), ("f", "c2", 2, 3, "x")], "file_id string, chunk_id string, page_start int, page_end int, text string")
    first = extract.extracted(ch, "entities", extract.Rules()).cache()
    assert {r.chunk_id: r.n_items for r in first.collect()} == {"c1": 1, "c2": 0}
    again = extract.extracted(ch, "entities", Bad(), cache=first)
    assert {r.chunk_id: r.error for r in again.collect()} == {"c1": None, "c2": None}
    errors = extract.extracted(ch.limit(0).union(spark.createDataFrame([("f", t, 1, 1, t) for t in "vok"], ch.schema)), "events", Bad()).collect()
    assert {r.chunk_id: r.error for r in errors} == {"v": "bad_config_error", "o": "bad_unavailable", "k": "bad_error"}
    assert extract.parse_answer("nope") == ([], "invalid_json") and extract.parse_answer("{}") == ([], "missing_items") and extract.parse_answer('```json\n{"items": [{"a": 1}, 2]}\n```') == ([{"a": 1}], None)
    assert extract.two_pass(ch, "entities", extract.Rules(), extract.Rules(), ch.limit(1).select("chunk_id")).count() == 3


def test_ingestion(spark, tmp_path):
    import zipfile

    (tmp_path / "a.PDF").write_bytes(b"%PDF")
    (tmp_path / "note.txt").write_text("x")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in\\b.pdf", "x")
        z.writestr("c.txt", "x")
    (tmp_path / "broken.zip").write_bytes(b"no")
    rows = ingest.manifest(spark, f"file://{tmp_path}").collect()
    assert sorted(r.virtual_path.rsplit("/", 1)[1] for r in rows) == ["a.PDF", "b.pdf"] and len({r.file_id for r in rows}) == 2
    assert {r.file_id: bytes(r.content) for r in ingest.contents(spark, f"file://{tmp_path}").collect()} == {r.file_id: b"%PDF" if r.source_type == "fs" else b"x" for r in rows}

    def reader(content):
        if content == b"bad":
            raise RuntimeError
        return [("word " * 30, False)] * 8 + [("", True)] * (2 if content == b"text" else 20)

    files = spark.createDataFrame([("t", b"text"), ("m", b"mixed"), ("b", b"bad")], "file_id string, content binary")
    got = {r.file_id: r for r in ingest.classified(ingest.probed(files, reader)).collect()}
    assert got["t"].classification == "text" and got["m"].classification == "mixed" and got["b"].classification == "unknown" and got["b"].errors == "RuntimeError"
    assert ingest.tesseract_page(b"", 0)[1] in ("pending_ocr", "CalledProcessError", "StopIteration")
    d = spark.createDataFrame([(60, True), (5, True), (30, True), (5, False), (None, True)], "n int, i boolean").select(ingest.ocr_decision(F.col("n"), F.col("i")).alias("d")).collect()
    assert [r.d.reason for r in d] == ["text_page_threshold_met", "image_with_low_text", "prefer_embedded_text", "no_images_detected", "missing_signal_fallback_ocr"]
    pdf = spark.createDataFrame([("f", 0, "x" * 60), ("f", 1, ""), ("f", 2, "")], "file_id string, page_index int, text string")
    scan = spark.createDataFrame([("f", 1, "read", "ok"), ("f", 3, "", "pending_ocr")], "file_id string, page_index int, text string, status string")
    m = {r.page_index: (r.source, r.review_reason) for r in ingest.merged_pages(pdf, scan).collect()}
    # Pages with neither text stay, empty, for review; a failed page isn't the same as one that OCR found empty.
    assert m == {0: ("pdf_text", None), 1: ("ocr", None), 2: ("ocr", "missing_phase2_page"), 3: ("ocr", "missing_mixed_text_sources")}


def test_document_pages(spark):
    """Text files by their own text, mixed ones merged, others by OCR; each page with its quality."""
    p1 = spark.createDataFrame([("t", "text", 1), ("m", "mixed", 3), ("s", "scanned", 2), ("u", "odd", 1), ("b", "text", 1), ("e", "unknown", 0), ("", "text", 1)], "file_id string, classification string, page_count int")
    files = spark.createDataFrame([("t", b"t"), ("m", b"m"), ("s", b"s"), ("u", b"u"), ("b", b"bad")], "file_id string, content binary")
    told = {b"t": [("word " * 20, False)], b"m": [("x" * 50, False), ("short", True), ("", True)], b"s": [("", True)] * 2, b"u": [("", False)]}
    texts = ingest.page_texts(files, told.__getitem__).cache()
    plan = ingest.ocr_plan(p1.where("classification <> 'text'"), texts)
    assert {(r.file_id, r.page_index): r.decision for r in plan.collect()} == {("m", 0): "skip_pdf_text", ("m", 1): "ocr", ("m", 2): "ocr", ("s", 0): "ocr", ("s", 1): "ocr", ("u", 0): "ocr"}
    done = ingest.ocr_files(files, plan, lambda content, k: ("", "pending_ocr") if k == 1 and content == b"s" else (f"seen {k}" if content != b"m" or k == 1 else "", None))
    got = {(r.file_id, r.page_index): r for r in ingest.document_pages(p1, texts, done).collect()}
    assert {k: (r.text, r.source, r.review_reason) for k, r in got.items()} == {
        ("t", 0): ("word " * 20, "pdf_text", None), ("m", 0): ("x" * 50, "pdf_text", None), ("m", 1): ("seen 1", "ocr", None), ("m", 2): ("", "ocr", "missing_ocr_text"),
        ("s", 0): ("seen 0", "ocr", None), ("s", 1): ("", "ocr", "missing_text_path"), ("u", 0): ("seen 0", "ocr", None), ("b", 0): ("", "ocr", None),
    }
    # Unknown confidence counts as 1: (6 / 50 + 1) / 2 * 0.6 for a page of six characters.
    assert got["t", 0].quality_score_page == 1.0 and got["m", 1].quality_score_page == 0.336 and got["m", 2].quality_score_page == 0.0
    assert got["s", 1].quality_flags == ["empty_text", "ocr_error"] and got["m", 1].quality_flags == ["low_text"]


def test_page_batches(spark):
    plan = spark.createDataFrame([("f", p) for p in (0, 1, 2, 4, 5, 9)] + [("g", 3)], "file_id string, page_index int")
    got = {(r.file_id, r.page_index): r.batch for r in ingest.page_batches(plan, 2).collect()}
    assert got == {("f", 0): 0, ("f", 1): 0, ("f", 2): 1, ("f", 4): 2, ("f", 5): 2, ("f", 9): 3, ("g", 3): 0}


def test_named_entities_raise_scores(spark):
    rows = spark.createDataFrame([("c1", "x" * 60), ("c2", "fails " * 12), ("c3", None)], "chunk_id string, text string")

    def counter(text):
        if text.startswith("fails"):
            raise ImportError
        return {"PERSON": 2, "DATE": 1} if text else {}

    plain = {r.chunk_id: r.score for r in triage.triaged(rows).collect()}
    got = {r.chunk_id: r for r in triage.triaged(triage.with_entities(rows, counter)).collect()}
    # A run of one character costs 0.1 of the 0.18 that a person and a date give.
    assert round(got["c1"].score, 9) == 0.08 and plain["c1"] == 0.0 and got["c1"].ner == {"PERSON": 2, "DATE": 1}
    assert got["c2"].ner is None and got["c2"].score == plain["c2"] and got["c3"].score == plain["c3"]
    assert all(r.ner is None for r in triage.with_entities(rows).collect())  # no library here


def test_shell():
    assert shell.resolve("cases/A:1/people/7/?x=1") == (200, "ok", "person_profile", {"case_id": "A:1", "person_id": "7"}) and shell.resolve("/admin").code == shell.resolve("").code == "not_found"
    assert [shell.guard("/cases/1/timeline", *a).code for a in (("guest",), ("admin", False), ("admin", True, False), ("analyst",))] == ["forbidden", "case_not_found", "resource_not_found", "ok"]
    assert shell.guard("/nowhere", "guest").status == 404 and shell.guard("/cases", "admin", False, False).status == 200
    f = shell.parse_filters("/cases?case_id_norm= A%3A1 &person_id=-3&date_start=2024-01-01&confidence_min=0.25")
    assert (f.case_id, f.person_id, f.date_start, f.date_end, f.confidence_min) == ("A:1", None, "2024-01-01", None, 0.25)
    assert shell.serialize_filters(f) == "case_id_norm=A%3A1&date_start=2024-01-01&confidence_min=0.25" and shell.parse_filters(shell.serialize_filters(f)) == f
    assert shell.parse_filters("confidence_min=nan").confidence_min is None and shell.parse_filters(None) == shell.Filters() and shell.serialize_filters(shell.Filters(confidence_min=0.0)) == "confidence_min=0"
    assert shell.navigation(" ")[1] == ("People", "/cases", False) and shell.navigation("B", f)[1] == ("People", "/cases/A:1/people?" + shell.serialize_filters(f), True)
    w = [shell.widget_error("w", "c"), shell.Widget("v", "empty"), shell.Widget("u", "ready")]
    assert w[0].error_code == "widget_data_unavailable" and shell.health(w) == {"total": 3, "loading": 0, "empty": 1, "errors": 1, "partial_failure": True}


def test_route_model(spark):
    rows = spark.createDataFrame([(1, "skip", "blank blank page"), (2, "skip", "blank page"), (3, "llm_large", "long story here"), (4, "llm_large", "story long")], "row_id long, label string, text string")
    v = routeml.vocabulary(rows, 10, 2)
    assert [r.token for r in v.collect()] == ["blank", "long", "page", "story"]
    prior, seen = routeml.bayes(rows, v)
    got = {r.row_id: r for r in routeml.bayes_predict(rows, v, prior, seen).collect()}
    assert [got[i].predicted for i in (1, 2, 3, 4)] == ["skip", "skip", "llm_large", "llm_large"] and abs(sum(got[1][1:4]) - 1) < 1e-9
    split = routeml.group_split(rows.withColumn("g", F.col("row_id") % 2), "g", 0.3)
    assert split.where("is_test").select("g").distinct().count() == 1


def test_reports(spark):
    p1 = spark.createDataFrame([("text", 10, True, None), ("text", 5, None, "e")], "classification string, text_char_count_total long, sampled boolean, errors string")
    assert validate.class_report(p1).first().asDict() == {"classification": "text", "files": 2, "avg_chars": 7.5, "sampled": 1, "with_errors": 1}
    pg = spark.createDataFrame([("ocr", "", 0.1), ("ocr", "x", 0.9)], "source string, text string, quality_score_page double")
    assert validate.page_report(pg).first().low_pct == 50.0


def test_graph_lookups(spark):
    rows = [("Person", p, "IN_CASE", "Case", c) for p, c in (("1", "A"), ("2", "A"), ("3", "A"), ("3", "B"), ("4", "B"))] + [("Person", "1", "MENTIONED_IN_EVENT", "Event", "9")]
    e = spark.createDataFrame(rows, "src_type string, src_id string, edge_type string, dst_type string, dst_id string")
    ids = lambda df: [r[0] for r in df.collect()]
    assert ids(graph.two_hop_of(e, "3")) == ["1", "2", "4"] and ids(graph.two_hop_of(e, "3", 2)) == ["1", "2"] and ids(graph.two_hop_of(e, "9")) == []
    assert graph.two_hop(e).count() == 8 and graph.two_hop(e, limit=1).count() == 4
    assert [tuple(r) for r in graph.person_profile(e, "1").collect()] == [("Case", "A"), ("Event", "9")]
    proof = e.withColumns({"file_id": F.lit("f"), "chunk_id": F.col("dst_id"), "page_start": F.lit(1), "page_end": F.lit(2)})
    found = graph.explain_edge(proof, {"src_id": "3", "edge_type": "IN_CASE"}).collect()
    assert [r.chunk_id for r in found] == ["A", "B"] and graph.explain_edge(proof, {"src_id": "3"}, 1).count() == 1


def test_parity_follows_only_what_changed(spark):
    people = [("Person", str(p), "IN_CASE", "Case", c) for c in "AB" for p in range(6)] + [("Person", "7", "IN_CASE", "Case", "A")]
    e = spark.createDataFrame(people, "src_type string, src_id string, edge_type string, dst_type string, dst_id string")
    less = e.where("NOT (src_id = '7' OR src_id = '0' AND dst_id = 'A')")
    got = {(r.kind, r.only_left, r.only_right) for r in graph.parity_report(e, less, e, e).collect()}
    # 0 and the others still share B; 7 shared A with all six.
    assert got == {("case_people", 2, 0), ("person_cases", 1, 0), ("person_twohop_via_case", 6, 0), ("person_twohop_via_case", 1, 0), ("count", 1, 1)}
    assert graph.parity_report(e, e, e, e).count() == 0


def test_chunk_tables_and_paths(spark):
    rows = [("c", "f", 0, 1, "one", 1), ("c", "f", 0, 2, "two!", 2), ("d", None, 0, 1, "x", 3), ("e", "f", 3, 1, "x", 4)]
    first, last = loading.chunk_tables(spark.createDataFrame(rows, "chunk_id string, file_id string, page_start int, page_end int, text string, seq int"), "seq")
    assert [(r.chunk_id, r.page_end) for r in first.collect()] == [("c", 1)] and [(r.chunk_id, r.char_count) for r in last.collect()] == [("c", 4)]
    from caseloom.functions import ids as I

    made = spark.range(1).select(I.product_path(F.lit("Case #1"), F.lit("Time Line"), F.lit("x.json")).alias("p")).first().p
    assert made.startswith("products/") and made.endswith("/time_line/x.json")


def test_downstream_utility(spark):
    ev = spark.createDataFrame([(1, "c1", "f"), (2, "c1", "f"), (3, "c2", "f")], "event_id long, chunk_id string, file_id string")
    times = spark.createDataFrame([(1, "ok"), (2, "missing_anchor"), (3, "ok")], "event_id long, status string")
    obs = spark.createDataFrame([("o1", "c1", "f"), ("o2", "c3", "f")], "obs_id string, chunk_id string, file_id string")
    members = spark.createDataFrame([("o1", 1)], "obs_id string, person_id int")
    assert {r.chunk_id: r.utility for r in routeml.utility(ev, times, obs, members).collect() if r.utility} == {"c1": 2, "c2": 1}


def test_model_server_requests(monkeypatch, tmp_path):
    from caseloom.operators import extract

    server = extract.Http("openai", "m", extract.PROMPTS)
    assert server.model == "m" and server.body("events", "t")["temperature"] == 0 and server.body("events", "t")["messages"][0]["content"].endswith("\n\nt")
    assert server.said({"choices": [{"message": {"content": "x"}}]}) == "x" and extract.Http("ollama", "m", extract.PROMPTS).said({"response": "y"}) == "y"
    assert "m:generateContent" in extract.Http("gemini", "m", extract.PROMPTS).url
    monkeypatch.delenv("OPENAI_API_KEY", raising=False)
    monkeypatch.chdir(tmp_path)
    try:
        server.ask("events", "t")
        raise AssertionError("no key")
    except ValueError as e:
        assert "OPENAI_API_KEY" in str(e)
    (tmp_path / ".env").write_text("# keys\nexport OPENAI_API_KEY='abc'\n")
    assert extract.from_env_file("OPENAI_API_KEY") == "abc" and extract.from_env_file("OTHER") is None


def test_labels_by_a_model(spark):
    heads = spark.createDataFrame([("a", "old"), ("b", "kept")], "root string, label string")
    members = spark.createDataFrame([("a", ["s:x"], ["river", "bank"]), ("b", ["s:y"], ["none"])], "root string, participant_keys array<string>, top_tokens array<string>")
    got = {r.root: r.label for r in threads.model_labels(heads, members, lambda prompt: '{"label": " At the river "}' if "river" in prompt else "no json").collect()}
    assert got == {"a": "At the river", "b": "kept"}


def test_route_breakdown_reads_texts_once(spark):
    """records and last records come from one written table, which holds no text."""
    from caseloom.plans import catalog

    files = catalog.QUERIES["triage_route_breakdown"](spark, SF).inputFiles()
    assert files and not any("documents.parquet" in f for f in files)


def test_graph_reads_events_once_for_people(spark):
    """chunks are written once; the events themselves are scanned three times at the most, all for their own evidence."""
    plan = A.evidence(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("Location:")[1:] if "events.parquet" in x.split("]")[0]]
    assert len(scans) == 3
    assert not any("events.parquet" in f for f in A.people(spark, SF)[0].inputFiles())


def test_observations_with_their_person_need_no_members(spark):
    """The same mentions, counts and people without the join of members."""
    named, members = A.people(spark, SF)
    obs, ev = named.drop("person_id"), A.events(spark, SF)
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    assert named.count() == A.observations(spark, SF).count() > 0
    assert rows(graph.mentioned_in_event(members, named, ev, 5, 2)) == rows(graph.mentioned_in_event(members, obs, ev, 5, 2))
    assert rows(graph.skipped_chunks(members, named, ev, 5, 2)) == rows(graph.skipped_chunks(members, obs, ev, 5, 2))
    assert rows(resolve.people(named.withColumnRenamed("person_id", "root"))) == rows(resolve.people(obs, members.withColumnRenamed("person_id", "root")))


def test_lookups_write_only_edges_they_read(spark, monkeypatch):
    """edges that a query never reads are not written for it."""
    from caseloom.plans import catalog

    seen = {}
    keep = catalog.written
    monkeypatch.setattr(catalog, "written", lambda df: seen.setdefault(name, keep(df)))
    for name in ("two_hop", "case_overview", "kg_person_profile"):
        catalog.QUERIES[name](spark, SF)
    kinds = {n: {(r.src_type, r.edge_type) for r in df.select("src_type", "edge_type").distinct().collect()} for n, df in seen.items()}
    assert kinds["two_hop"] == {("Person", "IN_CASE")} and {x for x, _ in kinds["kg_person_profile"]} == {"Person"}
    assert {r.dst_id for r in seen["case_overview"].collect()} <= {catalog.CASE}


def test_counts_write_only_ends_of_evidence(spark, monkeypatch):
    """counts need no pages, files or confidence of evidence; each row of it still counts."""
    from caseloom.plans import catalog

    seen, keep = [], catalog.written
    monkeypatch.setattr(catalog, "written", lambda df: seen.append(keep(df)) or seen[-1])
    got = {(r.kind, r.type): r.n for r in catalog.QUERIES["kg_counts"](spark, SF).collect()}
    assert [df.columns for df in seen] == [graph.EDGE, graph.EDGE]
    assert sum(n for (kind, _), n in got.items() if kind == "evidence") == A.evidence(spark, SF).count()


def test_parity_in_one_aggregate(spark):
    """F16: repeats and nulls as a set difference has them, by a single shuffle of the rows."""
    a, b = spark.createDataFrame([(1, "x"), (1, "x"), (None, "y"), (2, None)], "k int, v string"), spark.createDataFrame([(None, "y"), (3, "z"), (3, "z"), (4, None)], "k int, v string")
    got = graph.parity(a, b, "all")
    assert [tuple(r) for r in got.orderBy("side").collect()] == [("all", "only_left", 2), ("all", "only_right", 2)]
    assert {tuple(r) for r in graph.parity(a.limit(0), b.limit(0), "all").collect()} == {("all", "only_left", 0), ("all", "only_right", 0)}
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_parity_report_compares_edges_once(spark, monkeypatch):
    """the kinds are read from the edges that differ, which are written; edges on both sides go no further."""
    from caseloom.operators import graph as g

    rows = [("Person", str(p), "IN_CASE", "Case", "A") for p in range(3)] + [("Event", "9", "IN_CASE", "Case", "A"), ("Person", "1", "MENTIONED_IN_EVENT", "Event", "9")]
    e = spark.createDataFrame(rows, "src_type string, src_id string, edge_type string, dst_type string, dst_id string")
    seen, keep = [], g.written
    monkeypatch.setattr(g, "written", lambda df: seen.append(keep(df)) or seen[-1])
    got = {(r.kind, r.only_left, r.only_right) for r in g.parity_report(e.where("src_id <> '9'"), e.where("dst_id <> '9'"), e, e).collect()}
    assert got == {("case_events", 0, 1), ("person_events", 1, 0)} and seen[0].count() == 2


def test_statements_are_made_of_written_edges(spark, monkeypatch):
    """sizes and statements both read edges; these are made once."""
    from caseloom.plans import catalog

    seen, keep = [], catalog.written
    monkeypatch.setattr(catalog, "written", lambda df: seen.append(keep(df)) or seen[-1])
    got = catalog.QUERIES["cypher_statements"](spark, SF)
    assert len(seen) == 1 and set(got.inputFiles()) == set(seen[0].inputFiles())
    assert sum(r.n_items for r in got.collect()) == seen[0].count() > 0


def test_chunks_are_dealt_to_a_stated_number_of_parts(spark):
    """adaptive execution makes no few tasks of costly texts."""
    df = chunking.chunks(pages(spark, "a", "b").unionByName(pages(spark, "c").withColumn("file_id", F.lit("g"))))
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and df.count() == 3


def test_edges_without_their_evidence(spark):
    """edges of made-up and of test tables are those of all evidence; events meet nothing by their ids, and one shuffle of them serves both joins."""
    ev = spark.createDataFrame([(1, "f", "c", 3, 2, 0.5), (1, "f", "c", 3, 2, 0.5), (2, "f", "d", 1, 1, None), (3, "f", "", 1, 1, 0.1), (4, None, "c", 1, 1, 0.1), (5, "g", "c", 1, 1, 0.1), (None, "f", "c", 1, 1, 0.1)], "event_id long, file_id string, chunk_id string, page_start int, page_end int, confidence double")
    sig = spark.createDataFrame([("f", "c", "A B", "case_id", v, p, p, 0.1) for v, p in (("K", 1), ("K", 2), ("L", 1), (" ", 1), (None, 1))] + [("f", "c", "x", "case_id", "M", 1, 1, 0.1), ("f", "d", "a-b", "dob", "N", 1, 1, 0.1), ("f", "d", "a-b", "case_id", "O", 1, 1, 0.1)], "file_id string, chunk_id string, person_text string, attribute string, value_norm string, page_start int, page_end int, confidence double")
    obs = spark.createDataFrame([("p", "f", "c", "a b", 1, 1), ("p", "f", "c", "a b", 2, 2), ("q", "f", "c", "c", 1, 1), ("p", "f", "d", "a b", 1, 1), (None, "g", "c", "a b", 1, 1), ("r", "f", "", "a b", 1, 1)], "person_id string, file_id string, chunk_id string, name_norm string, page_start int, page_end int")
    name = normal_name(F.col("person_text"))
    cases = timeline.event_cases(ev, sig)
    whole = graph.event_in_case(ev, cases).unionByName(graph.mentioned_in_event(obs, obs, ev)).unionByName(graph.person_in_case(obs, obs, sig, name))
    rows = lambda df: sorted(map(tuple, df.select(*graph.EDGE).collect()))
    got = rows(graph.linked_edges(ev, timeline.event_cases(ev, sig, "file_id", "chunk_id"), obs, obs, sig, name))
    assert got == rows(graph.edges(whole)) and ("Person", "p", "IN_CASE", "Case", "O") in got and len(got) > 8

    assert rows(A.edges(spark, SF)) == rows(graph.edges(A.evidence(spark, SF)))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = A.edges(spark, SF)
        e.collect()
        plan = e._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin [event_id" not in plan and "ReusedExchange" in plan


def test_signals_are_gathered_in_one_set(spark):
    """One buffer for each name in a chunk, and the arrays as before."""
    obs = spark.createDataFrame([(1, "f", "c", "a b"), (2, "f", "d", "a b"), (3, "f", "e", "x")], "obs_id int, file_id string, chunk_id string, name_norm string")
    sig = spark.createDataFrame([("f", "c", "A B", a, v) for a, v in (("dob", "2"), ("dob", "1"), ("dob", "1"), ("dob", None), ("address", "z"), ("phone", "7"), ("case_id", "K"))] + [("f", "d", "a-b", "phone", "7")], "file_id string, chunk_id string, person_text string, attribute string, value_norm string")
    got = resolve.with_signals(obs, sig)
    assert sorted((r.obs_id, r.dob, r.address, r.case_id) for r in got.collect()) == [(1, ["1", "2"], ["z"], ["K"]), (2, [], [], []), (3, [], [], [])]
    assert got.columns == ["file_id", "chunk_id", "name_norm", "obs_id", "dob", "address", "case_id"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("collect_set") == 1
