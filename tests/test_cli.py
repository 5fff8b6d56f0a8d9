import json
import zipfile

import pytest

from caseloom import cli
from caseloom.sources import jsonl


def test_run_from_pages_to_graph(spark, tmp_path, capsys):
    root = f"file://{tmp_path}"
    text = ["Dana Reed arrived on 2024-01-05 with Bob Smith. Dana Reed, born 1980-01-02.", "Bob Smith: I saw the blue car near the river bank\nDana Reed: which car was near the river", "filler"]
    rows = [(f"f{i}", k, t) for i in range(3) for k, t in enumerate(text)]
    spark.createDataFrame(rows, "file_id string, page_index int, text string").write.parquet(f"{root}/pages")
    for _ in range(2):  # again: the same tables
        assert cli.main(["run", "--root", root]) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert said[0]["rows"] == said[1]["rows"] and list(said[0]["timings_ms"]) == list(cli.DEFAULT)
    store = cli.CaseStore(spark, f"{root}/store")
    assert store.read("kg_edges").where("edge_type = 'MENTIONED_IN_EVENT'").count() > 0 and store.read("event_times").where("status = 'ok'").count() >= 3
    # Birth dates join the three files' Dana Reed; names alone don't.
    assert [r.n_observations for r in store.read("person_clusters").where("dob = '1980-01-02'").collect()] == [3]
    assert store.read("conversation_threads").count() >= 1
    assert cli.main(["publish", "--root", root, "--strict", "--people", "1", "--events", "1"]) == 0 and spark.read.parquet(f"{root}/kg/parity").count() == 0
    assert cli.main(["kg", "--root", root, "--strict"]) == 0
    cypher = [r.value for r in spark.read.text(f"{root}/kg/cypher").collect()]
    assert sum(x.startswith("CREATE CONSTRAINT") for x in cypher) == 5 and any("MERGE (v:KGEvidence" in x for x in cypher) and any("display_name: 'Dana Reed'" in x for x in cypher)
    manifest = json.loads(spark.read.text(f"{root}/kg/build_manifest.json").first().value)
    assert manifest["status"] == "ok" and manifest["counts"]["node:Person"] == store.read("person_clusters").count()
    with pytest.raises(jsonl.ResumeError):  # a second file of the same name
        spark.range(1).write.json(f"{root}/kg/nodes/person.jsonl")
        cli.main(["kg-mirror", "--root", root])
    assert spark.read.parquet(f"{root}/validate/rollup").first().llm_total_records == 3 * spark.read.parquet(f"{root}/selected").count()
    checks = {r.check: r.n for r in spark.read.parquet(f"{root}/validate/threads").collect()}
    assert checks["missing_thread_segments"] == 0 and checks["conversation_segments"] > 0 and checks["invalid_participant_keys"] == 0
    # The second run asked nothing again: all answers were in the cache.
    cached = spark.read.parquet(f"{root}/llm_cache/llm/events")
    assert cached.count() == spark.read.parquet(f"{root}/selected").count() and {r.model for r in cached.collect()} == {"rules"}
    assert {r.key for r in store.read("meta").collect()} >= {"loader_run:entities", "loader_run:events", "person_event_chunks_skipped_high_fanout"}
    for verb in ("route-dataset", "route-train", "route-sample-labels"):
        assert cli.main([verb, "--root", root]) == 0
    labelled = spark.read.parquet(f"{root}/route_dataset")
    assert labelled.count() == spark.read.parquet(f"{root}/chunks").count() and labelled.where("label_source = 'heuristic_from_yield' AND label_route = 'llm_small'").count() > 0
    assert spark.read.parquet(f"{root}/route_model/prior").count() == 3 and spark.read.parquet(f"{root}/route_model/metrics").count() >= 1
    assert cli.main(["llm", "events", "--root", root, "--large-model", "any"]) == 0 and spark.read.parquet(f"{root}/llm_large/events").count() > 0
    facts = spark.read.parquet(f"{root}/route_model/evaluation").first()
    assert 0 <= facts.macro_f1 <= 1 and facts.predicted_llm_chunks == facts.predicted_llm_small + facts.predicted_llm_large
    for model, gate in ((f"{root}/route_model", "shadow_keep_heuristic"), (f"{root}/none", "model_not_found")):
        assert cli.main(["triage", "--root", root, "--ml-route-mode", "shadow", "--ml-route-model", model]) == 0
        assert {r.gates[1] for r in spark.read.parquet(f"{root}/triage").where("heuristic_route <> 'skip'").collect()} == {gate}
    assert cli.main(["load", "chunks", "--root", root]) == 0 and store.read("chunk_text_refs").count() == store.read("chunks").count() == spark.read.parquet(f"{root}/chunks").count()
    n = store.read("events").count()
    assert cli.main(["load", "events", "--root", root]) == 0 and store.read("events").count() == n  # the same answers again: nothing new


def test_files_to_pages(spark, tmp_path):
    """Without a PDF library and OCR programs files are listed and probed with an error, and nothing fails."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.pdf").write_bytes(b"%PDF-1.4 broken")
    with zipfile.ZipFile(tmp_path / "in" / "z.zip", "w") as z:
        z.writestr("b.pdf", "x")
    args = ["--root", f"file://{tmp_path}/out", "--input", f"file://{tmp_path}/in"]
    assert cli.main(["pipeline", *args, "--include-unknown"]) == 0 and cli.main(["extract-text", *args]) == 0
    for _ in range(2):
        assert cli.main(["load", "manifest", *args]) == 0 and cli.CaseStore(spark, f"file://{tmp_path}/out/store").read("files").count() == 2
    p1 = spark.read.parquet(f"file://{tmp_path}/out/phase1").collect()
    assert len(p1) == 2 and {r.classification for r in p1} == {"unknown"} and all(r.errors for r in p1)
    assert spark.read.parquet(f"file://{tmp_path}/out/pages").count() == 0


def test_unknown_verbs_are_refused():
    with pytest.raises(SystemExit):
        cli.main(["nothing", "--root", "x"])
