import json

import pytest
from pyspark.sql import functions as F

from caseloom.sources import export, jsonl
from caseloom.sources.store import CaseStore
from caseloom.streaming import ingest as streams
from tests.conftest import SF


def test_jsonl_round_trip_and_shards(spark, tmp_path):
    root = f"file://{tmp_path}"
    df = spark.range(10).select(F.col("id").cast("string").alias("file_id"))
    jsonl.write_jsonl(df.coalesce(1), f"{root}/out", shard_size=4)
    assert len(list((tmp_path / "out").glob("*.gz"))) == 3 and jsonl.read_jsonl(spark, f"{root}/out", "file_id string").count() == 10
    with pytest.raises(jsonl.ResumeError):
        jsonl.shards(spark, root)
    (tmp_path / "docs_0001.jsonl").write_text('{"file_id": "a"}\n')
    assert [s.rsplit("/", 1)[1] for s in jsonl.shards(spark, root)] == ["docs_0001.jsonl"]
    with pytest.raises(jsonl.ResumeError):
        jsonl.check_resume(spark, root, 5, ".jsonl")
    manifest = {"shard_size": 5, "shards": [{"shard": "docs_0001.jsonl"}]}
    (tmp_path / "manifest.json").write_text(json.dumps(manifest))
    jsonl.check_resume(spark, root, 5, ".jsonl")
    for size, ext in ((6, ".jsonl"), (5, ".gz")):
        with pytest.raises(jsonl.ResumeError):
            jsonl.check_resume(spark, root, size, ext)
    manifest["shards"].append({"shard": "docs_0002.jsonl"})
    (tmp_path / "manifest.json").write_text(json.dumps(manifest))
    with pytest.raises(jsonl.ResumeError):
        jsonl.shards(spark, root)


def test_resume_and_replace(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *x: spark.createDataFrame(x, "file_id string, v int")
    assert jsonl.append_new(rows(("a", 1), ("a", 1), ("b", 1)), path, "file_id").count() >= 0
    jsonl.append_new(rows(("b", 2), ("c", 2)), path, "file_id")
    got = lambda: sorted((r.file_id, r.v) for r in spark.read.parquet(path).collect())
    assert got() == [("a", 1), ("b", 1), ("c", 2)]
    jsonl.replace_keys(rows(("a", 9), ("d", 9)), path)
    assert got() == [("a", 9), ("b", 1), ("c", 2), ("d", 9)]


def test_shards_of_our_own(spark, tmp_path):
    root = f"file://{tmp_path}"
    for n, size in ((23, 5), (7, 3)):
        df = spark.createDataFrame([(f"f{i * 5 % n:03d}", i) for i in range(n)], "file_id string, v int").repartition(3)
        m = jsonl.write_shards(df, root, size, ["file_id"])
        assert [s["doc_count"] for s in m["shards"]] == [min(size, n - k) for k in range(0, n, size)] and m["shards"][-1]["end_index"] == n - 1
        jsonl.check_resume(spark, root, size, ".jsonl.gz")
        files = jsonl.shards(spark, root)
        got = [[r.file_id for r in jsonl.read_jsonl(spark, f, "file_id string").collect()] for f in files]
        assert [x for part in got for x in part] == [f"f{i:03d}" for i in range(n)] and len(files) == -(-n // size)


def test_interrupted_replacement_is_ended(spark, tmp_path):
    path = tmp_path / "t"
    rows = lambda *x: spark.createDataFrame(x, "file_id string, v int")
    jsonl.replace_keys(rows(("a", 1)), f"file://{path}")
    path.rename(tmp_path / "t.old")  # between the renames, with the new table unfinished
    jsonl.recover(spark, f"file://{path}")
    assert spark.read.parquet(f"file://{path}").count() == 1
    path.rename(tmp_path / "t.old")  # and with it whole
    rows(("a", 1), ("b", 2)).write.parquet(f"file://{path}.next")
    jsonl.replace_keys(rows(("c", 3)), f"file://{path}")
    assert sorted(r.file_id for r in spark.read.parquet(f"file://{path}").collect()) == ["a", "b", "c"] and not (tmp_path / "t.old").exists()


def test_packs_and_ids(spark, tmp_path):
    (tmp_path / "p.txt").write_text("# c\n alpha \nalpha\n\n" + "x" * 300)
    (tmp_path / "ids.list").write_text("a\n\n b \n")
    assert jsonl.read_packs(spark, f"file://{tmp_path}") == {"p": ["alpha"]}
    assert sorted(r.file_id for r in jsonl.read_ids(spark, f"file://{tmp_path}/ids.list").collect()) == ["a", "b"] and jsonl.read_ids(spark, None).count() == 0


def test_store(spark, tmp_path):
    s = CaseStore(spark, f"file://{tmp_path}/store")
    s.write("files", spark.range(3))
    s.note("run", "ok")
    assert s.has("files") and not s.has("events") and set(s.tables()) == {"files", "meta"}
    with pytest.raises(KeyError):
        s.path("other")


def test_exports(spark, tmp_path):
    e = spark.createDataFrame([("Person", str(i), "IN_CASE", "Case", "O'N\\1") for i in range(30)], "src_type string, src_id string, edge_type string, dst_type string, dst_id string")
    out = export.cypher_edges(e, 10).collect()
    assert len(out) <= 3 and sum(r.statement.count("{edge_key: 'P") for r in out) == 30 and all("O\\'N\\\\1" in r.statement and r.statement.endswith(";") for r in out)
    nodes = spark.createDataFrame([("Case", "A1", None, ["x", "y'"])], "node_type string, node_id string, case_id_display string, sources array<string>")
    assert export.cypher_nodes(nodes, "Case").first().statement == "UNWIND [{case_id_norm: 'A1', case_id_display: null, sources: ['x', 'y\\'']}] AS r MERGE (n:Case {case_id_norm: r.case_id_norm}) SET n += r;"
    lenient = spark.createDataFrame([("A", "a", '["x","y"]'), ("B", "", "[x, y"), ("C", None, None)], "case_id_norm string, case_id_display string, sources string")
    assert [r.sources for r in export.case_nodes(lenient).orderBy("node_id").collect()] == [["x", "y"], None, None]
    export.export_jsonl(e, f"file://{tmp_path}/kg", ["src_id"])
    lines = [json.loads(x) for f in sorted((tmp_path / "kg").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["src_id"] for x in lines] == sorted(x["src_id"] for x in lines) and list(lines[0]) == sorted(lines[0])
    assert len(export.constraints()) == 5 and json.loads(export.build_manifest({}, [], 1))["status"] == "diffs"


def test_stream_equals_batch(spark, tmp_path):
    src, out, ck = (f"file://{tmp_path}/{n}" for n in ("src", "out", "ck"))
    spark.createDataFrame([("c1", 1), ("c2", 2), ("c1", 1)], "chunk_id string, v int").coalesce(1).write.json(src)
    for _ in range(2):
        streams.load_new(streams.jsonl_stream(spark, src, "chunk_id string, v int"), out, ck).awaitTermination()
    spark.createDataFrame([("c2", 2), ("c3", 3)], "chunk_id string, v int").coalesce(1).write.mode("append").json(src)
    streams.load_new(streams.jsonl_stream(spark, src, "chunk_id string, v int"), out, ck).awaitTermination()
    assert sorted(r.chunk_id for r in spark.read.parquet(out).collect()) == ["c1", "c2", "c3"]


def test_windows_and_sessions_on_a_stream(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    (tmp_path / "in").mkdir()
    events.coalesce(1).write.mode("overwrite").parquet(f"file://{tmp_path}/in")
    live = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in")
    for name, f in (("w", streams.windowed_counts), ("s", streams.sessions)):
        q = f(live, late="1000 days").writeStream.format("memory").queryName(f"out_{name}").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/ck{name}").start()
        q.awaitTermination()
        assert sorted(map(str, spark.table(f"out_{name}").collect())) == sorted(map(str, f(events).collect()))
    assert streams.deduplicated(events.union(events)).count() == events.count()


def test_running_budget(spark, tmp_path):
    rows = [(f"c{i}", "f", 4) for i in range(5)]
    spark.createDataFrame(rows, "chunk_id string, file_id string, token_est int").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    live = spark.readStream.schema("chunk_id string, file_id string, token_est int").parquet(f"file://{tmp_path}/in")
    q = streams.running_budget(live, 10).writeStream.format("memory").queryName("budget").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/ck").start()
    q.awaitTermination()
    assert spark.table("budget").where("taken").count() == 2
