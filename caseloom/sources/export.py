"""The graph for others: sorted JSON Lines, Cypher text, a build manifest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.ids import edge_key
from caseloom.sources.jsonl import ResumeError, exists

#: Rows of one UNWIND statement.
BATCH = 500
#: Unique properties of the graph's nodes.
NODE_KEYS = {"Person": "person_id", "Event": "event_id", "Case": "case_id_norm"}


def sorted_json(df: DataFrame) -> Column:
    """A row as JSON with its keys in alphabetical order, nulls included."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def export_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """One record a line in a fixed order. Range-sorted parts: their names are in order, so their concatenation is."""
    df.withColumn("__j", sorted_json(df)).orderBy(*order).select("__j").write.mode("overwrite").text(path)


def cypher_text(value: Column) -> Column:
    """A single-quoted string."""
    c = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("'"))


def _literal(df: DataFrame, columns: list[str]) -> Column:
    """A row's columns as a Cypher map; null stays null, arrays are lists of strings."""

    def value(name: str) -> Column:
        kind, c = df.schema[name].dataType.simpleString(), F.col(name)
        if kind.startswith("array"):
            text = F.concat(F.lit("["), F.array_join(F.transform(c, cypher_text), ", "), F.lit("]"))
        else:
            text = cypher_text(c) if kind == "string" else c.cast("string")
        return F.concat(F.lit(f"{name}: "), F.coalesce(text, F.lit("null")))

    return F.concat(F.lit("{"), F.concat_ws(", ", *map(value, columns)), F.lit("}"))


def _batched(rows: DataFrame, kinds: list[str], key: list[str], item: Column, batch: int) -> DataFrame:
    """kinds, batch, items: lists of about `batch` items of one kind each, dealt by hash so that nothing is sorted as a whole."""
    sizes = rows.groupBy(*kinds).agg(F.ceil(F.count("*") / batch).alias("n"))
    # One row for each kind of node or edge: a handful.
    dealt = rows.withColumn("item", item).join(F.broadcast(sizes), kinds).withColumn("batch", F.pmod(F.xxhash64(*key), F.col("n")))
    return dealt.groupBy(*kinds, "batch").agg(F.array_join(F.array_sort(F.collect_list("item")), ", ").alias("items"))


def cypher_nodes(nodes: DataFrame, kind: str, batch: int = BATCH) -> DataFrame:
    """batch, statement: UNWIND ... MERGE of nodes (node_id and properties) with their properties."""
    named = nodes.drop("node_type").withColumnRenamed("node_id", NODE_KEYS[kind]).withColumn("kind", F.lit(kind))
    items = _batched(named, ["kind"], [NODE_KEYS[kind]], _literal(named, [c for c in named.columns if c != "kind"]), batch)
    text = F.concat(F.lit("UNWIND ["), "items", F.lit(f"] AS r MERGE (n:{kind} {{{NODE_KEYS[kind]}: r.{NODE_KEYS[kind]}}}) SET n += r;"))
    return items.select("batch", text.alias("statement"))


def cypher_edges(edges: DataFrame, batch: int = BATCH) -> DataFrame:
    """src_type, edge_type, dst_type, batch, statement: an edge is a node of its own, with its key and ends, so that evidence can point to it."""
    kinds, whole = ["src_type", "edge_type", "dst_type"], ["src_type", "src_id", "edge_type", "dst_type", "dst_id"]
    keyed = edges.withColumn("edge_key", edge_key(*map(F.col, whole)))
    items = _batched(keyed, kinds, ["src_id", "dst_id"], _literal(keyed, ["edge_key", *whole]), batch)
    prop = F.create_map(*[F.lit(x) for kv in NODE_KEYS.items() for x in kv])
    end = lambda name, side, link: F.concat(F.lit(f" MERGE ({name}:"), F.col(f"{side}_type"), F.lit(" {"), prop[F.col(f"{side}_type")], F.lit(f": r.{side}_id}}) MERGE "), F.lit(link))
    text = F.concat(F.lit("UNWIND ["), "items", F.lit("] AS r MERGE (e:KGEdge {edge_key: r.edge_key}) SET e += r"), end("s", "src", "(s)-[:KG_SRC]->(e)"), end("d", "dst", "(e)-[:KG_DST]->(d)"), F.lit(";"))
    return items.select(*kinds, "batch", text.alias("statement"))


def cypher_evidence(evidence: DataFrame, batch: int = BATCH) -> DataFrame:
    """edge_type, batch, statement: evidence nodes with their properties, each pointing to its edge."""
    own = ["file_id", "chunk_id", "page_start", "page_end", "source_phase", "extractor_version"]
    keyed = evidence.withColumn("edge_key", edge_key(*map(F.col, ("src_type", "src_id", "edge_type", "dst_type", "dst_id"))))
    keyed = keyed.withColumn("evidence_key", edge_key(*map(F.col, ("edge_key", *own))))
    items = _batched(keyed, ["edge_type"], ["evidence_key"], _literal(keyed, ["evidence_key", "edge_key", *own, "confidence"]), batch)
    text = F.concat(F.lit("UNWIND ["), "items", F.lit("] AS r MERGE (v:KGEvidence {evidence_key: r.evidence_key}) SET v += r WITH v, r MATCH (e:KGEdge {edge_key: r.edge_key}) MERGE (v)-[:EVIDENCE_FOR]->(e);"))
    return items.select("edge_type", "batch", text.alias("statement"))


def constraints() -> list[str]:
    unique = NODE_KEYS | {"KGEdge": "edge_key", "KGEvidence": "evidence_key"}
    return [f"CREATE CONSTRAINT IF NOT EXISTS FOR (n:{k}) REQUIRE n.{p} IS UNIQUE;" for k, p in unique.items()]


#: The files of a graph export, and what each is sorted by.
FILES = {
    "nodes/person": ["node_id"], "nodes/event": ["node_id"], "nodes/case": ["node_id"], "edges/edges": ["src_type", "src_id", "edge_type", "dst_type", "dst_id"],
    "edges/edge_evidence": ["src_type", "src_id", "edge_type", "dst_type", "dst_id", "file_id", "chunk_id", "page_start", "page_end", "source_phase", "extractor_version"],
}


def person_nodes(people: DataFrame) -> DataFrame:
    return people.where("person_id IS NOT NULL AND display_name IS NOT NULL AND display_name_norm IS NOT NULL").select(
        F.lit("Person").alias("node_type"), F.col("person_id").cast("string").alias("node_id"), "display_name", "display_name_norm", F.nullif("dob", F.lit("")).alias("dob")
    )


def event_nodes(events: DataFrame, times: DataFrame | None) -> DataFrame:
    """Events with what the timeline says of them, if there is one."""
    e = events.where("event_id IS NOT NULL AND event IS NOT NULL").select("event_id", "event", F.nullif("date", F.lit("")).alias("date_raw"))
    own = ("date_start", "date_end", "precision", "status")
    e = e.withColumns({c: F.lit(None).cast("string") for c in own}) if times is None else e.join(times.select("event_id", *own), "event_id", "left")
    return e.select(F.lit("Event").alias("node_type"), F.col("event_id").cast("string").alias("node_id"), "event", "date_raw", *[F.nullif(c, F.lit("")).alias(c) for c in own])


def case_nodes(cases: DataFrame) -> DataFrame:
    """`sources` may be an array, or JSON text of one; text that is none counts as no sources."""
    sources = F.col("sources") if cases.schema["sources"].dataType.simpleString().startswith("array") else F.from_json("sources", "array<string>")
    return cases.where("case_id_norm IS NOT NULL AND case_id_norm <> ''").select(F.lit("Case").alias("node_type"), F.col("case_id_norm").alias("node_id"), F.nullif("case_id_display", F.lit("")).alias("case_id_display"), sources.alias("sources"))


def export_graph(root: str, people: DataFrame, events: DataFrame, times: DataFrame | None, cases: DataFrame, edges: DataFrame, evidence: DataFrame) -> None:
    """The five files of a graph, each a sorted set of JSON Lines parts below root."""
    complete = lambda df, names: df.where(" AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in names))
    ends = ["src_type", "src_id", "edge_type", "dst_type", "dst_id"]
    proof = complete(evidence, [*ends, "file_id", "chunk_id", "source_phase"]).withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in ("page_start", "page_end")})
    frames = dict(zip(FILES, (person_nodes(people), event_nodes(events, times), case_nodes(cases), complete(edges, ends).select(*ends), proof.select(*FILES["edges/edge_evidence"], "confidence"))))
    for name, order in FILES.items():
        export_jsonl(frames[name], f"{root}/{name}", order)


def export_paths(spark: SparkSession, root: str) -> dict[str, str]:
    """Where an export's files are: a folder of parts, or one file .jsonl.zst, .jsonl.gz or .jsonl. Raises if one is missing or there are several."""
    out = {}
    for name in FILES:
        there = [p for ext in ("", ".jsonl.zst", ".jsonl.gz", ".jsonl") if exists(spark, p := f"{root}/{name}{ext}")]
        if len(there) != 1:
            raise ResumeError(f"{'missing' if not there else 'ambiguous'} export file: {name}")
        out[name] = there[0]
    return out


def build_manifest(counts: dict[str, int], volumes: list[dict], diffs: int) -> str:
    return json.dumps({"counts": counts, "edge_volumes": volumes, "parity_diffs": diffs, "status": "ok" if not diffs else "diffs"}, sort_keys=True)
