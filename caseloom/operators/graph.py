"""The knowledge graph: edges with evidence, integrity, volumes, traversals, parity with an export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.sources.scratch import written

#: What an edge, and a piece of its evidence, is unique by.
EDGE = ["src_type", "src_id", "edge_type", "dst_type", "dst_id"]
EVIDENCE = [*EDGE, "file_id", "chunk_id", "page_start", "page_end", "source_phase", "extractor_version"]


def merged_pages(*pairs: tuple[Column, Column]) -> tuple[Column, Column]:
    """Smallest start and largest end of page ranges; -1 where unknown, swapped if reversed."""
    a, b = F.array_min(F.array_compact(F.array(*[p[0] for p in pairs]))), F.array_max(F.array_compact(F.array(*[p[1] for p in pairs])))
    swap = (a >= 0) & (b >= 0) & (a > b)
    a, b = F.coalesce(a, F.lit(-1)), F.coalesce(b, F.lit(-1))
    return F.when(F.coalesce(swap, F.lit(False)), b).otherwise(a), F.when(F.coalesce(swap, F.lit(False)), a).otherwise(b)


def _rows(df: DataFrame, src: tuple[str, Column], edge: str, dst: tuple[str, Column], pages: tuple[Column, Column], phase: Column) -> DataFrame:
    return df.select(
        F.lit(src[0]).alias("src_type"), src[1].cast("string").alias("src_id"), F.lit(edge).alias("edge_type"), F.lit(dst[0]).alias("dst_type"), dst[1].cast("string").alias("dst_id"),
        "file_id", "chunk_id", pages[0].cast("int").alias("page_start"), pages[1].cast("int").alias("page_end"), "confidence", phase.alias("source_phase"), F.lit("").alias("extractor_version"),
    ).where("src_id IS NOT NULL AND dst_id IS NOT NULL AND trim(dst_id) <> '' AND file_id IS NOT NULL AND chunk_id <> ''")


def event_in_case(events: DataFrame, event_cases: DataFrame) -> DataFrame:
    df = event_cases.join(events.select("event_id", "file_id", "chunk_id", "page_start", "page_end", "confidence"), "event_id")
    return _rows(df, ("Event", F.col("event_id")), "IN_CASE", ("Case", F.col("case_id_norm")), merged_pages((F.col("page_start"), F.col("page_end"))), F.concat(F.lit("phase9_event_cases:"), "source"))


def _of_people(members: DataFrame, obs: DataFrame) -> DataFrame:
    """Observations of people; those that have their person_id needn't meet the members again."""
    return obs if "person_id" in obs.columns else members.join(obs, "obs_id")


def mentioned_in_event(members: DataFrame, obs: DataFrame, events: DataFrame, max_people: int | None = None, max_events: int | None = None) -> DataFrame:
    """People and events of one chunk. Chunks over a cap are left out before anything is joined."""
    key = ["file_id", "chunk_id"]
    p = _of_people(members, obs).select("person_id", *key, F.col("page_start").alias("ps"), F.col("page_end").alias("pe")).distinct()
    e = events.select("event_id", *key, F.col("page_start").alias("es"), F.col("page_end").alias("ee"), "confidence").distinct()
    if max_people is not None:
        p = p.join(p.groupBy(*key).agg(F.countDistinct("person_id").alias("n")).where(F.col("n") <= max_people).drop("n"), key, "left_semi")
    if max_events is not None:
        e = e.join(e.groupBy(*key).agg(F.countDistinct("event_id").alias("n")).where(F.col("n") <= max_events).drop("n"), key, "left_semi")
    pages = merged_pages((F.col("ps"), F.col("pe")), (F.col("es"), F.col("ee")))
    return _rows(p.join(e, key), ("Person", F.col("person_id")), "MENTIONED_IN_EVENT", ("Event", F.col("event_id")), pages, F.lit("phase11_cooccurrence:file_chunk"))


def skipped_chunks(members: DataFrame, obs: DataFrame, events: DataFrame, max_people: int | None = None, max_events: int | None = None) -> DataFrame:
    """n: chunks with people and events that mentioned_in_event() leaves out under these caps."""
    key = ["file_id", "chunk_id"]
    p = _of_people(members, obs).groupBy(*key).agg(F.countDistinct("person_id").alias("p"))
    e = events.groupBy(*key).agg(F.countDistinct("event_id").alias("e"))
    over = F.lit(False)
    for name, cap in (("p", max_people), ("e", max_events)):
        over = over | (F.col(name) > cap) if cap is not None else over
    return p.join(e, key).agg(F.count_if(over).alias("n"))


def person_in_case(members: DataFrame, obs: DataFrame, signals: DataFrame, name_norm: Column) -> DataFrame:
    """Case signals of a chunk that carry a resolved person's name. name_norm: the signals' normal name."""
    s = signals.where("attribute = 'case_id' AND value_norm IS NOT NULL").select("file_id", "chunk_id", name_norm.alias("name_norm"), "value_norm", "page_start", "page_end", "confidence")
    who = _of_people(members, obs).select("person_id", "file_id", "chunk_id", "name_norm").distinct()
    df = s.join(who, ["file_id", "chunk_id", "name_norm"]).distinct()
    pages = F.coalesce("page_start", F.lit(-1)), F.coalesce("page_end", F.lit(-1))
    return _rows(df, ("Person", F.col("person_id")), "IN_CASE", ("Case", F.col("value_norm")), pages, F.lit("phase6_identity_signals:case_id"))


def edges(evidence: DataFrame) -> DataFrame:
    return evidence.select(*EDGE).distinct()


def linked_edges(events: DataFrame, event_cases: DataFrame, members: DataFrame, obs: DataFrame, signals: DataFrame, name_norm: Column) -> DataFrame:
    """edges() of the evidence of events in cases, people in events and people in cases, without its pages and confidence.

    No two kinds have an edge in common, so each is made distinct by its two ids. event_cases: with the file_id and chunk_id of their events, which
    then needn't meet the events again.
    """
    key = ["file_id", "chunk_id"]
    placed = lambda df: df.where("file_id IS NOT NULL AND chunk_id <> ''")

    def kind(df: DataFrame, src: str, edge: str, dst: str) -> DataFrame:
        # A number is never blank: unasked, both kinds that meet events by chunk read one shuffle of them.
        known = df.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL" + " AND trim(dst) <> ''" * (df.schema["dst"].dataType.typeName() == "string"))
        return known.distinct().select(F.lit(src).alias("src_type"), F.col("src").cast("string").alias("src_id"), F.lit(edge).alias("edge_type"), F.lit(dst).alias("dst_type"), F.col("dst").cast("string").alias("dst_id"))

    # Of the two sides of a join one is distinct, so repeated rows of the other stay as many.
    who = placed(_of_people(members, obs)).select(F.col("person_id").alias("src"), *key, "name_norm")
    named = placed(signals).where("attribute = 'case_id'").select(*key, name_norm.alias("name_norm"), F.col("value_norm").alias("dst")).distinct()
    mentioned = who.drop("name_norm").distinct().join(placed(events).select("event_id", *key), key).withColumnRenamed("event_id", "dst")
    in_case = placed(event_cases).select(F.col("event_id").alias("src"), F.col("case_id_norm").alias("dst"))
    return kind(in_case, "Event", "IN_CASE", "Case").unionAll(kind(mentioned, "Person", "MENTIONED_IN_EVENT", "Event")).unionAll(kind(who.join(named, [*key, "name_norm"]), "Person", "IN_CASE", "Case"))


def unique_evidence(evidence: DataFrame) -> DataFrame:
    """One row for each evidence key, with the largest confidence."""
    return evidence.groupBy(*EVIDENCE).agg(F.max("confidence").alias("confidence"))


def cases(signals: DataFrame, event_cases: DataFrame) -> DataFrame:
    """case_id_norm, case_id_display, sources (sorted), is_fallback."""
    a = signals.where("attribute = 'case_id' AND value_norm IS NOT NULL").select(F.col("value_norm").alias("c"), F.col("value").alias("d"), F.lit("identity_signals").alias("s"))
    b = event_cases.select(F.col("case_id_norm").alias("c"), F.lit(None).cast("string").alias("d"), F.lit("event_cases").alias("s"))
    out = a.unionByName(b).groupBy(F.col("c").alias("case_id_norm")).agg(F.coalesce(F.min("d"), F.min("c")).alias("case_id_display"), F.array_sort(F.collect_set("s")).alias("sources"))
    return out.withColumn("is_fallback", F.col("case_id_norm").startswith("file:"))


def merged_cases(known: DataFrame, new: DataFrame) -> DataFrame:
    """Cases found again keep their display name where they had one, and take the new sources; others come beside."""
    n = new.select("case_id_norm", *[F.col(c).alias(f"n_{c}") for c in ("case_id_display", "sources", "is_fallback")])
    k = known.select("case_id_norm", "case_id_display", "sources", "is_fallback").join(n, "case_id_norm", "full")
    return k.select("case_id_norm", F.coalesce("case_id_display", "n_case_id_display").alias("case_id_display"), F.when(F.col("n_is_fallback").isNotNull(), F.col("n_sources")).otherwise(F.col("sources")).alias("sources"), F.coalesce("n_is_fallback", "is_fallback").alias("is_fallback"))


def counted(all_edges: DataFrame, evidence: DataFrame, nodes: DataFrame) -> DataFrame:
    """kind (node, edge, evidence), type, n."""
    n = lambda df, kind, c: df.groupBy(F.col(c).alias("type")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    return n(nodes, "node", "type").unionByName(n(all_edges, "edge", "edge_type")).unionByName(n(evidence, "evidence", "edge_type"))


def dangling(all_edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edge ends that no node (type, id) has: side, type, id, n."""
    ends = all_edges.select(F.lit("src").alias("side"), F.col("src_type").alias("type"), F.col("src_id").alias("id")).unionAll(all_edges.select(F.lit("dst"), "dst_type", "dst_id"))
    return ends.groupBy("side", "type", "id").agg(F.count("*").alias("n")).join(nodes, ["type", "id"], "left_anti").select("side", "type", "id", "n")


def validated(all_edges: DataFrame, nodes: DataFrame, strict: bool = False) -> DataFrame:
    """Counts of what is wrong: missing fields, unknown types, dangling ends. Strict: raises if any."""
    missing = all_edges.agg(F.count_if(F.greatest(*[(F.trim(F.coalesce(c, F.lit(""))) == "").cast("int") for c in EDGE]) == 1).alias("n")).select(F.lit("missing_field").alias("issue"), "n")
    unknown = all_edges.agg(F.count_if(~F.col("src_type").isin("Person", "Event", "Case") | ~F.col("dst_type").isin("Person", "Event", "Case")).alias("n")).select(F.lit("unknown_type").alias("issue"), "n")
    loose = dangling(all_edges, nodes).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("dangling_end").alias("issue"), "n")
    out = missing.union(unknown).union(loose)
    if strict and (bad := out.where("n > 0").collect()):
        raise ValueError(f"the graph is inconsistent: {[(r.issue, r.n) for r in bad]}")
    return out


def rank_percentiles(counts: DataFrame, key: str, rounded: bool = False) -> DataFrame:
    """p50, p90, p99, max of column n by key: the value at index floor((n - 1) * p), or at the half-even rounded one.

    A value's rank is known from how often each value occurs, so equal values are counted, not sorted.
    """
    hist = counts.groupBy(key, "n").agg(F.count("*").alias("c"))
    w = Window.partitionBy(key)
    upto = hist.withColumn("upto", F.sum("c").over(w.orderBy("n"))).withColumn("total", F.sum("c").over(w))
    at = lambda p: (F.bround if rounded else F.floor)((F.col("total") - 1) * p)
    pick = lambda p: F.min(F.when(F.col("upto") > at(p), F.col("n")))
    return upto.groupBy(key).agg(pick(0.5).alias("p50"), pick(0.9).alias("p90"), pick(0.99).alias("p99"), F.max("n").alias("max"), F.sum("c").alias("n_keys"))


def edge_volumes(all_edges: DataFrame, rounded: bool = False) -> DataFrame:
    """Percentiles of edges for each source node, by edge type."""
    return rank_percentiles(all_edges.groupBy("edge_type", "src_type", "src_id").agg(F.count("*").alias("n")), "edge_type", rounded)


def top_edge_types(all_edges: DataFrame, n: int = 20) -> DataFrame:
    return all_edges.groupBy("edge_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "edge_type").limit(n)


def two_hop(all_edges: DataFrame, people: DataFrame | None = None, limit: int = 200) -> DataFrame:
    """(person, other): the first `limit` others by id that share a case with each person of people (column person; None: all).

    A case's first limit + 1 people are all that can be among a person's first `limit`, so a case of any size gives each of its people no more than those.
    """
    c = all_edges.where("src_type = 'Person' AND edge_type = 'IN_CASE'").select(F.col("src_id").alias("person"), "dst_id").distinct()
    first = c.withColumn("r", F.row_number().over(Window.partitionBy("dst_id").orderBy("person"))).where(F.col("r") <= limit + 1).select("dst_id", F.col("person").alias("other"))
    mine = c if people is None else c.join(people.select("person").distinct(), "person", "left_semi")
    found = mine.join(first, "dst_id").where("person <> other").select("person", "other").distinct()
    return found.withColumn("r", F.row_number().over(Window.partitionBy("person").orderBy("other"))).where(F.col("r") <= limit).drop("r")


def two_hop_of(all_edges: DataFrame, person: str, limit: int = 200) -> DataFrame:
    one = all_edges.sparkSession.createDataFrame([(person,)], "person string")
    return two_hop(all_edges, one, limit).select("other").orderBy("other")


def case_overview(all_edges: DataFrame, case: str, people: int = 50, events: int = 50) -> DataFrame:
    own = all_edges.where((F.col("edge_type") == "IN_CASE") & (F.col("dst_id") == case)).select("src_type", "src_id").distinct()
    part = lambda kind, n: own.where(F.col("src_type") == kind).orderBy("src_id").limit(n)
    return part("Person", people).union(part("Event", events))


def person_profile(all_edges: DataFrame, person: str, cases: int = 50, events: int = 50) -> DataFrame:
    """dst_type, dst_id: the first cases that a person is in and events that they are mentioned in."""
    own = all_edges.where((F.col("src_type") == "Person") & (F.col("src_id") == person)).select("edge_type", "dst_type", "dst_id").distinct()
    part = lambda edge, kind, n: own.where((F.col("edge_type") == edge) & (F.col("dst_type") == kind)).orderBy("dst_id").limit(n).select("dst_type", "dst_id")
    return part("IN_CASE", "Case", cases).union(part("MENTIONED_IN_EVENT", "Event", events))


def event_storyline(all_edges: DataFrame, event_times: DataFrame, case: str, limit: int = 500) -> DataFrame:
    own = all_edges.where((F.col("src_type") == "Event") & (F.col("edge_type") == "IN_CASE") & (F.col("dst_id") == case)).select(F.col("src_id").cast("long").alias("event_id"))
    return own.join(event_times, "event_id", "left").orderBy(F.col("date_start").asc_nulls_last(), "event_id").limit(limit)


def explain_edge(evidence: DataFrame, edge: dict[str, str], limit: int = 200) -> DataFrame:
    df = evidence
    for c, v in edge.items():
        df = df.where(F.col(c) == v)
    return df.orderBy("file_id", "chunk_id", "page_start", "page_end").limit(limit)


def parity(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
    """Distinct rows that one side has and the other hasn't: kind, side, n. Nulls are equal; one aggregate over both, and always two rows."""
    one = _unmatched(left, right, left.columns).agg(F.count_if("__l").alias("only_left"), F.count_if(~F.col("__l")).alias("only_right"))
    return one.select(F.expr("stack(2, 'only_left', only_left, 'only_right', only_right) AS (side, n)")).select(F.lit(kind).alias("kind"), "side", "n")


def parity_report(left: DataFrame, right: DataFrame, left_evidence: DataFrame, right_evidence: DataFrame, max_cases: int | None = None, max_people: int | None = None) -> DataFrame:
    """kind, key, only_left, only_right: all differences between two graphs, of six kinds.

    count (of edges, of evidence), case_events, case_people, person_cases, person_events, and person_twohop_via_case: people who share a case. Keys but
    those of counts are hashed. max_cases, max_people: only the first of each by id are compared.
    """
    a, b = _sets(left), _sets(right)
    # All edges meet once; what each kind says comes from those that one side lacks.
    lost = written(_unmatched(left, right, EDGE))
    only = _sets(lost)
    parts = []
    for kind, most in (("case_events", max_cases), ("case_people", max_cases), ("person_cases", max_people), ("person_events", max_people)):
        parts.append(_differences(_first(only[kind], a[kind], b[kind], most), kind))
    hops = _hops_lost(a["person_cases"], b["person_cases"], only["person_cases"])
    parts.append(_differences(_first(hops, a["person_cases"], b["person_cases"], max_people), "person_twohop_via_case"))
    out = reduce(DataFrame.unionByName, parts).withColumn("key", F.substring(F.sha2("key", 256), 1, 12))
    for key, x, y in (("kg_edges", left, right), ("kg_edge_evidence", left_evidence, right_evidence)):
        n = x.agg(F.count("*").alias("l")).join(y.agg(F.count("*").alias("r")), F.lit(True))
        out = out.unionByName(n.where("l <> r").select(F.lit("count").alias("kind"), F.lit(key).alias("key"), (F.col("l") > 0).cast("long").alias("only_left"), (F.col("r") > 0).cast("long").alias("only_right")))
    return out


def _sets(edges_: DataFrame) -> dict[str, DataFrame]:
    """What edges say of each case and person: (key, value), distinct, and side of those that one side lacks."""
    in_case = edges_.where("edge_type = 'IN_CASE' AND dst_type = 'Case'")
    people = in_case.where("src_type = 'Person'")
    mentioned = edges_.where("src_type = 'Person' AND edge_type = 'MENTIONED_IN_EVENT' AND dst_type = 'Event'")
    side = [F.when(F.col("__l"), "left").otherwise("right").alias("side")] if "__l" in edges_.columns else []
    pick = lambda df, key, value: df.select(F.col(key).alias("key"), F.col(value).alias("value"), *side).distinct()
    return {"case_events": pick(in_case.where("src_type = 'Event'"), "dst_id", "src_id"), "case_people": pick(people, "dst_id", "src_id"), "person_cases": pick(people, "src_id", "dst_id"), "person_events": pick(mentioned, "src_id", "dst_id")}


def _first(found: DataFrame, a: DataFrame, b: DataFrame, most: int | None) -> DataFrame:
    if most is None:
        return found
    return found.join(a.select("key").union(b.select("key")).distinct().orderBy("key").limit(most), "key", "left_semi")


def _hops_lost(a: DataFrame, b: DataFrame, changed: DataFrame) -> DataFrame:
    """(key, value, side): pairs of people who share a case on one side only, of (key person, value case) on either; changed: what one side lacks.

    Such a pair has a membership that the other side lacks, so only changed memberships meet their case's people; what another case links there is no difference.
    """
    out = None
    for side, own, other in (("left", a, b), ("right", b, a)):
        moved = changed.where(F.col("side") == side).select(F.col("key").alias("p"), F.col("value").alias("case"))
        one = moved.join(own.select(F.col("key").alias("q"), F.col("value").alias("case")), "case").where("p <> q")
        pairs = one.select("p", "q").union(one.select("q", "p")).distinct()
        linked = pairs.join(other.select(F.col("key").alias("p"), F.col("value").alias("case")), "p").join(other.select(F.col("key").alias("q"), F.col("value").alias("case")), ["q", "case"], "left_semi")
        lost = pairs.join(linked.select("p", "q").distinct(), ["p", "q"], "left_anti").select(F.col("p").alias("key"), F.col("q").alias("value"), F.lit(side).alias("side"))
        out = lost if out is None else out.unionByName(lost)
    return out


def _unmatched(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct rows, by `columns`, that one of the two has and the other hasn't, with __l (a has it): one aggregate over both."""
    both = a.select(*columns, F.lit(True).alias("__l"), F.lit(False).alias("__r")).unionAll(b.select(*columns, F.lit(False), F.lit(True)))
    return both.groupBy(*columns).agg(F.max("__l").alias("__l"), F.max("__r").alias("__r")).where("__l <> __r").drop("__r")


def _differences(found: DataFrame, kind: str) -> DataFrame:
    return found.groupBy("key").agg(F.count_if(F.col("side") == "left").alias("only_left"), F.count_if(F.col("side") == "right").alias("only_right")).select(F.lit(kind).alias("kind"), "key", "only_left", "only_right")
