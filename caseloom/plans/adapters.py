"""The test tables as the document model: pages, chunks, observations, utterances.

Each function has a twin in oracle.py that says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import normal_name
from caseloom.operators import chunking, resolve, threads, timeline, triage
from caseloom.sources.scratch import written

FIRST = ["robert", "bob", "william", "bill", "elizabeth", "liz", "james", "jim", "maria", "anna", "peter", "kate"]
LAST = ["smith", "jones", "garcia", "miller", "davis", "lopez", "wilson", "moore", "taylor", "clark"]
DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page for each line of a document, and closing lines with a date, an officer, a case and sometimes a speaker."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    i = F.col("doc_id")
    close = F.concat(F.lit("\nOn 2024-"), _two(i % 12 + 1), F.lit("-"), _two(i % 28 + 1), F.lit(" Officer Dana Reed reported to Acme Inc. about Case #A"), (i % 50 + 100).cast("string"), F.lit("."))
    full = F.concat("text", close, F.when(i % 3 == 0, F.lit("\nName: yes")).otherwise(""))
    file_id = F.sha2(F.concat(F.lit("fs||"), i.cast("string")), 256)
    return d.select("doc_id", file_id.alias("file_id"), F.posexplode(F.split(full, "\n")).alias("page_index", "text"))


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages and chunks are looked at: no limit on the characters seen."""
    return whole_chunks(pages(spark, sf))


def whole_chunks(pages: DataFrame) -> DataFrame:
    return chunking.chunks(pages, page_seen=None, chunk_seen=None)


def triaged(spark: SparkSession, sf: str) -> DataFrame:
    return triage.triaged(chunks(spark, sf), most=None, shaped=None)


def person(i: Column, short: Column) -> Column:
    """A name by number, of which there are as many as numbers; short forms of first names where `short` is 1."""
    first = F.element_at(F.array(*map(F.lit, FIRST)), ((i % 6) * 2 + short + 1).cast("int"))
    last = F.element_at(F.array(*map(F.lit, LAST)), (i % 10 + 1).cast("int"))
    return F.concat(F.initcap(first), F.lit(" "), F.initcap(last), F.floor(i / 60).cast("string"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with dates in ten forms; a chunk is a user's day."""
    e = table(spark, sf, "events")
    i, u, day, form = F.col("event_id"), F.col("user_id"), F.to_date("ts"), F.col("event_id") % 10
    fmt = lambda p, d=day: F.date_format(d, p)
    raw = (
        F.when(form == 0, fmt("yyyy-MM-dd")).when(form == 1, fmt("M/d/yyyy")).when(form == 2, fmt("MMMM d, yyyy")).when(form == 3, fmt("MMM yyyy")).when(form == 4, fmt("yyyy"))
        .when(form == 5, "yesterday").when(form == 6, F.concat(F.lit("last "), F.element_at(F.array(*map(F.lit, DAYS)), (u % 7 + 1).cast("int")))).when(form == 7, F.concat(fmt("yyyy-MM-dd"), F.lit(" and 2023-02-06")))
        .when(form == 8, F.concat(fmt("yyyy-MM-dd"), F.lit(" to "), fmt("yyyy-MM-dd", F.date_add(day, 4)))).when(i % 20 == 19, "unknown").otherwise("in 2 months")
    )
    return e.select(
        i.alias("event_id"), F.col("event_type").alias("event"), raw.alias("date"), F.when(i % 17 != 0, (i % 101) / 100).alias("confidence"), F.concat(F.lit("u"), u.cast("string")).alias("file_id"),
        F.concat(F.lit("u"), u.cast("string"), F.lit(":"), fmt("yyyy-MM-dd")).alias("chunk_id"), F.dayofmonth(day).alias("page_start"), (F.dayofmonth(day) + (i % 2)).cast("int").alias("page_end"),
        F.concat(F.lit("event "), i.cast("string"), F.lit(" "), "event_type").alias("quote"), u.alias("user_id"), day.alias("day"),
    )


def event_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunk texts of events: even days name their date. Ids follow from user and day, so only those two are made distinct."""
    c = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    file_id = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    c = c.select(file_id.alias("file_id"), F.concat(file_id, F.lit(":"), F.date_format("day", "yyyy-MM-dd")).alias("chunk_id"), "user_id", "day")
    return c.withColumn("text", F.when(F.dayofmonth("day") % 2 == 0, F.concat(F.lit("Report of "), F.date_format("day", "yyyy-MM-dd"), F.lit("."))).otherwise("no date here"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    u = table(spark, sf, "events").select("user_id").distinct()
    return u.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file_id"), F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("2024-02-"), _two(F.col("user_id") % 28 + 1), F.lit("T10:00:00Z"))).alias("mtime"))


def event_times(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.event_times(events(spark, sf), event_chunks(spark, sf), files(spark, sf), most=None)


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """A person and a place in each chunk: two users' files are about one person, so people grow with users and their groups don't."""
    return entities_in(event_chunks(spark, sf))


def entities_in(c: DataFrame) -> DataFrame:
    n, d = F.floor(F.col("user_id") / 2), F.dayofmonth("day")
    conf = F.lit(0.5) + (d % 5) / 10
    base = ["file_id", "chunk_id", d.alias("page_start"), d.alias("page_end")]
    who = c.select(person(n, d % 2).alias("entity"), F.lit("person").alias("type"), conf.alias("confidence"), *base, F.concat(F.lit("saw "), "chunk_id").alias("quote"), n.alias("pid"), "user_id")
    where = c.select(F.concat(F.lit("Town "), (n % 5).cast("string")).alias("entity"), F.lit("place").alias("type"), conf.alias("confidence"), *base, F.concat(F.lit("in "), "chunk_id").alias("quote"), n.alias("pid"), "user_id")
    return who.unionByName(where).withColumn("entity_id", F.xxhash64("chunk_id", "type"))


def signals(spark: SparkSession, sf: str) -> DataFrame:
    """Birth dates, addresses and case ids of those people."""
    return signals_of(entities(spark, sf))


def signals_of(found: DataFrame) -> DataFrame:
    p = found.where("type = 'person'")
    n = F.col("pid")
    dob = F.concat((n % 60 + 1940).cast("string"), F.lit("-"), _two(F.floor(n / 60) % 12 + 1), F.lit("-"), _two(F.floor(n / 720) % 28 + 1))
    s = lambda a, v: F.struct(F.lit(a).alias("attribute"), v.alias("value"))
    u = F.col("user_id")
    every = F.array_compact(F.array(F.when(u % 4 != 3, s("dob", dob)), F.when(u % 3 == 1, s("address", F.concat(n.cast("string"), F.lit(" Main  Street")))), F.when(u % 3 == 0, s("case_id", F.concat(F.lit(" case "), F.floor(u / 6).cast("string"))))))
    from caseloom.functions.text import address_key, birth_key, case_key

    out = p.select(F.col("entity").alias("person_text"), "confidence", "file_id", "chunk_id", "page_start", "page_end", "quote", F.explode(every).alias("s")).select("*", "s.attribute", "s.value").drop("s")
    norm = F.when(F.col("attribute") == "case_id", case_key(F.col("value"))).when(F.col("attribute") == "address", address_key(F.col("value"))).otherwise(birth_key(F.col("value")))
    return out.withColumn("value_norm", norm).withColumn("signal_id", F.xxhash64("chunk_id", "attribute"))


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """People observed, with their signals; a chunk has one, so its id serves."""
    return observed(*found(spark, sf))


def found(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Entities of chunks that are written, so that events are read once for them, and their signals."""
    who = entities_in(written(event_chunks(spark, sf).drop("text")))
    return who, signals_of(who)


def found_once(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """found() with what the graph reads of signals written too: their keys are made once."""
    who, signs = found(spark, sf)
    return who, written(signs.select("file_id", "chunk_id", "person_text", "attribute", "value_norm", "page_start", "page_end", "confidence"))


def observed(who: DataFrame, signs: DataFrame) -> DataFrame:
    return resolve.with_signals(resolve.observed(who).withColumn("obs_id", F.col("chunk_id")), signs)


def pairs(obs: DataFrame) -> DataFrame:
    return resolve.candidate_pairs(resolve.blocking_keys(obs))


def scored(obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles of written observations, written, and their scored pairs."""
    found = written(resolve.profiles(obs))
    return found, resolve.profile_scores(found)


def people(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Observations with their person_id, written once as every step reads them, and obs_id, person_id: a person is its component's smallest observation."""
    return resolved(written(observations(spark, sf)))


def resolved(obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rest = [c for c in obs.columns if c != "obs_id"]
    named = written(resolve.clustered_profiles(obs, *scored(obs), *rest).withColumnRenamed("root", "person_id"))
    return named, named.select("obs_id", "person_id")


def event_cases(spark: SparkSession, sf: str) -> DataFrame:
    return timeline.event_cases(events(spark, sf), signals(spark, sf))


def case_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence of events in cases: all that has an event as its source, and no person has to be known for it."""
    from caseloom.operators import graph

    return graph.event_in_case(events(spark, sf), event_cases(spark, sf))


def utterances(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations")
    i = F.col("conv_id")
    speaker = F.when(F.col("role") == "user", person(i % 12, F.lit(0))).otherwise(F.concat("role", F.lit(" "), (i % 5).cast("string")))
    return c.select(F.concat(F.lit("c"), i.cast("string")).alias("file_id"), F.concat(F.lit("c"), i.cast("string"), F.lit(":"), F.floor(F.col("turn") / 4).cast("string")).alias("chunk_id"), speaker.alias("speaker"), F.col("text").alias("quote"), F.col("turn").cast("int").alias("page_start"), F.col("turn").cast("int").alias("page_end"), i.alias("conv_id"), F.lit(0.5).alias("confidence"), F.xxhash64("conv_id", "turn").alias("conversation_id"))


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments with participants, topics, case and day; the chunk id serves as segment id."""
    u = utterances(spark, sf)
    s = threads.segments(u).join(threads.segment_tokens(u), ["file_id", "chunk_id"], "left")
    none = F.array().cast("array<string>")
    n = F.substring("file_id", 2, 20).cast("long")
    return s.select(
        F.col("chunk_id").alias("segment_id"), "file_id", "chunk_id", "utterance_count", F.concat(F.lit("K"), (n % 10).cast("string")).alias("case_id_norm"),
        F.transform("speakers", lambda x: F.concat(F.lit("s:"), x)).alias("participant_keys"), F.coalesce("top_tokens", none).alias("top_tokens"), F.concat(F.lit("2024-01-"), _two(n % 28 + 1)).alias("anchor_date"),
    )


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """All evidence rows of the graph."""
    from caseloom.operators import graph

    e, (who, s) = events(spark, sf), found_once(spark, sf)
    o, m = resolved(written(observed(who, s)))
    ic = graph.event_in_case(e, timeline.event_cases(e, s))
    return ic.unionByName(graph.mentioned_in_event(m, o, e)).unionByName(graph.person_in_case(m, o, s, normal_name(F.col("person_text"))))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """graph.edges() of evidence(): an event's id is one event's, so its case and its chunk are in one row."""
    from caseloom.operators import graph

    e, (who, s) = events(spark, sf), found_once(spark, sf)
    o, m = resolved(written(observed(who, s)))
    return graph.linked_edges(e, timeline.event_cases(e, s, "file_id", "chunk_id"), m, o, s, normal_name(F.col("person_text")))


def store(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"events": events(spark, sf), "event_cases": event_cases(spark, sf), "event_times": event_times(spark, sf), "entities": entities(spark, sf), "identity_signals": signals(spark, sf), "conversations": utterances(spark, sf)}
