"""Utterances to segments, segments of a case to threads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import normal_name
from caseloom.operators.components import components

#: Tokens kept of an utterance, top tokens of a segment; segments that share a key, and candidates of a segment, at most.
TOKENS, TOP, FANOUT, CANDIDATES = 200, 20, 200, 500
#: Words that say nothing about a topic.
STOPWORDS = (
    "a an and are as at be but by can could did do does for from had has have he her here him his i if in into is it its just like me my no not of on or our out "
    "she so that the their them then there these they this to up us was we were what when where who will with would you your"
).split()


def topic_tokens(c: Column) -> Column:
    words = F.filter(F.split(normal_name(c), " "), lambda t: ~t.isin(*STOPWORDS) & ~t.rlike("^[0-9]+$") & (F.length(t) >= 3))
    return F.slice(F.coalesce(words, F.array().cast("array<string>")), 1, TOKENS)


def segments(utterances: DataFrame) -> DataFrame:
    """file_id, chunk_id, page_start, page_end, utterance_count, speakers (sorted)."""
    u = utterances.withColumn("speaker_norm", normal_name(F.col("speaker")))
    return u.groupBy("file_id", "chunk_id").agg(F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.count("*").alias("utterance_count"), F.array_sort(F.collect_set("speaker_norm")).alias("speakers"))


def segment_tokens(utterances: DataFrame, top: int = TOP) -> DataFrame:
    """file_id, chunk_id, top_tokens (by count, then alphabet), topic_signature."""
    t = utterances.select("file_id", "chunk_id", F.explode(topic_tokens(F.col("quote"))).alias("token")).groupBy("file_id", "chunk_id", "token").agg(F.count("*").alias("n"))
    w = Window.partitionBy("file_id", "chunk_id").orderBy(F.desc("n"), "token")
    ranked = t.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top)
    listed = ranked.groupBy("file_id", "chunk_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "token"))), lambda x: x["token"]).alias("top_tokens"))
    return listed.withColumn("topic_signature", F.substring(F.sha2(F.array_join("top_tokens", " "), 256), 1, 16))


def segment_cases(segs: DataFrame, signals: DataFrame, events: DataFrame, event_cases: DataFrame) -> DataFrame:
    """segs with case_id_norm and case_source: the least signalled case of the chunk, else of its events, else the file."""
    key = ["file_id", "chunk_id"]
    a = signals.where("attribute = 'case_id' AND value_norm IS NOT NULL").groupBy(*key).agg(F.min("value_norm").alias("__a"))
    b = event_cases.join(events.select("event_id", *key), "event_id").groupBy(*key).agg(F.min("case_id_norm").alias("__b"))
    df = segs.join(a, key, "left").join(b, key, "left")
    source = F.when(F.col("__a").isNotNull(), "identity_signals").when(F.col("__b").isNotNull(), "event_cases").otherwise("fallback_file")
    return df.withColumn("case_id_norm", F.coalesce("__a", "__b", F.concat(F.lit("file:"), "file_id"))).withColumn("case_source", source).drop("__a", "__b")


def participants(segs: DataFrame, people: DataFrame) -> DataFrame:
    """segs with participant_keys: p:<person_id> where a speaker has a person's display name, else s:<name>."""
    ids = people.groupBy(F.lower(F.trim("display_name_norm")).alias("speaker")).agg(F.min("person_id").alias("person_id"))
    key = ["file_id", "chunk_id"]
    named = segs.select(*key, F.explode("speakers").alias("speaker")).join(ids, "speaker", "left")
    keys = named.groupBy(*key).agg(F.array_sort(F.collect_set(F.coalesce(F.concat(F.lit("p:"), F.col("person_id").cast("string")), F.concat(F.lit("s:"), "speaker")))).alias("participant_keys"))
    return segs.join(keys, key, "left").withColumn("participant_keys", F.coalesce("participant_keys", F.array().cast("array<string>")))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def thread_pairs(segs: DataFrame, fanout: int = FANOUT, most: int = CANDIDATES) -> DataFrame:
    """left, right, participant_j, topic_j, score, decision, reasons of segments in one case.

    Needs segment_id, case_id_norm, participant_keys, top_tokens, anchor_date. An inverted index: keys that over `fanout`
    segments have are left out before the join, and each segment tries its `most` candidates that share most keys.
    """
    keys = F.concat(F.transform("participant_keys", lambda k: F.concat(F.lit("k:"), k)), F.transform("top_tokens", lambda t: F.concat(F.lit("t:"), t)))
    index = segs.select("segment_id", "case_id_norm", F.explode(F.array_distinct(keys)).alias("key"))
    fit = index.groupBy("case_id_norm", "key").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= fanout)).drop("n")
    index = index.join(fit, ["case_id_norm", "key"], "left_semi")
    shared = index.alias("l").join(index.alias("r"), ["case_id_norm", "key"]).where("l.segment_id <> r.segment_id")
    shared = shared.groupBy(F.col("l.segment_id").alias("me"), F.col("r.segment_id").alias("other")).agg(F.count("*").alias("n"))
    best = Window.partitionBy("me").orderBy(F.desc("n"), F.least("me", "other"), F.greatest("me", "other"))
    tried = shared.withColumn("r", F.row_number().over(best)).where(F.col("r") <= most).select(F.least("me", "other").alias("left"), F.greatest("me", "other").alias("right")).distinct()
    side = lambda p: segs.select(F.col("segment_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("participant_keys", "top_tokens", "anchor_date")])
    df = tried.join(side("left"), "left").join(side("right"), "right")
    df = df.withColumn("participant_j", jaccard(F.col("left_participant_keys"), F.col("right_participant_keys"))).withColumn("topic_j", jaccard(F.col("left_top_tokens"), F.col("right_top_tokens")))
    days = F.abs(F.datediff(F.col("left_anchor_date").try_cast("date"), F.col("right_anchor_date").try_cast("date")))
    bonus = F.when(days <= 7, 0.1).when(days <= 30, 0.05).otherwise(0.0)
    df = df.withColumn("score", F.lit(0.7) * F.col("participant_j") + F.lit(0.3) * F.col("topic_j") + bonus)
    decision = F.when((F.col("participant_j") > 0) & (F.col("score") >= 0.45), "link").when((F.col("participant_j") == 0) & (F.col("topic_j") >= 0.6) & (F.col("score") >= 0.3), "needs_review")
    reasons = F.array_compact(F.array(F.when(F.col("participant_j") > 0, "participant_overlap"), F.when(days <= 7, "time_within_7d").when(days <= 30, "time_within_30d"), F.when(F.col("topic_j") > 0, "topic_overlap")))
    return df.withColumn("decision", decision).where(F.col("decision").isNotNull()).select("left", "right", "participant_j", "topic_j", F.round("score", 6).alias("score"), "decision", F.array_sort(reasons).alias("reasons"))


def threads(segs: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segment_id, root, sort_key) and (root, case_id_norm, thread_key, n_segments, label) of each thread."""
    links = pairs.where("decision = 'link'").select(F.col("left").alias("a"), F.col("right").alias("b"))
    members = segs.join(components(segs.select(F.col("segment_id").alias("node")), links).withColumnRenamed("node", "segment_id"), "segment_id")
    sort_key = F.concat_ws("|", F.coalesce("anchor_date", F.lit("9999-12-31")), "file_id", "chunk_id")
    head = members.groupBy("root", "case_id_norm").agg(F.count("*").alias("n_segments"))
    head = head.join(thread_keys(members), ["root", "case_id_norm"])
    return members.select("segment_id", "root", sort_key.alias("sort_key")), head.select("root", "case_id_norm", "thread_key", "n_segments").join(labels(members), "root", "left")


#: Names of a thread that are hashed together, about.
NAMES = 4096


def thread_keys(members: DataFrame, most: int = NAMES) -> DataFrame:
    """root, case_id_norm, thread_key: a hash of the case and the sorted names of the thread's segments.

    Of a thread of more than `most` segments it is the hash of such hashes, of its names in buckets by their own hash, so no row holds all names.
    """
    named = members.select("root", "case_id_norm", F.concat("file_id", F.lit(":"), "chunk_id").alias("name"))
    sizes = named.groupBy("root", "case_id_norm").agg(F.ceil(F.count("*") / most).alias("buckets"))
    dealt = named.join(sizes, ["root", "case_id_norm"]).withColumn("bucket", F.pmod(F.xxhash64("name"), F.col("buckets")))
    listed = dealt.groupBy("root", "case_id_norm", "buckets", "bucket").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("names"))
    part = F.when(F.col("buckets") == 1, F.col("names")).otherwise(F.sha2("names", 256))
    whole = listed.groupBy("root", "case_id_norm").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", part.alias("x")))), lambda s: s["x"]), ",").alias("names"))
    return whole.select("root", "case_id_norm", F.sha2(F.concat("case_id_norm", F.lit("|"), "names"), 256).alias("thread_key"))


def participant_rows(members: DataFrame, segs: DataFrame) -> DataFrame:
    """thread_id, segment_id, participant_key: a row for each key of a member."""
    return members.join(segs.select("segment_id", "participant_keys"), "segment_id").select(F.col("root").alias("thread_id"), "segment_id", F.explode("participant_keys").alias("participant_key"))


def labels(members: DataFrame) -> DataFrame:
    """root, label: the three tokens that most segments have, else the most frequent participant, else null."""

    def top(column: str, n: int, name: str) -> DataFrame:
        counts = members.select("root", F.explode(column).alias("x")).groupBy("root", "x").agg(F.count("*").alias("n"))
        ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("n"), "x"))).where(F.col("r") <= n)
        return ranked.groupBy("root").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda s: s["x"]), " ").alias(name))

    both = top("top_tokens", 3, "t").join(top("participant_keys", 1, "p"), "root", "full")
    return both.select("root", F.coalesce("t", "p").alias("label"))


#: What a label is made from, and how long it may be.
SHOWN, LABEL = {"participants": 10, "keywords": 15}, 120


def model_labels(heads: DataFrame, members: DataFrame, ask: Callable[[str], str], top: int = 15) -> DataFrame:
    """heads with `label` by a model where it gives one: of the thread's first participants and keywords, no quotes. Otherwise the label stays.

    ask: the answer to a prompt; whatever it raises leaves that label as it is.
    """

    def first(column: str, n: int) -> DataFrame:
        counts = members.select("root", F.explode(column).alias("x")).groupBy("root", "x").agg(F.count("*").alias("n"))
        ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("n"), "x"))).where(F.col("r") <= n)
        return ranked.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "x"))), lambda s: s["x"]).alias(column))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = []
            for who, words in zip(b["participant_keys"], b["top_tokens"]):
                shown = {"participants": list(who if who is not None else []), "keywords": list(words if words is not None else [])}
                try:
                    label = json.loads(ask(f'Name the topic of a conversation in at most 80 characters, without case numbers or quotes. Answer with JSON only: {{"label": string}}\n{json.dumps(shown)}'))["label"].strip()
                except Exception:  # an answer that is none
                    label = ""
                made.append(label[:LABEL].rstrip() or None)
            yield pd.DataFrame({"root": b["root"], "named": made})

    asked = heads.select("root").distinct().join(first("participant_keys", SHOWN["participants"]), "root", "left").join(first("top_tokens", min(top, SHOWN["keywords"])), "root", "left")
    named = asked.mapInPandas(run, f"root {heads.schema['root'].dataType.simpleString()}, named string")
    return heads.join(named, "root", "left").withColumn("label", F.coalesce("named", "label")).drop("named")
