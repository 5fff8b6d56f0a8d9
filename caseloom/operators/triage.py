"""Chunks to features, scores, routes, and what fits the budgets."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import text as T
from caseloom.functions.text import analysed, token_estimate
from caseloom.operators.routeml import bayes_predict
from caseloom.sources.scratch import written

#: Scores below are skipped; from the second on the large model reads the chunk.
SKIP, LARGE = 0.10, 0.75


def features(chunks: DataFrame, packs: dict[str, list[str]] | None = None, text: str = "text", most: int | None = T.ANALYSED, shaped: int | None = T.SHAPED) -> DataFrame:
    """chunks with a flat column for each feature, of the first `most` characters and, for shapes, `shaped` tokens (None: of all)."""
    # What several features share is a column of its own, so that it is computed once.
    df = chunks.withColumn("__t", analysed(F.col(text), most))
    df = df.withColumns({"__l": F.lower("__t"), "__bare": T.bare(F.col("__t")), "__tokens": T.shape_tokens(F.col("__t"), shaped), "__lines": T.lines_of(F.col("__t"))})
    df = df.withColumns({"__shapes": T.distinct_shapes(F.col("__tokens")), "__full": T.full_lines(F.col("__lines"))})
    df = df.withColumns({"__bullets": T.bullet_lines(F.col("__full")), "__table": T.table_lines(F.col("__full"))})
    cols = T.text_quality(*map(F.col, ("__t", "__bare", "__tokens", "__shapes"))) | T.structure(*map(F.col, ("__lines", "__full", "__bullets", "__table"))) | T.pattern_counts(F.col("__t"))
    hits = T.keyword_hits(F.col("__l"), packs)
    cols |= {f"kw_{k}": v for k, v in hits.items()}
    df = df.withColumns(cols)
    return df.withColumn("keyword_hit_total", sum((F.col(f"kw_{k}") for k in hits), F.lit(0))).drop(*(c for c in df.columns if c.startswith("__")))


def spacy_counts(text: str, model: str = "en_core_web_sm") -> dict[str, int]:
    """Named entities by label; needs spaCy and its model."""
    import spacy

    if model not in _LOADED:
        _LOADED[model] = spacy.load(model)
    return dict(Counter(e.label_ for e in _LOADED[model](text).ents if e.label_))


_LOADED: dict = {}


def with_entities(chunks: DataFrame, counter: Callable[[str], dict[str, int]] = spacy_counts, text: str = "text") -> DataFrame:
    """chunks with ner, named entities by label; null where they can't be counted (a missing library or model fails softly)."""

    @F.arrow_udf("map<string,int>")
    def count(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            try:
                out.append(list(counter(t or "").items()))
            except Exception:  # without the library or its model chunks are scored by the other signals
                out.append(None)
        return pa.array(out, pa.map_(pa.string(), pa.int32()))

    return chunks.withColumn("ner", count(analysed(F.col(text))))


def score(ner: bool = False) -> Column:
    """Weights added up in one order (sums of doubles depend on it), 0 to 1; with ner, named entities count as well."""
    named = [(F.coalesce(F.try_element_at("ner", F.lit(k)), F.lit(0)) > 0, w) for k, w in (("PERSON", 0.10), ("ORG", 0.05), ("GPE", 0.05), ("DATE", 0.08))] if ner else []
    on = lambda cond, w: F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
    some = lambda name: F.col(name) > 0
    total = F.least(F.lit(0.4), F.lit(0.05) * F.col("keyword_hit_total"))
    for cond, w in (
        (some("badge_id_count"), 0.10), (some("capitalized_name_count"), 0.08), (some("honorific_count"), 0.05), (some("org_suffix_count"), 0.05),
        (some("date_like_count"), 0.15), (some("time_like_count"), 0.05), (some("on_at_by_date_count"), 0.10), (some("incident_verb_count"), 0.10),
        (some("dialogue_marker_count"), 0.08), (F.col("table_like"), 0.03), (F.col("bullet_density") >= 0.2, 0.03),
        *named,
        (F.col("char_len") < 40, -0.20), (F.col("non_ws_ratio") < 0.05, -0.20), (F.col("punctuation_ratio") > 0.40, -0.10), (F.col("max_repeated_char_run") >= 10, -0.10),
    ):
        total = total + on(cond, w)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))


def low_quality() -> Column:
    return ((F.col("char_len") > 0) & (F.col("char_len") < 40)) | (F.col("non_ws_ratio") < 0.05) | (F.col("punctuation_ratio") > 0.40) | (F.col("max_repeated_char_run") >= 10)


def complex_narrative() -> Column:
    signals = F.col("dialogue_marker_count") + F.col("capitalized_name_count") + F.col("date_like_count") + F.col("incident_verb_count") + F.col("time_like_count")
    return (F.col("char_len") >= 800) & (F.col("nonempty_line_count") >= 8) & ~F.col("table_like") & (F.col("bullet_density") < 0.25) & (signals >= 4)


def triaged(chunks: DataFrame, packs: dict[str, list[str]] | None = None, skip: float = SKIP, large: float = LARGE, most: int | None = T.ANALYSED, shaped: int | None = T.SHAPED) -> DataFrame:
    """Features, score, token_est, low_quality, complex_narrative and the heuristic route of each chunk; `ner` counts if there."""
    df = features(chunks, packs, most=most, shaped=shaped).withColumn("token_est", token_estimate(F.col("text"))).withColumn("score", score("ner" in chunks.columns))
    df = df.withColumns({"low_quality": low_quality(), "complex_narrative": complex_narrative()})
    route = F.when(F.col("score") < skip, "skip").when((F.col("score") >= large) | F.col("complex_narrative"), "llm_large").otherwise("llm_small")
    return df.withColumn("route", route)


def model_route(p_skip: Column, p_large: Column, heuristic: Column, mode: str, skip: float = 0.9, large: float = 0.8, score_large: float = LARGE) -> Column:
    """Struct predicted_route, gate, mode_gate, effective_route under a mode: report-only, shadow (only adds to what is skipped) or full."""
    gate = (
        F.when(p_skip >= skip, "p_skip_high").when(p_large >= large, "p_large_high").when(F.col("complex_narrative"), "complex_narrative")
        .when(F.col("low_quality") & (F.col("score") >= score_large), "low_quality_high_heuristic_score").otherwise("default_llm_small")
    )
    predicted = F.when(gate == "p_skip_high", "skip").when(gate == "default_llm_small", "llm_small").otherwise("llm_large")
    effective = {"report-only": heuristic, "shadow": F.when((heuristic == "skip") & (predicted != "skip"), predicted).otherwise(heuristic)}.get(mode, predicted)
    added = F.when((heuristic == "skip") & (predicted != "skip"), "shadow_add_from_skip").otherwise("shadow_keep_heuristic")
    mode_gate = {"report-only": F.lit("report_only_keep_heuristic"), "shadow": added}.get(mode, F.lit("full_policy_route"))
    return F.struct(predicted.alias("predicted_route"), gate.alias("gate"), mode_gate.alias("mode_gate"), effective.alias("effective_route"))


def with_model(scored: DataFrame, state: str, tables: dict[str, DataFrame], mode: str, skip: float = 0.9, large: float = 0.8, score_large: float = LARGE) -> DataFrame:
    """scored (with text) with the model's routes: heuristic_route, predicted_route, gates, and the route that the mode makes of both.

    Without a loaded model routes stay, predictions are null and the gates say why.
    """
    df = scored.withColumn("heuristic_route", F.col("route"))
    if state != "loaded":
        return df.withColumns({"predicted_route": F.lit(None).cast("string"), "gates": F.array(F.lit("fallback_heuristic"), F.lit(state))})
    got = bayes_predict(df.select(F.col("chunk_id").alias("row_id"), "text"), tables["vocabulary"], tables["prior"], tables["tokens"]).select(F.col("row_id").alias("chunk_id"), F.col("p_skip").alias("__s"), F.col("p_llm_large").alias("__l"))
    policy = model_route(F.col("__s"), F.col("__l"), F.col("heuristic_route"), mode, skip, large, score_large)
    out = df.join(got, "chunk_id", "left").withColumn("__p", policy)
    return out.withColumns({"predicted_route": F.col("__p.predicted_route"), "gates": F.array("__p.gate", "__p.mode_gate"), "route": F.col("__p.effective_route")}).drop("__s", "__l", "__p")


def count_caps(scored: DataFrame, per_file: int | None, overall: int | None) -> DataFrame:
    """The best by (score desc, chunk_id): at most per_file of a file and overall in all.

    The per-file rank is a window by file; the overall cap a top-k with a heap in each task, not a sort of all.
    """
    df = scored
    if per_file is not None:
        w = Window.partitionBy("file_id").orderBy(F.desc("score"), "chunk_id")
        df = df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_file).drop("__r")
    return df if overall is None else df.orderBy(F.desc("score"), "chunk_id").limit(overall)


def token_budget(scored: DataFrame, budget: int, per_file: int | None = None) -> DataFrame:
    """Greedy by (score desc, chunk_id): a chunk that no longer fits is passed over, later ones may fit; at most per_file of a file.

    (chunk_id, file_id, tokens) are range-sorted once into a written table. As long as whole parts fit they are taken by their sums alone; only the part
    where the budget bites is walked, by one task that holds one number and its own files' counts, and after it what fits
    is summed again. A part is walked once at most, and all ends when what is left is under the smallest chunk. The driver sees one row for each part.
    """
    order = [F.desc("score"), F.col("chunk_id")]
    keep = scored.select("chunk_id", "file_id", F.col("token_est").cast("long").alias("token_est"), "score").where(F.col("token_est") <= budget)
    rows = written(keep.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    left, at, taken = budget, 0, []

    def counted(live: DataFrame) -> DataFrame:
        """live with `had`, the chunks that its file was given so far."""
        if per_file is None or not taken:
            return live.withColumn("had", F.lit(0).cast("long"))
        return live.join(reduce(DataFrame.unionByName, taken).groupBy("file_id").agg(F.count("*").alias("had")), "file_id", "left").withColumn("had", F.coalesce("had", F.lit(0).cast("long")))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, given = left, {}
        for batch in batches:
            picked = []
            for i, (f, n, had) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("file_id", "token_est", "had")))):
                if n <= room and (per_file is None or given.get(f, had) < per_file):
                    room -= n
                    if per_file is not None:
                        given[f] = given.get(f, had) + 1
                    picked.append(i)
            yield batch.select(["chunk_id", "file_id", "token_est"]).take(pa.array(picked, pa.int64()))

    while True:
        live = counted(rows.where((F.col("part") >= at) & (F.col("token_est") <= left)))
        fit = live
        if per_file is not None:
            fit = live.withColumn("r", F.row_number().over(Window.partitionBy("file_id").orderBy(*order)) + F.col("had")).where(F.col("r") <= per_file)
        sums = fit.groupBy("part").agg(F.sum("token_est").alias("n")).orderBy("part").collect()
        whole, bite = 0, None
        for r in sums:
            if whole + r.n > left:
                bite = r.part
                break
            whole += r.n
        if bite is None:
            taken.append(fit.select("chunk_id", "file_id", "token_est"))
            break
        if whole:
            taken.append(written(fit.where(F.col("part") < bite).select("chunk_id", "file_id", "token_est")))
        left -= whole
        one = counted(rows.where((F.col("part") == bite) & (F.col("token_est") <= left))).coalesce(1).sortWithinPartitions(*order)
        taken.append(written(one.select("chunk_id", "file_id", "token_est", "had").mapInArrow(walk, "chunk_id string, file_id string, token_est long")))
        left -= taken[-1].agg(F.coalesce(F.sum("token_est"), F.lit(0))).first()[0]
        at = bite + 1
    return scored.join(reduce(DataFrame.unionByName, taken).select("chunk_id").distinct(), "chunk_id", "left_semi")


def allowed_files(df: DataFrame, allow: DataFrame | None, deny: DataFrame | None) -> DataFrame:
    """Only files of a non-empty allow list; none of the deny list."""
    if allow is not None and allow.limit(1).count():
        df = df.join(allow.select("file_id").distinct(), "file_id", "left_semi")
    return df if deny is None else df.join(deny.select("file_id").distinct(), "file_id", "left_anti")


def by_route(df: DataFrame, routes: list[str], triage: DataFrame | None) -> DataFrame:
    """Chunks with an allowed route; without triage all pass, without an entry in it none."""
    return df if triage is None else df.join(triage.where(F.col("route").isin(routes)).select("chunk_id"), "chunk_id", "left_semi")


LLM_ROUTES = ("llm_small", "llm_large")


def routes_of(triage: DataFrame) -> DataFrame:
    """triage with `route` and `predicted_route` as reports name them: a missing route is unknown, a missing prediction is the route."""
    route = F.coalesce(F.nullif("route", F.lit("")), F.lit("unknown"))
    predicted = F.coalesce(F.nullif("predicted_route", F.lit("")), route) if "predicted_route" in triage.columns else route
    return triage.withColumns({"route": route, "predicted_route": predicted})


def route_breakdown(triage: DataFrame, order: list[str] | None = None, total: int | None = None) -> DataFrame:
    """kind (route, predicted_route), route, count, pct_of_chunks, tokens_est.

    Counts are of all records. Tokens are of chunks: of a chunk's records the last by `order` names its route and its tokens. The
    percentage is of `total` chunks, or of the chunk ids there are.
    """
    t = routes_of(triage).select("route", "predicted_route", "chunk_id", F.coalesce("token_est", F.lit(0)).cast("long").alias("token_est"), *(order or []))
    last = t.where(F.col("chunk_id") != "").groupBy("chunk_id").agg(F.max_by(F.struct("route", "predicted_route", "token_est"), F.struct(*(order or ["token_est"]))).alias("x")).select("x.*")
    both = lambda df, *rest: df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("route")) for k in ("route", "predicted_route")])).alias("k"), *rest).select("k.*", *rest)
    seen = both(t).groupBy("kind", "route").agg(F.count("*").alias("count"))
    tokens = both(last, "token_est").groupBy("kind", "route").agg(F.sum("token_est").alias("tokens_est"), F.count("*").alias("__n"))
    out = seen.join(tokens, ["kind", "route"], "left").withColumn("tokens_est", F.coalesce("tokens_est", F.lit(0)))
    # Routes are a handful, so a window over the report's rows is small.
    chunks = F.lit(total) if total is not None else F.sum("__n").over(Window.partitionBy("kind"))
    pct = F.when(chunks > 0, F.round(F.col("count") / chunks * 100, 3)).otherwise(0.0)
    return out.withColumn("pct_of_chunks", pct).select("kind", "route", "count", "pct_of_chunks", "tokens_est")
