"""Route labels, a naive Bayes route model, its evaluation, and what to label next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import redacted_preview
from caseloom.sources.jsonl import exists

ROUTES = ("skip", "llm_small", "llm_large")
EXTRACTORS = ("entities", "events", "conversations", "identity_signals")


def tokens(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("([A-Za-z0-9_]+)"), 1), F.lower)


def outcomes(records: DataFrame, order: str) -> DataFrame:
    """Per chunk and extractor the last record's items, and whether it failed, as one row a chunk."""
    last = records.groupBy("chunk_id", "extractor").agg(F.max_by(F.struct("n_items", "error"), order).alias("x"))
    return last.groupBy("chunk_id").pivot("extractor", list(EXTRACTORS)).agg(F.first(F.when(F.col("x.error").isNull(), F.col("x.n_items")).otherwise(0)))


def route_dataset(chunks: DataFrame, triage: DataFrame, small: DataFrame, large: DataFrame, human: DataFrame | None = None, useful: DataFrame | None = None) -> DataFrame:
    """Chunks with triage, outcomes and a label: by a human, by what the large model alone found, by use downstream, by yield."""
    s = small.select("chunk_id", *[F.coalesce(e, F.lit(0)).alias(f"s_{e}") for e in EXTRACTORS])
    lg = large.select("chunk_id", *[F.coalesce(e, F.lit(0)).alias(f"l_{e}") for e in EXTRACTORS])
    df = chunks.select("chunk_id", "file_id", "text", F.sha2("text", 256).alias("chunk_text_hash")).join(triage.select("chunk_id", "score", "route", "token_est", "low_quality"), "chunk_id", "left").join(s, "chunk_id", "left").join(lg, "chunk_id", "left")
    total = lambda p: sum((F.coalesce(f"{p}_{e}", F.lit(0)) for e in EXTRACTORS), F.lit(0))
    df = df.withColumns({"any_yield": total("s") > 0, "any_large_yield": total("l") > 0})
    df = df.join(useful.select("chunk_id", "utility"), "chunk_id", "left") if useful is not None else df.withColumn("utility", F.lit(None).cast("long"))
    useful_here = F.coalesce("utility", F.lit(0)) > 0
    label = F.when(F.col("any_large_yield") & ~F.col("any_yield"), "llm_large").when(F.col("any_yield") | useful_here, "llm_small").otherwise("skip")
    source = F.when(F.col("any_large_yield") & ~F.col("any_yield"), "empirical_large_yield").when(F.col("any_yield"), "heuristic_from_yield").when(useful_here, "downstream_utility").otherwise("heuristic_from_yield")
    df = df.withColumns({"label_route": label, "label_source": source})
    if human is not None:
        h = human.groupBy("chunk_id", "chunk_text_hash").agg(F.max("label_route").alias("__h"))
        df = df.join(h, ["chunk_id", "chunk_text_hash"], "left")
        df = df.withColumns({"label_source": F.when(F.col("__h").isNotNull(), "human").otherwise(F.col("label_source")), "label_route": F.coalesce("__h", "label_route")}).drop("__h")
    return df


def utility(events: DataFrame, event_times: DataFrame, obs: DataFrame, members: DataFrame) -> DataFrame:
    """chunk_id, utility: dated events plus resolved people of a chunk."""
    e = events.join(event_times.where("status = 'ok'").select("event_id"), "event_id", "left_semi").groupBy("chunk_id").agg(F.count("*").alias("a"))
    p = obs.join(members.select("obs_id"), "obs_id", "left_semi").groupBy("chunk_id").agg(F.countDistinct("obs_id").alias("b"))
    return e.join(p, "chunk_id", "full").select("chunk_id", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("utility"))


def vocabulary(rows: DataFrame, most: int = 5000, min_df: int = 2) -> DataFrame:
    """token, tf, df: the most frequent tokens that enough rows have."""
    t = rows.select("row_id", F.explode(tokens(F.col("text"))).alias("token")).groupBy("row_id", "token").agg(F.count("*").alias("n"))
    v = t.groupBy("token").agg(F.sum("n").alias("tf"), F.count("*").alias("df")).where(F.col("df") >= min_df)
    return v.orderBy(F.desc("tf"), "token").limit(most)


def bayes(rows: DataFrame, vocab: DataFrame, label: str = "label", classes: tuple[str, ...] = ROUTES, alpha: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Multinomial naive Bayes: (label, log_prior, log_unknown) and (label, token, log_prob)."""
    spark = rows.sparkSession
    names = spark.range(1).select(F.explode(F.array(*map(F.lit, classes))).alias("label"))
    docs = rows.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    hits = rows.select(F.col(label).alias("label"), F.explode(tokens(F.col("text"))).alias("token")).groupBy("label", "token").agg(F.count("*").alias("n")).join(vocab.select("token"), "token", "left_semi")
    sizes = hits.groupBy("label").agg(F.sum("n").alias("total"))
    base = vocab.agg(F.greatest(F.lit(1), F.count("*")).alias("v")).withColumn("__k", F.lit(1))
    all_docs = docs.agg(F.greatest(F.lit(1), F.coalesce(F.sum("n"), F.lit(0))).alias("d")).withColumn("__k", F.lit(1))
    head = names.join(docs, "label", "left").join(sizes, "label", "left").withColumn("__k", F.lit(1)).join(base, "__k").join(all_docs, "__k")
    denom = F.coalesce("total", F.lit(0)) + alpha * F.col("v")
    prior = head.select("label", F.log((F.coalesce("n", F.lit(0)) + alpha) / (F.col("d") + alpha * len(classes))).alias("log_prior"), F.log(F.lit(alpha) / denom).alias("log_unknown"), denom.alias("denom"))
    seen = hits.join(prior, "label").select("label", "token", F.log((F.col("n") + alpha) / F.col("denom")).alias("log_prob"))
    return prior.select("label", "log_prior", "log_unknown"), seen


def bayes_predict(rows: DataFrame, vocab: DataFrame, prior: DataFrame, seen: DataFrame, classes: tuple[str, ...] = ROUTES) -> DataFrame:
    """row_id, p_<class> of each class, predicted (ties go to the first class). Tokens that a class hasn't seen weigh its log_unknown."""
    t = rows.select("row_id", F.explode(tokens(F.col("text"))).alias("token")).groupBy("row_id", "token").agg(F.count("*").alias("n"))
    wide = seen.groupBy("token").pivot("label", list(classes)).agg(F.first("log_prob"))
    p = {r.label: r for r in prior.collect()}  # one row a class
    parts = t.join(wide, "token", "left")
    sums = parts.groupBy("row_id").agg(*[F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(p[c].log_unknown))).alias(c) for c in classes])
    score = {c: F.coalesce(F.col(c), F.lit(0.0)) + p[c].log_prior for c in classes}
    df = rows.select("row_id").join(sums, "row_id", "left").withColumns({f"s_{c}": v for c, v in score.items()})
    top = F.greatest(*[F.col(f"s_{c}") for c in classes])
    exp = [F.exp(F.col(f"s_{c}") - top) for c in classes]
    total = sum(exp[1:], exp[0])
    predicted = F.lit(None).cast("string")
    for c in reversed(classes):
        predicted = F.when(F.col(f"s_{c}") == top, F.lit(c)).otherwise(predicted)
    return df.select("row_id", *[(e / total).alias(f"p_{c}") for c, e in zip(classes, exp)], predicted.alias("predicted"))


def confusion(rows: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """label, support, precision, recall, f1 of a confusion matrix."""
    tp = matrix.where("actual = predicted").select(F.col("actual").alias("label"), F.col("n").alias("tp"))
    a = matrix.groupBy(F.col("actual").alias("label")).agg(F.sum("n").alias("support"))
    p = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("claimed"))
    df = a.join(p, "label", "full").join(tp, "label", "left").select("label", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("support", "claimed", "tp")])
    div = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    df = df.withColumns({"precision": div(F.col("tp"), F.col("claimed")), "recall": div(F.col("tp"), F.col("support"))})
    return df.select("label", "support", "precision", "recall", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"))


def evaluated(rows: DataFrame, classes: tuple[str, ...] = ROUTES, sent: tuple[str, ...] = ("llm_small", "llm_large")) -> DataFrame:
    """One row: accuracy, macro_f1, of sending to a model the recall of predictions and of the heuristic route, and the work that predictions make.

    rows: actual, predicted, triage_route, token_est.
    """
    goes = lambda c: F.col(c).isin(*sent)
    div = lambda x, y: F.when(y > 0, x / y).otherwise(F.lit(0.0))
    one = rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("actual") == F.col("predicted")).alias("hits"), F.count_if(goes("actual")).alias("llm_send_support"),
        F.count_if(goes("actual") & goes("predicted")).alias("__model"), F.count_if(goes("actual") & goes("triage_route")).alias("__heuristic"),
        F.count_if(goes("predicted")).alias("predicted_llm_chunks"), F.coalesce(F.sum(F.when(goes("predicted"), F.col("token_est"))), F.lit(0)).cast("long").alias("predicted_llm_tokens_est"),
        *[F.count_if(F.col("predicted") == c).alias(f"predicted_{c}") for c in classes],
        *[F.count_if(cond).alias(f"__{k}_{c}") for c in classes for k, cond in (("tp", (F.col("actual") == c) & (F.col("predicted") == c)), ("a", F.col("actual") == c), ("p", F.col("predicted") == c))],
    )
    f1 = [div(2 * F.col(f"__tp_{c}"), F.col(f"__a_{c}") + F.col(f"__p_{c}")) for c in classes]
    return one.select(
        div(F.col("hits"), F.col("n")).alias("accuracy"), (sum(f1[1:], f1[0]) / len(classes)).alias("macro_f1"), div(F.col("__model"), F.col("llm_send_support")).alias("llm_send_recall_model"),
        div(F.col("__heuristic"), F.col("llm_send_support")).alias("llm_send_recall_heuristic"), "llm_send_support", "predicted_llm_chunks", div(F.col("predicted_llm_chunks"), F.col("n")).alias("predicted_llm_ratio"),
        "predicted_llm_tokens_est", *[f"predicted_{c}" for c in classes],
    )


#: Tables of a saved model and the columns they must have.
MODEL = {"vocabulary": {"token"}, "prior": {"label", "log_prior", "log_unknown"}, "tokens": {"label", "token", "log_prob"}}


def load_model(spark: SparkSession, root: str | None, mode: str = "full", classes: tuple[str, ...] = ROUTES) -> tuple[str, dict[str, DataFrame]]:
    """(state, tables): disabled, missing_model_path, model_not_found, model_invalid (a table's columns or classes are wrong), model_load_error or loaded."""
    if mode == "off":
        return "disabled", {}
    if not root:
        return "missing_model_path", {}
    try:
        if not all(exists(spark, f"{root}/{name}/_SUCCESS") for name in MODEL):
            return "model_not_found", {}
        tables = {name: spark.read.parquet(f"{root}/{name}") for name in MODEL}
        if any(not must <= set(tables[name].columns) for name, must in MODEL.items()) or {r.label for r in tables["prior"].select("label").collect()} != set(classes):
            return "model_invalid", {}
    except Exception:  # a table that can't be read: triage goes on without a model
        return "model_load_error", {}
    return "loaded", tables


def label_bands(scored: DataFrame, low: tuple[float, float], high: tuple[float, float], n: int, seed: int = 13) -> DataFrame:
    """n chunks of each score band in the order of a seeded hash, each chunk once, with a preview without personal data."""
    pick = lambda band, name, s: scored.where(F.col("score").between(*band)).orderBy(F.xxhash64("chunk_id", F.lit(s)), "chunk_id").limit(n).withColumn("band", F.lit(name))
    both = pick(low, "low", seed).unionByName(pick(high, "high", seed + 1))
    once = both.groupBy("chunk_id").agg(F.max_by(F.struct("file_id", "score", "text", "band"), F.struct(F.col("band") == "low")).alias("x"))
    return once.select("chunk_id", "x.file_id", "x.score", "x.band", redacted_preview(F.col("x.text")).alias("preview"))


def group_split(rows: DataFrame, group: str, test: float, seed: int = 13) -> DataFrame:
    """rows with is_test: whole groups, round(n * test) of them but at least one on either side, in the order of a seeded hash."""
    groups = rows.select(group).distinct()
    n = groups.count()
    take = max(1, min(n - 1, round(n * test))) if n > 1 else 0
    chosen = groups.orderBy(F.xxhash64(group, F.lit(seed)), group).limit(take).withColumn("is_test", F.lit(True))
    return rows.join(chosen, group, "left").withColumn("is_test", F.coalesce("is_test", F.lit(False)))


