"""Pages to overlapping chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.text import DATE, PATTERNS

#: Characters of a page looked at for dialogue, of a chunk for dates and names, unless said otherwise (None: all).
PAGE_SEEN, CHUNK_SEEN = 4_000, 8_000
NAME = r"\b[A-Z][a-z]+\s+[A-Z][a-z]+\b"


def page_score(length: Column, confidence: Column, review: Column, flags: Column) -> Column:
    """Mean of length (50 characters are full) and confidence (1 if unknown), less for low text, review, errors; 0 to 1, six digits.

    A page without text scores 0.
    """
    one = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    base = (one(length / 50.0) + one(F.coalesce(confidence, F.lit(1.0)))) / 2
    base = F.when(F.array_contains(flags, "low_text"), base * 0.6).otherwise(base)
    base = F.when(review, base * 0.7).otherwise(base)
    base = F.when(F.arrays_overlap(flags, F.array(F.lit("ocr_error"), F.lit("missing_source"))), F.least(base, F.lit(0.2))).otherwise(base)
    return F.round(F.when(F.array_contains(flags, "empty_text"), 0.0).otherwise(one(base)), 6)


def _signals(pages: Column, text: Column, most: int | None) -> Column:
    confidence = F.filter(F.transform(pages, lambda p: p["confidence"]), lambda c: c.isNotNull())
    mean = F.aggregate(confidence, F.lit(0.0), lambda a, c: a + c) / F.size(confidence)
    low = F.exists(pages, lambda p: p["review_required"]) | (F.length(F.trim(F.regexp_replace(text, r"^\s+|\s+$", ""))) < 40) | ((F.size(confidence) > 0) & (mean < 0.5))
    seen = text if most is None else F.substring(text, 1, most)
    return F.struct(F.exists(pages, lambda p: p["dialogue"]).alias("likely_dialogue"), seen.rlike(DATE).alias("has_dates"), seen.rlike(NAME).alias("has_names"), low.alias("low_quality"))


def pages_ready(pages: DataFrame, most: int | None = PAGE_SEEN) -> DataFrame:
    """file_id, page_index, text, review_required, confidence, dialogue; defaults for what is missing."""
    has = set(pages.columns)
    text = F.coalesce("text", F.lit(""))
    return pages.select(
        "file_id", "page_index", text.alias("text"),
        (F.coalesce("review_required", F.lit(False)) if "review_required" in has else F.lit(False)).alias("review_required"),
        (F.col("confidence").cast("double") if "confidence" in has else F.lit(None).cast("double")).alias("confidence"),
        (text if most is None else F.substring(text, 1, most)).rlike(PATTERNS["dialogue_marker_count"]).alias("dialogue"),
    )


def chunks(pages: DataFrame, size: int = 2, overlap: int = 1, page_seen: int | None = PAGE_SEEN, chunk_seen: int | None = CHUNK_SEEN) -> DataFrame:
    """chunk_id, file_id, page_start, page_end, text, signals.

    A page with dialogue, or before one, stands alone. For pairs with overlap one that is a look at the next page, so a
    window does; other sizes walk over a file's page array in one fold.
    """
    p = pages_ready(pages, page_seen)
    # A stated number of parts: text is costly to read for its bytes, so adaptive execution mustn't make few tasks of them.
    p = p.repartition(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file_id")
    if (size, overlap) == (2, 1):
        w = Window.partitionBy("file_id").orderBy("page_index")
        page = F.struct("page_index", "text", "review_required", "confidence", "dialogue")
        nxt = F.lead(page).over(w)
        p = p.select("file_id", page.alias("p"), nxt.alias("n"))
        alone = F.col("n").isNull() | F.col("p.dialogue") | F.col("n.dialogue")
        runs = p.select("file_id", F.when(alone, F.array("p")).otherwise(F.array("p", "n")).alias("pages"))
    else:
        step = max(1, size - overlap)
        page = F.struct("page_index", "text", "review_required", "confidence", "dialogue")
        files = p.groupBy("file_id").agg(F.array_sort(F.collect_list(page)).alias("all"))
        n = F.size("all")
        said = lambda i: F.coalesce(F.get("all", i)["dialogue"], F.lit(False))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

        def walk(acc: Column, i: Column) -> Column:
            far = F.least(i + (size - 1), n - 1)
            end = F.when(said(i) | said(i + 1) | said(far) & (far > i), i).otherwise(far)
            made = F.struct((i + F.when(end == i, 1).otherwise(step)).cast("int").alias("at"), F.concat(acc["out"], F.array(F.struct(i.cast("int").alias("s"), end.cast("int").alias("e")))).alias("out"))
            return F.when(i == acc["at"], made).otherwise(acc)

        folded = F.aggregate(F.sequence(F.lit(0), n - 1), start, walk, lambda acc: acc["out"])
        runs = files.withColumn("run", F.explode(folded)).select("file_id", F.slice("all", F.col("run.s") + 1, F.col("run.e") - F.col("run.s") + 1).alias("pages"))
    text = F.array_join(F.filter(F.transform("pages", lambda x: x["text"]), lambda t: t != ""), "\n\n")
    first, last = F.get("pages", 0)["page_index"], F.element_at("pages", -1)["page_index"]
    out = runs.select("file_id", first.alias("page_start"), last.alias("page_end"), text.alias("text"), "pages")
    return out.select(F.concat("file_id", F.lit(":"), "page_start", F.lit("-"), "page_end").alias("chunk_id"), "file_id", "page_start", "page_end", "text", _signals(F.col("pages"), F.col("text"), chunk_seen).alias("signals"))
