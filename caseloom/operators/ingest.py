"""Files to manifest, classes, page texts; what needs a PDF library or an OCR program is pluggable and fails softly."""

from __future__ import annotations

import shutil
import subprocess
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from io import BytesIO
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.operators.chunking import page_score

#: Pages of a file that its class is told by; characters that make a page text, and low text.
SAMPLED, TEXT_CHARS, LOW_CHARS = 20, 50, 20

PageReader = Callable[[bytes], list[tuple[str, bool]]]


def file_id(source_type: Column, container: Column, virtual: Column) -> Column:
    return F.sha2(F.concat_ws("|", source_type, F.coalesce(container, F.lit("")), virtual), 256)


def contents(spark: SparkSession, root: str) -> DataFrame:
    """PDF files below root and inside its zip archives, with their bytes: the manifest's columns and content.

    Ids follow from the paths alone, so no join brings bytes and manifest together; what isn't selected isn't read.
    """
    read = lambda glob: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    iso = F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ssXXX")
    plain = read("*.[pP][dD][fF]").select(F.lit("fs").alias("source_type"), F.lit(None).cast("string").alias("container_path"), F.col("path").alias("virtual_path"), F.col("length").alias("size_bytes"), iso.alias("mtime"), "content")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["source_type", "container_path", "virtual_path", "size_bytes", "mtime", "content"]
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(BytesIO(content)) as z:
                        for m in z.infolist():
                            name = m.filename.replace("\\", "/")
                            if not m.is_dir() and name.lower().endswith(".pdf"):
                                at = "{:04}-{:02}-{:02}T{:02}:{:02}:{:02}".format(*m.date_time)
                                try:
                                    data = z.read(m)
                                except (zipfile.BadZipFile, RuntimeError, NotImplementedError):  # damaged, encrypted or of an unknown method
                                    data = None
                                yield pd.DataFrame([("zip", path, f"zip://{path}::{name}", m.file_size, at, data)], columns=columns)
                except zipfile.BadZipFile:
                    continue

    packed = read("*.[zZ][iI][pP]").select("path", "content").mapInPandas(members, "source_type string, container_path string, virtual_path string, size_bytes long, mtime string, content binary")
    both = plain.unionByName(packed)
    return both.select(file_id(F.col("source_type"), F.col("container_path"), F.col("virtual_path")).alias("file_id"), *both.columns, F.lit("pdf").alias("ext"))


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """PDF files below root and inside its zip archives: file_id, source_type, container_path, virtual_path, size_bytes, mtime, ext."""
    return contents(spark, root).drop("content")


def pypdf_pages(content: bytes) -> list[tuple[str, bool]]:
    """Text and whether there is an image, of each page; needs pypdf."""
    import pypdf

    return [(p.extract_text() or "", bool(len(p.images))) for p in pypdf.PdfReader(BytesIO(content)).pages]


def probed(files: DataFrame, reader: PageReader = pypdf_pages) -> DataFrame:
    """files (file_id, content) with pages (text_chars, has_image) and errors; a file that can't be read has the error only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, content in zip(b["file_id"], b["content"]):
                try:
                    out.append((i, [{"text_chars": len(t.strip()), "has_image": im} for t, im in reader(bytes(content))], None))
                except Exception as e:  # a broken file is a row with its error
                    out.append((i, [], type(e).__name__))
            yield pd.DataFrame(out, columns=["file_id", "pages", "errors"])

    return files.select("file_id", "content").mapInPandas(run, "file_id string, pages array<struct<text_chars:int,has_image:boolean>>, errors string")


def classified(probe: DataFrame) -> DataFrame:
    """Page counters over the first pages, and the class: text, scanned, mixed or unknown."""
    seen = F.slice("pages", 1, SAMPLED)
    df = probe.withColumns({
        "page_count": F.size("pages"), "sampled": F.size("pages") > SAMPLED, "n_seen": F.size(seen),
        "text_pages": F.size(F.filter(seen, lambda p: p["text_chars"] >= TEXT_CHARS)), "image_pages": F.size(F.filter(seen, lambda p: p["has_image"])),
        "low_text_pages": F.size(F.filter(seen, lambda p: p["text_chars"] < LOW_CHARS)), "text_char_count_total": F.aggregate(seen, F.lit(0), lambda a, p: a + p["text_chars"]).cast("long"),
    })
    return df.withColumn("classification", pdf_class(F.col("text_pages"), F.col("image_pages"), F.col("low_text_pages"), F.col("n_seen")))


def pdf_class(text: Column, image: Column, low: Column, n: Column) -> Column:
    t, i, s = text / n, image / n, low / n
    return F.when(n == 0, "unknown").when((t >= 0.6) & (i <= 0.2), "text").when((i >= 0.6) & (s >= 0.8), "scanned").when((text > 0) & (image > 0), "mixed").when(t >= 0.6, "text").when(i >= 0.6, "scanned").otherwise("unknown")


def ocr_targets(phase1: DataFrame, include_unknown: bool = False) -> DataFrame:
    """Scanned and mixed files; with include_unknown all others too (text files are among those then)."""
    kind = F.when(F.col("classification").isin("scanned", "mixed"), F.col("classification")).otherwise("unknown")
    return phase1.where(F.col("ext") == "pdf").where(F.coalesce("file_id", F.lit("")) != "").where(kind.isin("scanned", "mixed", *(["unknown"] if include_unknown else [])))


def ocr_decision(text_chars: Column, has_image: Column, mode: str = "image-heavy", text_min: int = TEXT_CHARS, low_max: int = LOW_CHARS) -> Column:
    """Struct decision, reason of a page in a mixed file."""
    rule = lambda d, r: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
    if mode == "all":
        return rule("ocr", "mixed_mode_all")
    return (
        F.when(text_chars.isNull() | has_image.isNull(), rule("ocr", "missing_signal_fallback_ocr")).when(text_chars >= text_min, rule("skip_pdf_text", "text_page_threshold_met"))
        .when(~has_image, rule("skip_no_image", "no_images_detected")).when(text_chars <= low_max, rule("ocr", "image_with_low_text")).otherwise(rule("skip_pdf_text", "prefer_embedded_text"))
    )


def tesseract_page(pdf: bytes, page: int, timeout: int = 120) -> tuple[str, str | None]:
    """Text of a page by pdftoppm and tesseract; without the programs nothing, and the status says so."""
    if not (shutil.which("pdftoppm") and shutil.which("tesseract")):
        return "", "pending_ocr"
    with tempfile.TemporaryDirectory() as d:  # a worker's own scratch, gone after the page
        src = Path(d, "in.pdf")
        src.write_bytes(pdf)
        try:
            subprocess.run(["pdftoppm", "-f", str(page + 1), "-l", str(page + 1), "-r", "200", "-png", src, f"{d}/p"], check=True, timeout=timeout, capture_output=True)
            image = next(Path(d).glob("p*.png"))
            return subprocess.run(["tesseract", image, "stdout"], check=True, timeout=timeout, capture_output=True, text=True).stdout, None
        except (subprocess.SubprocessError, StopIteration) as e:
            return "", type(e).__name__


def ocr(pages: DataFrame, engine: Callable[[bytes, int], tuple[str, str | None]] = tesseract_page) -> DataFrame:
    """pages (file_id, page_index, content) with text and status; only pages to be read should come here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [engine(bytes(c), int(i)) for c, i in zip(b["content"], b["page_index"])]
            yield pd.DataFrame({"file_id": b["file_id"], "page_index": b["page_index"], "text": [g[0] for g in got], "status": [g[1] or "ok" for g in got]})

    return pages.select("file_id", "page_index", "content").mapInPandas(run, "file_id string, page_index int, text string, status string")


def ocr_files(files: DataFrame, plan: DataFrame, engine: Callable[[bytes, int], tuple[str, str | None]] = tesseract_page) -> DataFrame:
    """ocr() for the planned pages of whole files (file_id, content): a file's bytes travel once, not once a page."""
    wanted = plan.where("decision = 'ocr'").groupBy("file_id").agg(F.sort_array(F.collect_set("page_index")).alias("wanted"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, content, pages in zip(b["file_id"], b["content"], b["wanted"]):
                got = [engine(bytes(content or b""), int(k)) for k in pages]
                yield pd.DataFrame({"file_id": i, "page_index": list(map(int, pages)), "text": [g[0] for g in got], "status": [g[1] or "ok" for g in got]})

    return files.select("file_id", "content").join(wanted, "file_id").mapInPandas(run, "file_id string, page_index int, text string, status string")


def page_texts(files: DataFrame, reader: PageReader = pypdf_pages) -> DataFrame:
    """file_id, page_index, text, has_image of each page of files (file_id, content); files that can't be read have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, content in zip(b["file_id"], b["content"]):
                try:
                    got = reader(bytes(content))
                except Exception:  # the probe has the file's error
                    continue
                yield pd.DataFrame({"file_id": i, "page_index": range(len(got)), "text": [t for t, _ in got], "has_image": [im for _, im in got]})

    return files.select("file_id", "content").mapInPandas(run, "file_id string, page_index int, text string, has_image boolean")


def ocr_plan(phase1: DataFrame, texts: DataFrame, mode: str = "image-heavy") -> DataFrame:
    """file_id, page_index, decision, reason for each page of the files to be read by OCR.

    Scanned and unknown files are read whole; of mixed ones the pages that ocr_decision names.
    """
    pages = phase1.where("page_count > 0").select("file_id", "classification", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page_index"))
    seen = texts.select("file_id", "page_index", F.length(F.trim("text")).alias("__n"), "has_image")
    whole = F.struct(F.lit("ocr").alias("decision"), F.lit("classification_requires_ocr").alias("reason"))
    plan = F.when(F.col("classification") == "mixed", ocr_decision(F.col("__n"), F.col("has_image"), mode)).otherwise(whole)
    return pages.join(seen, ["file_id", "page_index"], "left").select("file_id", "page_index", plan.alias("plan")).select("file_id", "page_index", "plan.decision", "plan.reason")


def page_batches(plan: DataFrame, most: int = 8) -> DataFrame:
    """plan's pages with batch: runs of pages that follow each other, cut after `most` pages; numbered from 0 in a file."""
    file = Window.partitionBy("file_id").orderBy("page_index")
    runs = plan.withColumn("__run", F.col("page_index") - F.row_number().over(file))
    place = F.row_number().over(Window.partitionBy("file_id", "__run").orderBy("page_index")) - 1
    return runs.withColumn("__new", (place % most == 0).cast("int")).withColumn("batch", (F.sum("__new").over(file) - 1).cast("int")).drop("__run", "__new")


def merged_pages(pdf: DataFrame, scanned: DataFrame, text_min: int = TEXT_CHARS) -> DataFrame:
    """Page texts of mixed files: the embedded text if it is long enough, else what OCR found, else nothing, for review.

    pdf: file_id, page_index, text; scanned: also status and, if there is any, confidence. One full join on the page.
    """
    p = pdf.select("file_id", "page_index", F.col("text").alias("pdf_text"))
    o = scanned.select("file_id", "page_index", F.col("text").alias("ocr_text"), F.col("confidence") if "confidence" in scanned.columns else F.lit(None).cast("double").alias("confidence"), "status")
    df = p.join(o, ["file_id", "page_index"], "full")
    embedded = F.length(F.coalesce("pdf_text", F.lit(""))) >= text_min
    found = ~embedded & (F.trim(F.coalesce("ocr_text", F.lit(""))) != "")
    reason = F.when(embedded | found, None).when(F.col("status").isNull(), "missing_phase2_page").when(F.col("status") == "ok", "missing_ocr_text").otherwise("missing_mixed_text_sources")
    text = F.when(embedded, F.col("pdf_text")).when(found, F.col("ocr_text")).otherwise("")
    return df.select("file_id", "page_index", text.alias("text"), F.when(embedded, "pdf_text").otherwise("ocr").alias("source"), F.when(~embedded, F.col("confidence")).alias("confidence"), reason.isNotNull().alias("review_required"), reason.alias("review_reason"))


def document_pages(phase1: DataFrame, texts: DataFrame, scanned: DataFrame) -> DataFrame:
    """The pages of all files with text, source, review and quality: embedded texts of text files, merged ones of mixed files,
    OCR's of the others and of text files that can't be read.

    phase1: file_id, classification, page_count; texts: page_texts(); scanned: ocr().
    """
    kind = F.when(F.col("classification").isin("text", "mixed", "scanned"), F.col("classification")).otherwise("unknown")
    files = phase1.where(F.coalesce("file_id", F.lit("")) != "").select("file_id", kind.alias("classification"), F.col("page_count").alias("__pages"))
    of = lambda df, k: df.join(files.where(F.col("classification") == k).select("file_id"), "file_id", "left_semi")
    read = of(texts, "text").select("file_id", "page_index", F.coalesce("text", F.lit("")).alias("text"), F.lit("pdf_text").alias("source"), F.lit(None).cast("double").alias("confidence"), F.lit(False).alias("review_required"), F.lit(None).cast("string").alias("review_reason"))
    listed = lambda rows: rows.where("__pages > 0").select("file_id", F.explode(F.sequence(F.lit(0), F.col("__pages") - 1)).alias("page_index"))
    mixed = files.where("classification = 'mixed'")
    both = merged_pages(listed(mixed).join(of(texts, "mixed").select("file_id", "page_index", "text"), ["file_id", "page_index"], "left"), of(scanned, "mixed"))
    others = files.where("classification IN ('scanned', 'unknown')").unionByName(files.where("classification = 'text'").join(texts.select("file_id"), "file_id", "left_anti"))
    confidence = F.col("confidence") if "confidence" in scanned.columns else F.lit(None).cast("double")
    done = scanned.select("file_id", "page_index", "text", confidence.alias("confidence"), "status")
    # A page that OCR should have read and has not is one for review; pages beyond those that OCR knows are just empty.
    failed = F.coalesce(F.col("status") != "ok", F.lit(False))
    ocr_only = listed(others).join(done, ["file_id", "page_index"], "left").select("file_id", "page_index", F.coalesce("text", F.lit("")).alias("text"), F.lit("ocr").alias("source"), "confidence", failed.alias("review_required"), F.when(failed, "missing_text_path").alias("review_reason"))
    return with_page_quality(read.unionByName(both).unionByName(ocr_only))


def with_page_quality(pages: DataFrame) -> DataFrame:
    """pages with text_char_count, quality_flags and quality_score_page."""
    text = F.coalesce("text", F.lit(""))
    empty = ~text.rlike(r"\S")
    flags = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("source").isin("pdf_text", "ocr"), F.lit(False)), "missing_source"), F.when(empty, "empty_text").when(F.length(text) <= LOW_CHARS, "low_text"),
        F.when((F.col("source") == "ocr") & F.col("review_reason").isin("unreadable_text_path", "missing_text_path"), "ocr_error"),
    ))
    pages = pages.withColumns({"text_char_count": F.length(text), "quality_flags": flags})
    return pages.withColumn("quality_score_page", page_score(F.col("text_char_count"), F.col("confidence"), F.coalesce("review_required", F.lit(False)), F.col("quality_flags")))
