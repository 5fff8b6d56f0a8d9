"""JSON Lines: fail-soft reads, shard sets, resumable writes. Paths are whatever Spark can open."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.sources.scratch import written


class ResumeError(Exception):
    """A run can't go on from what is there."""


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records with _corrupt_record; blank lines are left out, bad ones kept for counting. Plain, .gz and .zst."""
    if "_corrupt_record" not in schema:
        schema += ", _corrupt_record string"
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def good_and_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and bad ones with a reason. The text of a line is never shown, only its hash."""
    bad = df.where(F.col("_corrupt_record").isNotNull())
    return df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record"), bad.select(F.lit("json_decode_error").alias("reason"), F.sha2("_corrupt_record", 256).alias("line_hash"))


def with_locator(df: DataFrame) -> DataFrame:
    """Where a record's text is: its file and chunk (lines have no byte offsets in a distributed read)."""
    return df.withColumn("text_ref", F.concat(F.col("_metadata.file_path"), F.lit("#chunk_id="), "chunk_id"))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(p) or [])


def shards(spark: SparkSession, root: str, stem: str = "docs_*") -> list[str]:
    """A shard set's files: those of its manifest.json, else the first kind of .jsonl.zst, .jsonl.gz, .jsonl that is there."""
    names: list[str] = []
    if exists(spark, f"{root}/manifest.json"):
        text = spark.read.text(f"{root}/manifest.json", wholetext=True).first()[0]
        try:
            names = [s["shard"] for s in json.loads(text).get("shards") or [] if s.get("shard")]
        except (ValueError, AttributeError):
            names = []
    found = [f"{root}/{n}" for n in names]
    for ext in () if found else ("jsonl.zst", "jsonl.gz", "jsonl"):
        if found := listed(spark, f"{root}/{stem}.{ext}"):
            break
    if not found:
        raise ResumeError("no shard files: docs_*.jsonl.zst, docs_*.jsonl.gz or docs_*.jsonl")
    if gone := [f for f in found if not exists(spark, f)]:
        raise ResumeError(f"missing shards: {[g.rsplit('/', 1)[1] for g in gone]}")
    return found


def write_jsonl(df: DataFrame, path: str, shard_size: int | None = None, mode: str = "errorifexists") -> None:
    """Gzip JSON Lines, a file for at most shard_size records (zstd is Parquet's here: the JSON writer has no such codec)."""
    w = df.write.mode(mode).option("compression", "gzip").option("ignoreNullFields", "false")
    (w.option("maxRecordsPerFile", shard_size) if shard_size else w).json(path)


def write_shards(df: DataFrame, root: str, shard_size: int, order: list[str]) -> dict:
    """A shard set: docs_00000.jsonl.gz and so on, of shard_size records each in `order`, and manifest.json with the place of each; what is there is replaced.

    Records are numbered by range-sorted parts and the sums before them; a shard is one task's file. The driver sees a row for each part and each shard.
    """
    spark = df.sparkSession
    parts = written(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    before, sizes = 0, []
    for r in parts.groupBy("__p").count().orderBy("__p").collect():
        sizes.append((r["__p"], before))
        before += r["count"]
    starts = spark.createDataFrame(sizes, "__p int, __before long")
    number = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) + F.col("__before") - 1
    dealt = parts.join(F.broadcast(starts), "__p").withColumn("__i", number).withColumn("__shard", F.floor(F.col("__i") / shard_size))
    made = f"{root}/.shards-{uuid.uuid4().hex}"
    tidy = dealt.repartition(max(1, -(-before // shard_size)), "__shard").sortWithinPartitions("__shard", "__i")
    tidy.drop("__p", "__before", "__i").write.partitionBy("__shard").option("compression", "gzip").option("ignoreNullFields", "false").json(made)
    fs, _ = _fs(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for old in [*listed(spark, f"{root}/docs_*"), *([f"{root}/manifest.json"] if exists(spark, f"{root}/manifest.json") else [])]:
        fs.delete(path(old), True)
    entries = []
    for k in range(-(-before // shard_size)):
        name = f"docs_{k:05d}.jsonl.gz"
        fs.rename(path(listed(spark, f"{made}/__shard={k}/part-*")[0]), path(f"{root}/{name}"))
        entries.append({"shard": name, "start_index": k * shard_size, "end_index": min(before, (k + 1) * shard_size) - 1, "doc_count": min(before, (k + 1) * shard_size) - k * shard_size})
    fs.delete(path(made), True)
    manifest = {"shard_size": shard_size, "shards": entries}
    out = fs.create(path(f"{root}/manifest.json"), True)
    out.write(json.dumps(manifest).encode())
    out.close()
    return manifest


def append_new(new: DataFrame, path: str, key: str) -> DataFrame:
    """Resume: write only rows whose key isn't in the Parquet table at path yet; returns them."""
    spark = new.sparkSession
    recover(spark, path)
    fresh = new.dropDuplicates([key])
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    fresh = written(fresh)
    fresh.write.mode("append").parquet(path)
    return fresh


def recover(spark: SparkSession, path: str) -> None:
    """Ends an exchange of tables that was interrupted: a whole new table takes its place, else the old one goes back."""
    fs, p = _fs(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    old, fresh = path_of(f"{path}.old"), path_of(f"{path}.next")
    if not fs.exists(p):
        if fs.exists(path_of(f"{path}.next/_SUCCESS")):
            fs.rename(fresh, p)
        elif fs.exists(old):
            fs.rename(old, p)
    fs.delete(fresh, True)
    fs.delete(old, True)


def replace_keys(new: DataFrame, path: str, key: str = "file_id") -> None:
    """Rows of the keys in new take the place of old ones: a new table is written beside, then the two are exchanged.

    Between the two renames there is no table at path; recover(), which this and append_new call first, ends what a crash left there.
    """
    spark = new.sparkSession
    recover(spark, path)
    if not exists(spark, path):
        new.write.parquet(path)
        return
    old = spark.read.parquet(path)
    old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True).write.mode("overwrite").parquet(f"{path}.next")
    fs, p = _fs(spark, path)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs.rename(p, path_of(f"{path}.old"))
    fs.rename(path_of(f"{path}.next"), p)
    fs.delete(path_of(f"{path}.old"), True)


def check_resume(spark: SparkSession, root: str, shard_size: int, extension: str) -> None:
    """Raises if what is there was written with another shard size or compression, or shards and manifest differ."""
    if not exists(spark, f"{root}/manifest.json"):
        if listed(spark, f"{root}/docs_*"):
            raise ResumeError("shards without a manifest")
        return
    m = json.loads(spark.read.text(f"{root}/manifest.json", wholetext=True).first()[0])
    if m.get("shard_size") != shard_size:
        raise ResumeError("another shard size")
    names = {s["shard"] for s in m.get("shards", [])}
    if any(not n.endswith(extension) for n in names):
        raise ResumeError("another compression")
    there = {f.rsplit("/", 1)[1] for f in listed(spark, f"{root}/docs_*")}
    if names - there or there - names:
        raise ResumeError("shards and manifest differ")


def read_ids(spark: SparkSession, path: str | None) -> DataFrame:
    """file_id of each non-blank line; no path, no ids."""
    if not path:
        return spark.createDataFrame([], "file_id string")
    return spark.read.text(path).select(F.trim("value").alias("file_id")).where("file_id <> ''").distinct()


def read_packs(spark: SparkSession, root: str, most: int = 100, keywords: int = 5000, length: int = 200) -> dict[str, list[str]]:
    """Keyword packs: a .txt file each, # for comments. At most 100 packs, 5,000 keywords, 200 characters."""
    packs: dict[str, list[str]] = {}
    for f in listed(spark, f"{root}/*.txt")[:most]:
        lines = [r.value.strip() for r in spark.read.text(f).collect()]
        kept = list(dict.fromkeys(x for x in lines if x and not x.startswith("#") and len(x) <= length))
        packs[f.rsplit("/", 1)[1].removesuffix(".txt")] = kept[:keywords]
    return packs
