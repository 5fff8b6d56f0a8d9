"""Exact de-duplication by content-defined chunk recipes.

A text (A-Z lower-cased, UTF-8) is cut where its own content says so; each chunk gets a digest, and a
document becomes the ordered list of its chunks' digests: its recipe. Recipes are written once. Only digests that occur more than
once can stand for different chunks, so only such chunks' bytes are shuffled, to verify that they are equal (else all is done again with a wider digest): a
filter of FILTER bits, of bounded size whatever the input, tells which may, and where it fills up more of the bytes travel, at
most all of them. From then on only recipes travel, about one hundredth of the text; equal recipes are equal texts.

Null texts count as empty, and empty texts are equal. Very long texts are chunked whole. Repeated rows are members of their group like any
others; where several rows tie for the largest doc_id, `exact_groups` marks each of them as kept and
`exact_dedup` returns one. A null doc_id is smaller than any other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import keep_rows, keyed, map_slices, shielded, table, utf8, written

#: A cut needs 1 in MASK + 1 window hashes; chunks have LEAST to MOST bytes, but for a text's last.
MASK, LEAST, MOST = 1023, 512, 16384
#: Bits of the filter of repeated digests: two megabytes on the driver and in each worker.
FILTER = 1 << 24

Digest = Callable[[bytes], bytes]


def _wide(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=32).digest()


def _widest(chunk: bytes) -> bytes:
    return hashlib.sha512(chunk).digest()


#: Tried in turn until the chunks' bytes verify.
DIGESTS: tuple[Digest, ...] = (xxhash.xxh3_128_digest, _wide, _widest)


def cuts(data: bytes) -> list[int]:
    """End offsets of the chunks of data (none for no bytes): where the hash of the last 8 bytes is 0 under the mask."""
    n = len(data)
    ends: list[int] = []
    if n > LEAST:
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        four = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
        h = four[:-4] * np.uint32(2654435761) ^ four[4:] * np.uint32(2246822519)
        h ^= h >> 15
        h *= np.uint32(3266489917)
        last = 0
        for at in (np.flatnonzero((h >> 12) & MASK == 0) + 8).tolist():
            while at - last > MOST:
                last += MOST
                ends.append(last)
            if at - last >= LEAST:
                ends.append(at)
                last = at
        while n - last > MOST:
            last += MOST
            ends.append(last)
    if n and (not ends or ends[-1] < n):
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def recipes(docs: DataFrame, digest: Digest = DIGESTS[0]) -> DataFrame:
    """Per row: __id, __h, __n, text_sha256 of the normalised text, recipe (the chunks' digests, one after another)."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        sha, made = [], []
        for text in batch.column(3).to_pylist():
            data = text.lower()
            sha.append(hashlib.sha256(data).hexdigest())
            made.append(b"".join(map(digest, chunks(data))))
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha, pa.string()), pa.array(made, pa.binary())], names=["__id", "__h", "__n", "text_sha256", "recipe"])

    rows = keyed(docs).select("__id", "__h", "__n", utf8("text").alias("data"))
    return map_slices(rows, fn, f"__id {docs.schema['doc_id'].dataType.simpleString()}, __h long, __n int, text_sha256 string, recipe binary")


def repeated_bits(rows: DataFrame, width: int, bits: int = FILTER) -> np.ndarray:
    """A bit for each digest (width bytes) that occurs more than once in the recipes, at its first eight bytes modulo `bits`."""
    start = F.expr(f"transform(sequence(0, greatest(octet_length(recipe) div {width}, 1) - 1), i -> substring(recipe, i * {width} + 1, {width}))")
    # A recipe that many documents have is counted once, by its number.
    held = rows.where(F.octet_length("recipe") > 0).groupBy("recipe").agg(F.count("*").alias("n"))
    each = held.select(F.explode(start).alias("digest"), "n").groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1")
    at = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(bits))
    words = each.select(at.alias("at")).groupBy((F.col("at") / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int"))).alias("bits"))
    out = np.zeros(bits // 64, np.uint64)
    got = words.toArrow()  # at most one row for each 64 bits of the filter
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def chunk_rows(docs: DataFrame, digest: Digest, filled: np.ndarray | None = None) -> DataFrame:
    """Chunks whose digests the filter has (None: all): key, chunk. What repeats inside one slice of rows comes once."""
    shipped = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shipped.value

        def passes(key: bytes) -> bool:
            if bits is None:
                return True
            at = int.from_bytes(key[:7], "big") % (len(bits) * 64)
            return bool(int(bits[at >> 6]) >> (at & 63) & 1)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                own = {c for text in batch.column(0).slice(at, 64).to_pylist() for c in chunks(text.lower())}
                kept = [(key, c) for c in own if passes(key := digest(c))]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.binary()), pa.array([c for _, c in kept], pa.binary())], names=["key", "chunk"])

    return docs.select(utf8("text").alias("data")).mapInArrow(run, "key binary, chunk binary")


def verified_recipes(docs: DataFrame, digests: tuple[Digest, ...] = DIGESTS) -> DataFrame:
    """recipes(), written, after a check on the bytes that a digest stands for one chunk only."""
    for digest in digests:
        rows = written(recipes(docs, digest))
        distinct = chunk_rows(docs, digest, repeated_bits(rows, len(digest(b"")))).distinct()
        if not distinct.groupBy("key").count().where("count > 1").limit(1).count():
            return rows
    raise ValueError("different chunks share a digest of every width")


def exact_groups(docs: DataFrame, digests: tuple[Digest, ...] = DIGESTS) -> DataFrame:
    """Per row: __id, __h, __n, keep_id (largest doc_id of the equal texts), group_size, text_sha256."""
    rows = verified_recipes(docs, digests)
    groups = written(rows.groupBy("recipe").agg(F.max("__id").alias("keep_id"), F.count("*").alias("group_size")))
    return rows.join(groups, "recipe").select("__id", "__h", "__n", "keep_id", "group_size", "text_sha256")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row of docs for each text: the one with the largest doc_id. All columns are kept."""
    docs, back = shielded(docs)
    kept = exact_groups(docs).where(F.col("__id").eqNullSafe(F.col("keep_id")))
    # Equal texts in another case can tie for a null or repeated id: the smallest hash stays.
    kept = kept.groupBy("text_sha256", "__id").agg(F.min(F.struct("__h", "__n")).alias("k"), F.count("*").alias("__rep"))
    return back(keep_rows(docs, written(kept.select("__id", "k.__h", "k.__n", "__rep"))))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP2_SQL = f"""
WITH t AS (SELECT doc_id, sha256({_NORM}) AS h, {_NORM} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.h AS text_sha256
FROM t JOIN g USING (norm)
"""
