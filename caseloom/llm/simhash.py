"""SimHash near-duplicates by a binary trie's self-join.

Words are maximal runs of other than ASCII white space after lower-casing A-Z; each run of three words,
repeats included, votes with its XXH64 (seed 42) on 64 bits. Fingerprints that differ in two bits or fewer
are linked. Two such fingerprints agree wholly on one of three thirds of their bits, so a trie is built three times, with
another third at its top: there the traversal spends no error, and each subtree below is a task. In
a subtree node pairs are traversed together, from the differing bits that the task's own path has spent; they add up, and a pair is left when they exceed the budget. A
subtree over LIMIT fingerprints isn't one task: its node pairs four bits further down become the tasks, again and
again, so a hot prefix never meets in one place. A task emits links to the root of each of its components, not all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share a fingerprint.
component_id is the smallest non-null doc_id reachable. Very long texts are read whole. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import components, keep_rows, keyed, map_slices, shielded, table, utf8, written

BITS, BUDGET, SHINGLE, SEED = 64, 2, 3, 42
#: Offset and length of the thirds that are the top of the three tries.
TOPS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints in a task at most; STEP levels are descended where there are more.
LIMIT, STEP = 512, 4
#: Pairs of values below which a pair of trie nodes counts as two leaves.
LEAVES = 256

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_WEIGHTS = (np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)).astype(np.uint64)


def fingerprint(data: bytes) -> int:
    """The unsigned fingerprint of a text's UTF-8 bytes."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = [0, *(ends[: n - SHINGLE] + 1).tolist()]
    hashed = xxhash.xxh64_intdigest
    h = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())], np.uint64)
    by_byte = h.astype(">u8").view(np.uint8).reshape(-1, 8)
    if len(h) <= 512:
        votes = np.unpackbits(by_byte, axis=1).sum(axis=0, dtype=np.int64)
    else:
        votes = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _ONES for k in range(8)])
    return int(_WEIGHTS[votes * 2 > len(h)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: __id, __h, __n, fp (the fingerprint's 64 bits as a signed long)."""

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t) for t in batch.column(3).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fp, pa.int64())], names=["__id", "__h", "__n", "fp"])

    rows = keyed(docs).select("__id", "__h", "__n", utf8("text").alias("data"))
    return map_slices(rows, fn, f"__id {docs.schema['doc_id'].dataType.simpleString()}, __h long, __n int, fp long")


def _pairs(a: np.ndarray, b: np.ndarray, bit: int, spent: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in the sorted a and b whose values differ in budget bits or fewer, `spent` of them above `bit`.

    Depth-first over pairs of trie nodes; a node is a range of sorted values that share their upper bits. A pair of small nodes is a pair of
    leaves: what remains of their values is compared with what remains of the budget.
    """
    stack = [(0, len(a), 0, len(b), bit, spent)]
    while stack:
        a0, a1, b0, b1, bit, spent = stack.pop()
        if a0 == a1 or b0 == b1 or spent > budget:
            continue
        if bit == 0 or (a1 - a0) * (b1 - b0) <= LEAVES:
            low = np.uint64((1 << bit) - 1)
            x, y = np.nonzero(np.bitwise_count((a[a0:a1, None] ^ b[None, b0:b1]) & low) <= budget - spent)
            yield x + a0, y + b0
            continue
        bit -= 1
        # In a node's range the values are sorted and agree above `bit`, so those with that bit set come last.
        am = a0 + int(np.searchsorted((a[a0:a1] >> np.uint64(bit)) & np.uint64(1), 1))
        bm = b0 + int(np.searchsorted((b[b0:b1] >> np.uint64(bit)) & np.uint64(1), 1))
        stack += [(a0, am, b0, bm, bit, spent), (am, a1, bm, b1, bit, spent), (a0, am, bm, b1, bit, spent + 1), (am, a1, b0, bm, bit, spent + 1)]


def local_links(a: np.ndarray, b: np.ndarray | None, bit: int, spent: int = 0) -> list[tuple[int, int]]:
    """Links that connect what the join of a with b (None: with itself) connects: (value, root of its component)."""
    values = a if b is None else np.concatenate([a, b])
    parent = list(range(len(values)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in _pairs(a, a if b is None else b, bit, spent, BUDGET):
        for i, j in zip(x.tolist(), (y + (0 if b is None else len(a))).tolist()):
            if i < j and (p := root(i)) != (q := root(j)):
                parent[max(p, q)] = min(p, q)
    return [(int(values[i]), int(values[r])) for i in range(len(values)) if (r := root(i)) != i]


def _rotated(fp: np.ndarray, by: int) -> np.ndarray:
    by %= 64
    return fp if not by else (fp << np.uint64(by)) | (fp >> np.uint64(64 - by))


def _join_tasks(tasks: DataFrame) -> DataFrame:
    """The links (a, b) of each task (rot, depth, pa, pb): rows with side 0, and with side 1 unless pa = pb."""

    def links(key: tuple, side: np.ndarray, fp: np.ndarray) -> list[tuple[int, int]]:
        rot, depth, pa_, pb_ = key
        values = _rotated(fp.view(np.uint64), rot)
        a, b = np.sort(values[side == 0]), np.sort(values[side == 1])
        found = local_links(a, None if pa_ == pb_ else b, BITS - depth, (pa_ ^ pb_).bit_count())
        if not found:
            return []
        back = _rotated(np.array(found, np.uint64), 64 - rot).view(np.int64)
        return back.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides, fps, out = None, [], [], []
        for batch in batches:
            cols = [np.asarray(batch.column(k)) for k in range(6)]
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for c in cols[:4]:
                new[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(new).tolist()]
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                at = tuple(int(c[s]) for c in cols[:4])
                if at != key:
                    if key is not None and sum(map(len, fps)) > 1:
                        out += links(key, np.concatenate(sides), np.concatenate(fps))
                    key, sides, fps = at, [], []
                sides.append(cols[4][s:e])
                fps.append(cols[5][s:e])
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if key is not None and sum(map(len, fps)) > 1:
            out += links(key, np.concatenate(sides), np.concatenate(fps))
        yield _edges(out)

    key = ["rot", "depth", "pa", "pb"]
    dealt = tasks.select(*key, "side", "fp").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "a long, b long")


def _edges(out: list) -> pa.RecordBatch:
    at = np.array(out, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1])], names=["a", "b"])


def trie_links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that connect all pairs within the budget."""
    turned = lambda rot: F.col("fp") if not rot else F.shiftleft("fp", rot).bitwiseOR(F.shiftrightunsigned("fp", 64 - rot))
    tops = [distinct.select(F.lit(rot).alias("rot"), F.lit(n).alias("depth"), F.shiftrightunsigned(turned(rot), 64 - n).alias("pa"), "fp") for rot, n in TOPS]
    tasks = tops[0].union(tops[1]).union(tops[2]).select("rot", "depth", "pa", F.col("pa").alias("pb"), F.lit(0).alias("side"), F.lit(0).alias("err"), "fp")
    key, done = ["rot", "depth", "pa", "pb"], None
    while True:
        sized = tasks.groupBy(*key).agg(F.count("*").alias("n"), F.min("side").alias("s0"), F.max("side").alias("s1"))
        # A task with one fingerprint, or with those of one node only, has nothing to join.
        sized = written(sized.where("n > 1 AND (pa = pb OR s0 < s1)").select(*key, "n"))
        live = tasks.join(sized, key)
        found = _join_tasks(live.where(F.col("n") <= limit))
        done = found if done is None else done.union(found)
        if not sized.where(F.col("n") > limit).limit(1).count():
            return done
        hot = live.where(F.col("n") > limit)
        value = F.when(F.col("rot") == 0, F.col("fp"))
        for rot, _ in TOPS[1:]:
            value = value.when(F.col("rot") == rot, turned(rot))
        step = 1 << STEP
        nibble = F.shiftrightunsigned(F.call_function("shiftleft", F.col("v"), F.col("depth")), 64 - STEP)
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("w")) for m in range(step) if m.bit_count() <= BUDGET])
        hot = hot.withColumn("v", value).withColumn("sub", nibble).withColumn("x", F.explode(masks)).where(F.col("err") + F.col("x.w") <= BUDGET)
        other = F.col("sub").bitwiseXOR(F.col("x.m"))
        own, theirs = F.col("pa") * step + F.col("sub"), F.col("pa") * step + other
        same, first = F.col("pa") == F.col("pb"), F.col("side") == 0
        pa_ = F.when(same, F.least(own, theirs)).when(first, own).otherwise(F.col("pa") * step + other)
        pb_ = F.when(same, F.greatest(own, theirs)).when(first, F.col("pb") * step + other).otherwise(F.col("pb") * step + F.col("sub"))
        side = F.when(same, (own > theirs).cast("int")).otherwise(F.col("side"))
        tasks = written(hot.select("rot", (F.col("depth") + STEP).alias("depth"), pa_.alias("pa"), pb_.alias("pb"), side.alias("side"), (F.col("err") + F.col("x.w")).alias("err"), "fp"))


def simhash_groups(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row: __id, __h, __n, fp, component_id, root (the component's smallest fingerprint)."""
    rows = written(fingerprints(docs))
    first = written(rows.groupBy("fp").agg(F.min("__id").alias("first")))
    comp = components(trie_links(first.select("fp"), limit))
    named = first.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = written(named)
    least = written(named.groupBy("root").agg(F.min("first").alias("component_id")))
    labels = written(named.join(least, "root").select("fp", "component_id", "root"))
    return rows.join(labels, "fp").select("__id", "__h", "__n", "fp", "component_id", "root")


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """One row of docs for each component: the one with the smallest doc_id. All columns are kept."""
    docs, back = shielded(docs)
    kept = simhash_groups(docs).where(F.col("__id").eqNullSafe(F.col("component_id")))
    # Only rows with a null or repeated id can tie: one of them stays.
    kept = kept.groupBy("root", "__id").agg(F.min(F.struct("__h", "__n")).alias("k"), F.count("*").alias("__rep"))
    return back(keep_rows(docs, written(kept.select("__id", "k.__h", "k.__n", "__rep"))))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
