"""Sharding by a k-d tree over the documents' metadata. Native: DataFrame functions only.

Equal texts are one point (they stay in one shard) that weighs the bytes of all its rows. Points have a coordinate in each
metadata dimension: id, source, language and length. A node is split in its widest dimension, at the weighted
quantile that leaves each side the bytes its leaves shall hold, until each leaf is one shard of the target bytes.
Quantiles are found by distributed radix selection: weights are summed by node and 12-bit digit, digit by digit, so each
aggregate has at most 4,096 rows for each of the level's nodes, whatever the input. Points of an eighth of the target or more (there can
be no more than eight for each shard) are dealt first, largest to the emptiest shard; the tree fills up what they leave.

Size: UTF-8 bytes plus 8; a null text has none. Null metadata is coordinate 0. Ties in a coordinate are split by the
text's hash. Repeated rows are equal texts. Empty tables give no rows. Slots are numbered in hashed buckets,
about as many in a shard as each has rows, so no shard's rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import table, written

SHARDS = 24
#: Bits of a coordinate that its value and its tie-break have, and of a digit.
VALUE, TIE, DIGIT = 18, 18, 12
#: A point of this share of the target bytes is dealt before the tree.
HEAVY = 0.125

DIMS = ("c_id", "c_source", "c_lang", "c_bytes")


def _points(rows: DataFrame) -> DataFrame:
    """A row for each text (h, text_crc32, bytes): its weight and coordinates."""
    points = rows.groupBy("h", "text_crc32", "size").agg(F.sum("size").alias("weight"), F.min("doc_id").alias("id"), F.min("source").alias("source"), F.min("lang").alias("lang"))
    ends = rows.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    lo, hi = ends["lo"] or 0, ends["hi"] or 0
    top = float((1 << VALUE) - 1)
    hashed = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.shiftrightunsigned(F.xxhash64(c), 64 - VALUE))
    values = {
        "c_id": F.coalesce(F.floor((F.col("id") - F.lit(lo)) / F.lit(float(max(hi - lo, 1))) * top), F.lit(0)),
        "c_source": hashed("source"),
        "c_lang": hashed("lang"),
        "c_bytes": F.least(F.lit(int(top)), F.floor(F.log2("size") / 32.0 * top)),
    }
    tie = F.shiftrightunsigned("h", 64 - TIE)
    coords = [F.shiftleft(v.cast("long"), TIE).bitwiseOR(tie).alias(c) for c, v in values.items()]
    return points.select("h", "text_crc32", "size", "weight", *coords)


def _deal_heavy(heavy: list, shards: int, total: int) -> tuple[dict, list[float]]:
    """Shard of each heavy point, largest first to the emptiest; the bytes that each shard has still to get."""
    filled, where = [0.0] * shards, {}
    for r in heavy:
        s = min(range(shards), key=lambda i: (filled[i], i))
        where[(r.h, r.text_crc32, r["size"])] = s
        filled[s] += r.weight
    left = total - sum(filled)
    order = sorted(filled)
    level = 0.0
    for n in range(1, shards + 1):  # the level that the n emptiest shards reach with what is left
        level = (left + sum(order[:n])) / n
        if n == shards or level <= order[n]:
            break
    return where, [max(0.0, level - f) for f in filled]


class _Node:
    def __init__(self, leaves: list[int]) -> None:
        self.leaves, self.dim, self.at, self.low, self.high = leaves, None, 0, None, None

    def expr(self, leaf) -> Column:
        """leaf(node) for the node below that a point falls to."""
        if self.dim is None:
            return leaf(self)
        return F.when(F.col(self.dim) < self.at, self.low.expr(leaf)).otherwise(self.high.expr(leaf))


def _split(points: DataFrame, root: _Node, live: list[_Node], room: list[float]) -> None:
    """Split each live node (two leaves or more) at its weighted quantile in its widest dimension."""
    number = {id(n): i for i, n in enumerate(live)}
    node = root.expr(lambda n: F.lit(number.get(id(n), -1)))
    at = points.select(node.alias("node"), *DIMS, "weight").where("node >= 0")
    ends = {r.node: r for r in at.groupBy("node").agg(F.sum("weight").alias("w"), *[f(c).alias(f"{n}_{c}") for c in DIMS for n, f in (("min", F.min), ("max", F.max))]).collect()}
    goal, below, prefix = {}, {}, {}
    for i, n in enumerate(live):
        half = len(n.leaves) // 2
        n.low, n.high = _Node(n.leaves[:half]), _Node(n.leaves[half:])
        r = ends.get(i)
        n.dim = max(DIMS, key=lambda c: ((r[f"max_{c}"] - r[f"min_{c}"]) >> TIE if r else 0, -DIMS.index(c)))
        want, other = sum(room[s] for s in n.low.leaves), sum(room[s] for s in n.high.leaves)
        goal[i] = (r.w if r else 0) * (want / (want + other) if want + other else 0.5)
        below[i] = prefix[i] = 0

    def of(values: dict) -> Column:
        e = F.lit(None).cast("long")
        for i, v in values.items():
            e = F.when(F.col("node") == i, v).otherwise(e)
        return e

    coord = of({i: F.col(n.dim) for i, n in enumerate(live)})
    at = at.select("node", "weight", coord.alias("c"))
    bits = VALUE + TIE
    for done in range(0, bits, DIGIT):
        inside = at.where(F.shiftright("c", bits - done) == of({i: F.lit(p) for i, p in prefix.items()}))
        digit = F.shiftright("c", bits - done - DIGIT).bitwiseAND((1 << DIGIT) - 1)
        sums: dict[int, list] = {i: [] for i in range(len(live))}
        for r in inside.groupBy("node", digit.alias("digit")).agg(F.sum("weight").alias("w")).collect():
            sums[r.node].append((r.digit, r.w))
        for i, found in sums.items():
            found.sort()
            digit_at = 0
            last = done + DIGIT == bits
            for k, (d, w) in enumerate(found):
                digit_at = d
                # The quantile's digit is entered, but for the last one: its point goes to the nearer side.
                if below[i] + w > goal[i] or (k == len(found) - 1 and not last):
                    if last and below[i] + w - goal[i] < goal[i] - below[i]:
                        digit_at, below[i] = d + 1, below[i] + w
                    break
                below[i] += w
                digit_at = d + 1
            prefix[i] = (prefix[i] << DIGIT) + digit_at
    for i, n in enumerate(live):
        n.at = prefix[i]


def shard_tree(points: DataFrame, room: list[float]) -> Column:
    """The shard of a point, given the bytes that each shard shall get."""
    root = _Node(list(range(len(room))))
    live = [root]
    while live := [n for n in live if len(n.leaves) > 1]:
        _split(points, root, live, room)
        live = [x for n in live for x in (n.low, n.high)]
    return root.expr(lambda n: F.lit(n.leaves[0]))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select("doc_id", "source", "lang", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")))
    points = written(_points(rows))
    total = points.agg(F.sum("weight")).first()[0] or 0
    heavy = points.where(F.col("weight") >= HEAVY * total / shards).orderBy(F.desc("weight"), "h", "text_crc32", "size").collect() if total else []
    where, room = _deal_heavy(heavy, shards, total)
    light = points.where(F.col("weight") < HEAVY * total / shards)
    shard = shard_tree(light, room) if total else F.lit(0)
    for (h, crc, size), s in where.items():
        shard = F.when((F.col("h") == h) & (F.col("text_crc32") == crc) & (F.col("size") == size), F.lit(s)).otherwise(shard)
    named = written(points.select("h", "text_crc32", "size", shard.alias("shard")))
    placed = written(rows.select("doc_id", "size", "text_crc32", "h").join(named, ["h", "text_crc32", "size"]))
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    buckets = F.lit(1)
    for s, n in counts.items():
        buckets = F.when(F.col("shard") == s, F.lit(max(1, int(n**0.5)))).otherwise(buckets)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h"), buckets))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "h")
    offsets = placed.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("slot", F.row_number().over(inside) - 1).join(offsets, ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("offset")).alias("slot"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
