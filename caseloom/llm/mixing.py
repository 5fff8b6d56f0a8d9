"""Mixing sources to target weights by entropy balancing.

A document's rate is exp(sum of the multipliers of its margins): of all rates that meet the token constraints these
have the least relative entropy, counted in tokens, to taking every document once. The multipliers solve a
convex dual. Documents with equal margins have one rate, so their tokens are summed once, by cell of the margins; each Newton iteration joins the
multipliers to the cells and sums tokens, gradient and curvature in one distributed aggregate. The curvature is kept as the list of cells, not as a matrix,
and Newton's equations are solved by conjugate gradients. `source` is always a margin; more (say `lang`) may be given with shares of their own.

Rates become whole copies (0 to MOST) by carrying the rounding error from document to document in order of falling
size, inside buckets of about BUCKET documents of one source, so that a bucket misses by about half its smallest
document and a hot source is many buckets. Repeated rows (equal in all columns that can be hashed) are one entry there that
knows how often it occurs, so they never meet in one task, and their copies are counted in all and dealt out evenly. All of
it depends on the rows' values only, so reruns agree.

Size: number of words (maximal runs of other than ASCII white space); null and wordless texts have size 0, rate 1 and no
tokens. Very long texts count whole. Null sources are a source of their own, last in order. Empty tables give no rows. What goes to the
driver is one row for each source, or cell of the margins. Columns named as this module's own (`size`, `copies` and so on) stay as they are in `mixture`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import keyed, shielded, table, written

#: Weights of the sources in order, repeating; copies of a document and multiple of a source's size at most.
WEIGHTS, MOST = (5.0, 2.0, 1.0), 3
#: Documents in a rounding bucket, about.
BUCKET = 512


def words(c: str = "text") -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def capped_targets(sizes: Sequence[float], weights: Sequence[float], total: float, most: float = MOST) -> list[float]:
    """Shares of total by weight, none over most times its size; what is cut is shared again by weight."""
    cap = [most * s for s in sizes]
    full: set[int] = set()
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        left, weight = total - math.fsum(cap[i] for i in full), math.fsum(weights[i] for i in open_)
        share = {i: left * weights[i] / weight for i in open_}
        over = {i for i in open_ if share[i] > cap[i]}
        if not over:
            return [float(cap[i]) if i in full else share[i] for i in range(len(sizes))]
        full |= over


def _conjugate(own: np.ndarray, t: np.ndarray, right: np.ndarray) -> np.ndarray:
    """x with H x = right, H being the sum over cells of t times the outer product of the cell's indicator of its margins' values (own)."""
    times = lambda v: np.bincount(own.ravel(), np.repeat(t * v[own].sum(axis=1), own.shape[1]), minlength=len(right))
    scale = 1 / np.maximum(np.bincount(own.ravel(), np.repeat(t, own.shape[1]), minlength=len(right)), 1e-300)
    x, rest = np.zeros(len(right)), right.copy()
    to = scale * rest
    rz = rest @ to
    enough = 1e-24 * rz
    # Margins' multipliers can all move against each other's: from zero the smallest of such solutions is found.
    for _ in range(200):
        if rz <= enough or rz == 0:
            break
        bent = times(to)
        curve = to @ bent
        if curve <= 1e-14 * (to @ (to / scale)):
            break
        a = rz / curve
        x, rest = x + a * to, rest - a * bent
        near = scale * rest
        rz, was = rest @ near, rz
        to = near + rz / was * to
    return x


def entropy_balance(docs: DataFrame, margins: dict[str, dict], iterations: int = 60) -> dict[str, dict]:
    """Multipliers by margin and value. docs: `size` and a column for each margin; margins: token targets by value.

    Newton's method on the dual sum(size * exp(rate)) - targets . multipliers, damped, from zero. A target of 0 has no finite multiplier: it
    goes to -50. Values without tokens keep 0.
    """
    at = [(m, v) for m, targets in margins.items() for v in targets]
    goal = np.array([max(margins[m][v], 0.0) for m, v in at])
    index = {key: i for i, key in enumerate(at)}
    lam = np.zeros(len(at))
    spark = docs.sparkSession
    cells = written(docs.groupBy(*margins).agg(F.sum("size").alias("__t")))
    for _ in range(iterations if at else 0):
        tilted, rate = cells, F.lit(0.0)
        for k, m in enumerate(margins):
            rows = [(v, float(lam[index[m, v]])) for v in margins[m]]
            now = spark.createDataFrame(rows, f"__v{k} {docs.schema[m].dataType.simpleString()}, __l{k} double")
            tilted = tilted.join(now, tilted[m].eqNullSafe(now[f"__v{k}"]))
            rate = rate + F.col(f"__l{k}")
        found = tilted.groupBy(*margins).agg(F.sum(F.col("__t") * F.exp(rate)).alias("__t")).collect()
        own = np.array([[index[m, c[m]] for m in margins] for c in found], np.int64).reshape(len(found), len(margins))
        t = np.array([c["__t"] for c in found], np.float64)
        sums = np.bincount(own.ravel(), np.repeat(t, len(margins)), minlength=len(at))
        grad = np.where(sums > 0, sums - goal, 0.0)
        if np.all(np.abs(grad) <= 1e-9 * np.maximum(goal, 1.0)):
            break
        lam = np.clip(lam + np.clip(_conjugate(own, t, -grad), -3.0, 3.0), -50.0, 50.0)
    return {m: {v: float(lam[index[m, v]]) for v in margins[m]} for m in margins}


def _copies(size: np.ndarray, rate: np.ndarray, times: np.ndarray, most: int = MOST) -> np.ndarray:
    """Copies of entries in order, of all their repeats together; the tokens that an entry's rounding owes or has too many go to the next ones."""
    out, owed = np.zeros(len(size), np.int64), 0.0
    for i, (n, r, m) in enumerate(zip(size.tolist(), rate.tolist(), times.tolist())):
        k = min(most * m, max(0, math.floor(r * m + (owed / n if n else 0.0) + 0.5)))
        owed += (r * m - k) * n
        out[i] = k
    return out


KEY = ("__id", "__h", "__n", "__x", "source")


def _named(docs: DataFrame) -> DataFrame:
    """docs with a row's identity: keyed(), and a hash of all columns but those that have none."""
    plain = [c.name for c in docs.schema if not any(k in c.dataType.simpleString() for k in ("map<", "variant"))]
    return keyed(docs).withColumn("__x", F.xxhash64(*plain))


def planned(docs: DataFrame) -> DataFrame:
    """Per distinct row: KEY, size, source_size, target, rate, times (how often it occurs), copies (of all its repeats together)."""
    slim = _named(docs).select(*KEY, words().alias("size")).groupBy(*KEY).agg(F.min("size").alias("size"), F.count("*").alias("times"))
    slim = written(slim.withColumn("tokens", F.col("size") * F.col("times")))
    sums = slim.groupBy("source").agg(F.sum("tokens").alias("size"), F.count("*").alias("n")).collect()
    order = sorted(sums, key=lambda r: (r.source is None, (r.source or "").encode()))
    sizes = [int(r["size"]) for r in order]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(order))]
    targets = dict(zip([r.source for r in order], capped_targets(sizes, weights, float(sum(sizes)))))
    lam = entropy_balance(slim.select("source", F.col("tokens").alias("size")), {"source": targets})["source"] if order else {}
    spark = docs.sparkSession
    rows = [(r.source, int(r["size"]), float(targets[r.source]), min(float(MOST), math.exp(lam[r.source])) if r["size"] else 1.0, max(1, -(-r.n // BUCKET))) for r in order]
    kind = docs.schema["source"].dataType.simpleString()
    plan = spark.createDataFrame(rows, f"__s {kind}, source_size long, target double, rate double, buckets int")
    # One row for each source, as it was just gathered: a broadcast join is left to the size that Spark sees.
    rated = slim.drop("tokens").join(plan, slim["source"].eqNullSafe(plan["__s"])).withColumn("bucket", F.pmod(F.xxhash64("__id", "__h", "__x", F.lit("mix")), F.col("buckets")))

    def fn(part: pa.Table) -> pa.Table:
        size, h, x, i = (part.column(c).combine_chunks() for c in ("size", "__h", "__x", "__id"))
        size = size.to_numpy(zero_copy_only=False)
        order = np.lexsort((x.to_numpy(zero_copy_only=False), i.fill_null(-1).to_numpy(zero_copy_only=False), h.to_numpy(zero_copy_only=False), -size))
        part = part.take(pa.array(order))
        copies = _copies(size[order], part.column("rate").to_numpy(), part.column("times").to_numpy())
        return part.append_column("copies", pa.array(copies, pa.int64())).select(cols)

    cols = [*KEY, "size", "source_size", "target", "rate", "times", "copies"]
    schema = f"__id {docs.schema['doc_id'].dataType.simpleString()}, __h long, __n int, __x long, source {kind}, size long, source_size long, target double, rate double, times long, copies long"
    return rated.groupBy("source", "bucket").applyInArrow(fn, schema)


#: Rows that one row becomes in one go; a hot row's are dealt out in such blocks.
BLOCK = 1000


def _repeated(rows: DataFrame, n: str) -> DataFrame:
    """Each row as often as its column n says, however often that is: first in blocks, which are shuffled."""
    dealt = rows.where(f"{n} > 0").withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / BLOCK))))
    dealt = dealt.repartition(*[c for c in KEY if c in rows.columns], "__b")
    left = F.least(F.lit(BLOCK), F.col(n) - F.col("__b") * BLOCK)
    return dealt.withColumn("__b", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop("__b")


def mixed(docs: DataFrame) -> DataFrame:
    """Per row: KEY, size, source_size, target, rate, copies. Repeats differ by one copy at most."""
    plan = written(planned(docs))
    once, more = plan.where("times = 1").drop("times"), plan.where("times > 1")
    base, odd = F.floor(F.col("copies") / F.col("times")), F.col("copies") % F.col("times")
    parts = F.array(F.struct(base.alias("copies"), (F.col("times") - odd).alias("k")), F.struct((base + 1).alias("copies"), odd.alias("k")))
    more = more.withColumn("__p", F.explode(parts)).withColumns({"copies": F.col("__p.copies"), "k": F.col("__p.k")}).drop("__p", "times")
    return once.unionByName(_repeated(more, "k").drop("k"))


def mixture(docs: DataFrame) -> DataFrame:
    """docs with each row as often as the mix takes it (0 to MOST times); all columns are kept."""
    docs, back = shielded(docs)
    plan = written(planned(docs).select(*[F.col(c).alias(f"{c}k") for c in KEY], F.col("times").alias("__times"), F.col("copies").alias("__c")).where("__c > 0"))
    d = _named(docs)
    on = d["source"].eqNullSafe(plan["sourcek"]) & d["__id"].eqNullSafe(plan["__idk"])
    for c in ("__h", "__n", "__x"):
        on = on & (d[c] == plan[f"{c}k"])
    found = d.join(plan, on).drop(*[f"{c}k" for c in KEY])
    once = found.where("__times = 1").withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c")))).select(*docs.columns)
    if not plan.where("__times > 1").limit(1).count():
        return back(once)
    # Repeats are equal: one of them stands for all.
    one = found.where("__times > 1").dropDuplicates(["__id", "__h", "__n", "__x", "source"])
    return back(once.unionByName(_repeated(one, "__c").select(*docs.columns)))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
