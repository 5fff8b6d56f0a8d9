"""Approximate nearest neighbours by additive quantisation.

A vector is encoded as the sum of one full-dimensional codeword from each codebook, found by beam search over
the residuals; its norm, and its reconstruction's, are stored. A query looks its inner products with all codewords up once;
a candidate's score is a sum of table entries, corrected by the stored norms. The best share of each block is ranked again by the exact inner
product in double precision.

The codebooks are fitted (residual k-means, then least squares over beam-search codes) on at most SAMPLE distinct vectors, those with the
smallest hashes of their ids; every vector is indexed. Candidates and queries are dealt into blocks by hash; each pair of
blocks is a task of bounded size, and emits its own nearest k for each query. Equal vectors in a block are one
entry that knows the k + 1 smallest of its ids, which are all that can be among the k nearest, ties going to smaller ids.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no part;
nor do rows without an id. Rows with the query's id are its own; several are one query, that with the smallest vector. Repeated candidates are candidates
each. Empty tables give no rows.

Every query meets every candidate's code (a twentieth of the square), in blocks; the README has measured figures of its growth.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import table, written

#: Codebooks, codewords in each, partial codes that beam search keeps, vectors fitted on.
BOOKS, WORDS, BEAM, SAMPLE = 16, 128, 4, 4096
#: Rows in a block of candidates or queries, about; share of a block (and least number) ranked again exactly.
BLOCK, SHARE, LEAST = 4096, 0.06, 128
K, EVERY = 20, 20


@dataclass
class Codebooks:
    words: np.ndarray  # (books, words, dimensions)

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes (n, books) by beam search: the beam's partial sums nearest to x go on to the next book."""
        books, k, d = self.words.shape
        out = np.zeros((len(x), books), np.uint8)
        norms = (self.words**2).sum(axis=2)
        for at in range(0, len(x), 512):
            part = x[at : at + 512].astype(np.float32)
            n = len(part)
            residual, cost = part[:, None, :], np.zeros((n, 1), np.float32)
            codes = np.zeros((n, 1, 0), np.uint8)
            for b in range(books):
                gain = norms[b] - 2 * (residual.reshape(-1, d) @ self.words[b].T).reshape(n, -1, k)
                total = (cost[:, :, None] + gain).reshape(n, -1)
                keep = min(beam, total.shape[1])
                best = np.argpartition(total, keep - 1, axis=1)[:, :keep] if keep < total.shape[1] else np.tile(np.arange(keep), (n, 1))
                row, word = best // k, best % k
                lines = np.arange(n)[:, None]
                cost = total[lines, best]
                codes = np.concatenate([codes[lines, row], word[:, :, None].astype(np.uint8)], axis=2)
                residual = residual[lines, row] - self.words[b][word]
            out[at : at + n] = codes[np.arange(n), cost.argmin(axis=1)]
        return out

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.words[b][codes[:, b]] for b in range(len(self.words)))


def _means(x: np.ndarray, k: int, rnd: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rnd.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        count = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[rnd.integers(len(x), size=k)])
    return centres.astype(np.float32)


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 2, seed: int = 5) -> Codebooks:
    rnd = np.random.default_rng(seed)
    residual, made = x.astype(np.float32), []
    for _ in range(books):
        c = _means(residual, words, rnd)
        own = ((c**2).sum(axis=1) - 2 * residual @ c.T).argmin(axis=1)
        residual = residual - c[own]
        made.append(c)
    model = Codebooks(np.stack(made))
    for _ in range(rounds):
        # All codebooks at once: least squares of x on the indicator of each code, drawn to the present words.
        codes = model.encode(x) + (np.arange(books) * words)[None, :]
        gram, right = np.zeros((books * words,) * 2), np.zeros((books * words, x.shape[1]))
        for i in range(books):
            np.add.at(right, codes[:, i], x)
            for j in range(books):
                np.add.at(gram, (codes[:, i], codes[:, j]), 1.0)
        pull = 1.0
        now = model.words.reshape(books * words, -1)
        model = Codebooks(np.linalg.solve(gram + pull * np.eye(books * words), right + pull * now).astype(np.float32).reshape(books, words, -1))
    return model


def usable(rows: DataFrame) -> DataFrame:
    """id, v (array<double>) of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & good)
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (most.d if most else -1))


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(n, -1)


def _packed(model: Codebooks, k: int):
    def pack(part: pa.Table) -> pa.Table:
        """A block as one row: its distinct vectors, their codes and length correction, and the smallest ids of each."""
        ids, x = part.column("id").to_numpy(), _matrix(part.column("v"), part.num_rows)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order])
        _, first, own = np.unique(x.view(f"V{x.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        held = np.argsort(own, kind="stable")
        start = np.searchsorted(own[held], np.arange(len(first)))
        nth = np.arange(len(held)) - start[own[held]]
        held = held[nth <= k]
        count = np.bincount(own[held], minlength=len(first))
        x = x[first]
        codes = model.encode(x)
        norm = np.linalg.norm(x, axis=1) / np.maximum(np.linalg.norm(model.decode(codes), axis=1), 1e-12)
        row = {"cb": part.column("cb")[:1], "n": [len(x)], "x": [x.tobytes()], "codes": [codes.tobytes()], "norm": [norm.astype(np.float32).tobytes()], "ids": [ids[held].tobytes()], "held": [count.astype(np.int32).tobytes()]}
        return pa.table({c: pa.chunked_array([pa.array(v)]) if isinstance(v, list) else v for c, v in row.items()}).cast(_PACK)

    return pack


_PACK = pa.schema([("cb", pa.int64()), ("n", pa.int64()), ("x", pa.binary()), ("codes", pa.binary()), ("norm", pa.binary()), ("ids", pa.binary()), ("held", pa.binary())])


def _pack_queries(part: pa.Table) -> pa.Table:
    x = _matrix(part.column("v"), part.num_rows)
    return pa.table({"qb": part.column("qb")[:1], "q_ids": pa.array([part.column("id").to_numpy().tobytes()], pa.binary()), "q": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())})


def _search(model: Codebooks, k: int, share: float, least: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            c = {name: left.column(name)[0].as_py() for name in ("n", "x", "codes", "norm", "ids", "held")}
            n = c["n"]
            x = np.frombuffer(c["x"], np.float64).reshape(n, -1)
            codes = np.frombuffer(c["codes"], np.uint8).reshape(n, -1).astype(np.int64)
            norm, ids = np.frombuffer(c["norm"], np.float32), np.frombuffer(c["ids"], np.int64)
            ends = np.cumsum(np.frombuffer(c["held"], np.int32))
            starts = np.concatenate([[0], ends[:-1]])
            low = ids[starts]
            q_ids = np.frombuffer(right.column("q_ids")[0].as_py(), np.int64)
            q = np.frombuffer(right.column("q")[0].as_py(), np.float64).reshape(len(q_ids), -1)
            again = min(n, max(least, k + 1, int(share * n)))
            for at in range(0, len(q), 256):
                part = q[at : at + 256].astype(np.float32)
                score = np.zeros((len(part), n), np.float32)
                for b in range(codes.shape[1]):
                    score += np.take(part @ model.words[b].T, codes[:, b], axis=1)
                score *= norm
                best = np.argpartition(-score, again - 1, axis=1)[:, :again] if again < n else np.tile(np.arange(n), (len(part), 1))
                for i, rows in enumerate(best):
                    exact = np.einsum("rd,d->r", x[rows], q[at + i])
                    order = np.lexsort((low[rows], -exact))[: k + 1]
                    rows, exact = rows[order], exact[order]
                    found = np.concatenate([ids[starts[r] : ends[r]] for r in rows])
                    value = np.repeat(exact, ends[rows] - starts[rows])
                    other = found != q_ids[at + i]
                    found, value = found[other], value[other]
                    order = np.lexsort((found, -value))[:k]
                    out.append((np.full(len(order), q_ids[at + i]), found[order], value[order]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return search


def nearest(rows: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose vec_id is divisible by `every`."""
    good = written(usable(rows))
    n, asks = good.count(), good.where(F.col("id") % every == 0).count()
    sample = good.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow()
    x = np.unique(_matrix(sample.column("v"), sample.num_rows), axis=0) if sample.num_rows else np.zeros((1, 1))
    model = fit(x)
    blocks, asked = max(1, -(-n // block)), max(1, -(-asks // block))
    deal = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("long")
    index = good.withColumn("cb", deal("c", blocks)).groupBy("cb").applyInArrow(_packed(model, k), "cb long, n long, x binary, codes binary, norm binary, ids binary, held binary")
    asked_rows = good.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = asked_rows.withColumn("qb", deal("q", asked)).groupBy("qb").applyInArrow(_pack_queries, "qb long, q_ids binary, q binary")
    # Every pair of blocks once; a packed block travels once for each block of the other side.
    left = written(index).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asked - 1).cast("long"))))
    right = written(queries).withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInArrow(_search(model, k, share, least), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
