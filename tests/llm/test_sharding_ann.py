import zlib
from collections import Counter, defaultdict

import numpy as np

from caseloom.llm import ann, sharding
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string"


def check(rows, docs, shards=24):
    assert len(rows) == len(docs)
    slots, bytes_, groups = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r["size"]
        groups[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(s) == 1 for s in groups.values())
    return bytes_


def test_shards_are_even_and_whole(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = sharding.sharded(docs).collect()
    b = check(rows, docs.collect())
    mean = sum(b.values()) / 24
    assert max(b.values()) < 1.06 * mean and min(b.values()) > 0.94 * mean
    want = Counter((len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert want == Counter((r["size"], r.text_crc32) for r in rows)
    plan = sharding.op6(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_tree_against_one_in_memory(spark):
    """The same cuts as a tree that sorts each node's points by the widest dimension and cuts at the weighted quantile."""
    F = sharding.F
    docs = spark.createDataFrame([(i * i % 997, f"{i} " * (1 + i * 37 % 90), ["en", "de", None][i % 3], f"s{i % 5}", 1, 1, "x") for i in range(500)], DOCS)
    rows = docs.select("doc_id", "source", "lang", (F.octet_length("text") + 8).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("h"))
    points = sharding._points(rows)
    for shards in (2, 7):
        room = [1.0 + k % 3 for k in range(shards)]
        got = {r.h: r.shard for r in points.select("h", sharding.shard_tree(points, room).alias("shard")).collect()}
        want = {}

        def split(found, leaves, want=want, room=room):
            if len(leaves) == 1:
                want.update({p.h: leaves[0] for p in found})
                return
            spread = [(max(p[c] for p in found) - min(p[c] for p in found)) >> sharding.TIE if found else 0 for c in sharding.DIMS]
            dim = sharding.DIMS[spread.index(max(spread))]
            half = len(leaves) // 2
            low, high = sum(room[i] for i in leaves[:half]), sum(room[i] for i in leaves[half:])
            goal, below, at = sum(p.weight for p in found) * low / (low + high), 0, 0
            for c in sorted({p[dim] for p in found}):
                w = sum(p.weight for p in found if p[dim] == c)
                if below + w > goal:
                    at = c + 1 if below + w - goal < goal - below else c
                    break
                below, at = below + w, c + 1
            split([p for p in found if p[dim] < at], leaves[:half])
            split([p for p in found if p[dim] >= at], leaves[half:])

        split(points.collect(), list(range(shards)))
        assert got == want


def test_a_group_of_a_third(spark):
    data = [(i, "same text " * 30 if i % 3 == 0 else f"text {i} " * (5 + i % 50), "en", "s", 1, 1, "x") for i in range(600)]
    docs = spark.createDataFrame(data, DOCS)
    b = check(sharding.sharded(docs, 8).collect(), data, 8)
    rest = sorted(b.values())[:-1]
    assert max(rest) < 1.1 * min(rest)


def test_shard_edges(spark):
    data = [(1, None, None, None, None, 1, "x"), (None, "", "en", "s", 1, 1, "x"), (2, "a" * 200_000, "en", "s", 1, 1, "x"), (3, "b", "en", None, 1, 1, "x"), (3, "b", "en", None, 1, 1, "x")]
    docs = spark.createDataFrame(data, DOCS)
    check(sharding.sharded(docs).collect(), data)
    assert sharding.sharded(docs.limit(0)).count() == 0


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        keep = np.flatnonzero(ids != ids[i])
        order = keep[np.lexsort((ids[keep], -s[keep]))][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_recall_against_brute_force(spark):
    e = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.1')}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in e]), np.array([r.embedding for r in e], float)
    want, got = brute(ids, x), defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(e), block=700).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = sum(len({v for v, _ in want[q]} & {v for _, v, _ in got[q]}) for q in want)
    assert hit / (20 * len(want)) > 0.9 and set(got) == set(want)
    at = dict(zip(ids.tolist(), x))
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, 21)) and sorted(rows, key=lambda r: (-r[2], r[1])) == rows
        assert all(abs(s - at[q] @ at[v]) < 1e-9 for _, v, s in rows)


def test_codes_get_better_with_books():
    x = np.random.default_rng(1).normal(size=(800, 16))
    error = [((x - (m := ann.fit(x, books, 32)).decode(m.encode(x))) ** 2).sum() for books in (1, 4, 8)]
    assert error[0] > 2 * error[1] > 2 * error[2]


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, [1.0, inf]), (4, [1.0, None]), (None, [1.0, 1.0]), (5, [1.0]), (20, [1.0, 0.0]), (40, [0.0, 1.0])] + [(i, [1.0, 0.5]) for i in range(100, 160) if i % 20] + [(7, [0.9, 0.1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    got = defaultdict(list)
    for r in ann.nearest(df, block=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    same = [i for i in range(100, 160) if i % 20]
    assert got[20] == [(i, 1.0) for i in same[:20]] and got[40] == [(i, 0.5) for i in same[:20]]
    assert set(got) == {20, 40} and ann.nearest(df.limit(0)).count() == 0
    few = ann.nearest(df.where("vec_id in (20, 40, 7)")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few) == [(20, 1, 7), (20, 2, 40), (40, 1, 7), (40, 2, 20)]


def test_repeated_rows_of_a_query_and_a_candidate(spark):
    rows = [(20, [1.0, 0.0])] * 2 + [(20, [5.0, 0.0])] + [(7, [0.9, 0.1])] * 2 + [(i, [0.5 - i / 1000, 0.5]) for i in range(101, 140) if i % 20]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=8).orderBy("query_id", "rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 21)) and {r.query_id for r in got} == {20}
    assert [r.vec_id for r in got] == [7, 7, *[i for i in range(101, 140) if i % 20][:18]] and got[0].score == 0.9
