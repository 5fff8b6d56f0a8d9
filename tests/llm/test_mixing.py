from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from caseloom.llm import mixing
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, copies string"


def test_targets_share_and_stop_at_the_cap():
    got = mixing.capped_targets([10, 1000, 1000], [5, 2, 1], 2010)
    assert got[0] == 30 and sum(got) == pytest.approx(2010) and got[1] == pytest.approx(2 * got[2])
    assert mixing.capped_targets([0, 5], [5, 2], 5) == [0, 5] and mixing.capped_targets([], [], 0) == []


def test_against_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    size = {i: len((r.text or "").encode().split()) for i, r in docs.items()}
    got = {r.doc_id: r for r in mixing.op3(spark, SF).collect()}
    assert {i: r["size"] for i, r in got.items()} == size
    per, taken = Counter(), Counter()
    for i, r in got.items():
        per[docs[i].source] += size[i]
        taken[docs[i].source] += r.taken
        assert r.taken % max(1, size[i]) == 0 and r.taken <= 3 * size[i]
    names = sorted(per, key=lambda s: s.encode())
    want = dict(zip(names, mixing.capped_targets([per[s] for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))], sum(per.values()))))
    smallest = defaultdict(lambda: 10**9)
    for i, r in got.items():
        s = docs[i].source
        assert r.target == pytest.approx(want[s]) and r.source_size == per[s]
        smallest[s] = min(smallest[s], size[i] or 10**9)
    for s in names:
        assert abs(taken[s] - want[s]) <= max(smallest[s], 0.02 * want[s])
    again = {r.doc_id: r.taken for r in mixing.op3(spark, SF).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_two_margins_meet(spark):
    rows = [(s, g, n) for s in "ab" for g in "xy" for n in (10, 20, 30)]
    docs = spark.createDataFrame(rows, "source string, lang string, size long")
    goals = {"source": {"a": 90.0, "b": 150.0}, "lang": {"x": 80.0, "y": 160.0}}
    lam = mixing.entropy_balance(docs, goals)
    import math

    rate = lambda s, g: math.exp(lam["source"][s] + lam["lang"][g])
    assert sum(n * rate(s, g) for s, g, n in rows if s == "a") == pytest.approx(90, rel=1e-6)
    assert sum(n * rate(s, g) for s, g, n in rows if g == "y") == pytest.approx(160, rel=1e-6)


def test_many_values_take_no_matrix(spark):
    docs = spark.range(3000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("source"), (F.col("id") % 7).cast("string").alias("lang"), (F.col("id") % 90 + 10).alias("size"))
    size = {r.source: r["size"] for r in docs.collect()}
    lam = mixing.entropy_balance(docs, {"source": {s: 1.5 * n for s, n in size.items()}})["source"]
    assert max(abs(v - 0.4054651) for v in lam.values()) < 1e-6


def test_repeated_rows_are_counted_in_all(spark):
    """A third of all rows are one row, some differ in a column only: the mixture has as many words as the plan says."""
    data = [(1, "one text of six words here", "en", "s1", 1, 1, "x")] * 2500 + [(1, "one text of six words here", "en", "s1", 1, 1, f"y{i}") for i in range(30)] + [(i, "w " * (i % 40 + 1), "en", "s2", 1, 1, "x") for i in range(500)]
    docs = spark.createDataFrame(data, DOCS)
    plan, out = mixing.mixed(docs).collect(), mixing.mixture(docs)
    assert len(plan) == len(data) and max(r.copies for r in plan) <= 3
    for source in ("s1", "s2"):
        target = next(r.target for r in plan if r.source == source)
        words = sum(r.copies * r["size"] for r in plan if r.source == source)
        assert abs(words - target) <= 0.01 * target + 6
        assert sum(len(r.text.split()) for r in out.where(F.col("source") == source).select("text").collect()) == words
    same = {r.copies for r in plan if r.source == "s1"}
    assert max(same) - min(same) <= 1 and {r.copies for r in out.where("copies LIKE 'y%'").select("copies").collect()} <= {f"y{i}" for i in range(30)}


def test_edges(spark):
    data = [(1, None, "en", None, None), (2, "a b c", None, "s1", 3), (2, "a b c", None, "s1", 3), (None, "d e", "en", "s1", 1), (None, "f", "en", None, 1), (5, "w " * 30_000, "en", "s2", 1), (6, " \t", "en", "s2", 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in data], DOCS)
    got = mixing.mixed(docs).collect()
    assert len(got) == 7 and {r["size"] for r in got if r["__id"] == 1} == {0}
    out = mixing.mixture(docs)
    assert out.columns == docs.columns and all(r.doc_id in (1, 2, None, 5, 6) for r in out.collect())
    own = docs.withColumnsRenamed({"copies": "__x", "size": "__c"})
    assert mixing.mixture(own).columns == own.columns and {(r["__x"], r["__c"]) for r in mixing.mixture(own).collect()} == {("x", 1)}
    empty = docs.limit(0)
    assert mixing.mixed(empty).count() == 0 and mixing.mixture(empty).count() == 0
