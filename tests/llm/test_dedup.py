import hashlib
import random
from collections import defaultdict

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm import exact_dedup, simhash
from tests.conftest import SF

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string"


def rows(texts):
    return [(i, t, "en", "s", None, "x", "y") for i, t in texts]


@given(st.binary(max_size=40_000))
@settings(max_examples=30, deadline=None)
def test_chunks_join_to_the_text(data):
    assert b"".join(exact_dedup.chunks(data)) == data
    assert all(len(c) <= exact_dedup.MOST for c in exact_dedup.chunks(data))


def test_cuts_follow_content():
    rnd = random.Random(3)
    body = bytes(rnd.choices(b"abcdefgh ijkl.", k=60_000))
    a, b = set(exact_dedup.chunks(body)), set(exact_dedup.chunks(b"some words before it " + body))
    assert len(a & b) > len(a) * 0.7


def test_exact_groups_edges(spark):
    data = rows([(1, "Abc é"), (2, "aBC é"), (3, "abc É"), (4, None), (5, ""), (None, "solo"), (6, "x " * 60_000), (7, "X " * 60_000), (8, "twice"), (8, "twice"), (8, "other"), (None, None)])
    docs = spark.createDataFrame(data, DOCS)
    got = exact_dedup.exact_groups(docs).collect()
    want = defaultdict(list)
    for r in data:
        t = (r[1] or "").encode().lower()
        want[hashlib.sha256(t).hexdigest()].append(r[0])
    assert len(got) == len(data)
    for r in got:
        ids = want[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = sorted(((r.doc_id, r.text) for r in exact_dedup.exact_dedup(docs).collect()), key=str)
    assert [k[0] for k in kept] == [2, 3, 5, 7, 8, 8, None]
    assert exact_dedup.exact_dedup(docs).columns == docs.columns
    own = docs.withColumnsRenamed({"kept": "__id", "fp": "__rep"})
    for dedup in (exact_dedup.exact_dedup, simhash.simhash_dedup):
        assert dedup(own).columns == own.columns and {(r["__id"], r["__rep"]) for r in dedup(own).collect()} == {("x", "y")}
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.exact_dedup(empty).count() == 0


def test_clashing_digests_are_found(spark):
    docs = spark.createDataFrame(rows([(i, f"text {i}") for i in range(40)] + [(99, "text 7")]), DOCS)
    weak = (lambda c: hashlib.sha256(c).digest()[:1] if len(c) else b"", *exact_dedup.DIGESTS)
    got = exact_dedup.exact_groups(docs, (lambda c: b"k", *exact_dedup.DIGESTS)).where("group_size > 1").collect()
    assert sorted(r["__id"] for r in got) == [7, 99] and len(weak) == 4


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    s = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def brute_components(fps):
    """fps: (doc_id, fingerprint)"""
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: least[root(i)] for i, (d, _) in enumerate(fps)}


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = brute_components(fps)
    got = {r.doc_id: r for r in simhash.op7(spark, SF).collect()}
    assert {d: f"{f:016x}" for d, f in fps} == {d: r.fingerprint for d, r in got.items()}
    assert want == {d: r.component_id for d, r in got.items()}


def test_trie_links_with_hot_prefixes(spark):
    rnd = random.Random(1)
    base = rnd.getrandbits(64)
    fps = {rnd.getrandbits(64) for _ in range(100)} | {base}
    for _ in range(400):
        f = base if rnd.random() < 0.6 else rnd.choice(sorted(fps))
        for _ in range(rnd.choice([1, 1, 2, 2, 3, 4])):
            f ^= 1 << rnd.randrange(64)
        fps.add(f)
    fps |= {0, 3, 2**64 - 1}
    signed = lambda f: f - 2**64 if f >> 63 else f
    ids = [(signed(f), f) for f in fps]
    want = brute_components(ids)
    for limit in (8, 512):
        links = simhash.trie_links(spark.createDataFrame([(i,) for i, _ in ids], "fp long"), limit)
        got = {r.node: r.root for r in simhash.components(links).collect()}
        assert {i: got.get(i, i) for i, _ in ids} == want


def test_simhash_edges(spark):
    data = rows([(3, None), (2, ""), (9, "one two"), (8, "ONE  two"), (8, "ONE  two"), (None, "one\ttwo"), (None, "quite another text of words"), (5, "x " * 50_000)])
    docs = spark.createDataFrame(data, DOCS)
    got = {(r["__id"], r["__n"]): r.component_id for r in simhash.simhash_groups(docs).collect()}
    assert got[(3, -1)] == got[(2, 0)] == 2 and got[(9, 7)] == got[(8, 8)] == got[(None, 7)] == 8 and got[(None, 27)] is None
    kept = simhash.simhash_dedup(docs)
    assert sorted(((r.doc_id, r.text[:8]) for r in kept.collect()), key=str) == [(2, ""), (5, "x x x x "), (8, "ONE  two"), (None, "quite an")]
    assert simhash.simhash_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_only_bytes_of_repeated_digests_are_compared(spark):
    """And all of those, whichever document they are in, however small the filter."""
    rnd = random.Random(9)
    text = lambda: "".join(rnd.choices("abcdefgh ijkl.", k=6000))
    shared = text()
    docs = spark.createDataFrame(rows([(i, text()) for i in range(30)] + [(100 + i, text() + shared) for i in range(5)] + [(200, "short"), (201, "SHORT"), (202, None)]), DOCS)
    count, every = defaultdict(int), {}
    for r in docs.collect():
        for c in exact_dedup.chunks((r.text or "").encode().lower()):
            count[exact_dedup.DIGESTS[0](c)] += 1
            every[exact_dedup.DIGESTS[0](c)] = c
    again = {k for k, n in count.items() if n > 1}
    for bits in (1 << 24, 64):
        filled = exact_dedup.repeated_bits(exact_dedup.recipes(docs), 16, bits)
        got = {bytes(r["key"]): bytes(r.chunk) for r in exact_dedup.chunk_rows(docs, exact_dedup.DIGESTS[0], filled).distinct().collect()}
        assert again <= set(got) and all(every[k] == c for k, c in got.items()) and (bits == 64 or set(got) == again)
