"""Each stage of the pipeline against a plain version of what it decides."""

from collections import Counter, defaultdict

import sentencepiece

import corpus_pipeline as cp
from caseloom.llm import mixing, sentencepiece_fst
from caseloom.llm.common import written
from tests.conftest import SF
from tests.llm.test_dedup import brute_components, brute_fingerprint


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    extra = spark.createDataFrame([(10**6, "12 34 !!", "en", "src1", 8), (10**6 + 1, None, "en", "src1", 0), (10**6 + 2, "Some THING here now", "en", "src1", 19), (10**6 + 3, "some thing here NOW", "en", "src2", 19)], docs.schema)
    docs = written(docs.union(extra))
    frames = [docs]
    for name, stage in cp.STAGES:
        frames.append(written(stage(spark, frames[-1], SF)))
    rows = [f.collect() for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])

    # language: only texts without letters go
    assert {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]} == {10**6, 10**6 + 1} and len(rows[1]) == len(rows[0]) - 2
    # exact copies: the largest id of each text
    last = {}
    for r in rows[1]:
        key = r.text.encode().lower()
        last[key] = max(last.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(last.values())
    # near copies: the smallest id of each component
    comp = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in rows[2]])
    assert sorted(r.doc_id for r in rows[3]) == sorted(set(comp.values()))
    # mix: tokens by source come near the targets, no more than three copies
    size, taken, copies = Counter(), Counter(), Counter()
    for r in rows[3]:
        size[r.source] += len(r.text.encode().split())
    for r in rows[4]:
        taken[r.source] += len(r.text.encode().split())
        copies[r.doc_id] += 1
    names = sorted(size)
    target = dict(zip(names, mixing.capped_targets([size[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], sum(size.values()))))
    assert max(copies.values()) <= 3 and all(abs(taken[n] - target[n]) < 0.1 * target[n] + 30 for n in names)
    # tokens: the library's
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_fst.MODEL)
    text = {r.doc_id: r.text for r in rows[4]}
    assert len(rows[5]) == len(rows[4]) and all(list(r.token_ids) == lib.encode(text[r.doc_id]) and r.n_tokens == len(r.token_ids) for r in rows[5])


def test_an_empty_table_goes_through(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = written(stage(spark, docs, SF))
    assert docs.count() == 0


def test_run(spark):
    got = cp.run(spark, SF)
    assert defaultdict(int, got.dtypes)["token_ids"] == "array<int>" and got.count() > 0
