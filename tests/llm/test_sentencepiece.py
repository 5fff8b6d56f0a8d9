import struct

import numpy as np
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom.llm import sentencepiece_fst as fst
from tests.conftest import SF

DATA = open(fst.MODEL, "rb").read()
T = fst.transducer(DATA)
LIB = sentencepiece.SentencePieceProcessor(model_proto=DATA)


def ids(text):
    return np.frombuffer(T.encode(text), "<i4").tolist()


def test_documents_match_the_library():
    for text in pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist():
        assert ids(text) == LIB.encode(text)
        assert T.decode(ids(text)) == text


@given(st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text_matches_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(text) == LIB.encode(text)
    assert T.decode(ids(text)) == text.replace("▁", " ")


@given(st.text(alphabet="abcdeinorst ing\n", max_size=80))
@settings(max_examples=600, deadline=None)
def test_merges_match_the_library(text):
    assert ids(text) == LIB.encode(text)


def test_edges(spark):
    for text in ["", " ", "   ", "a  b ", "\n\n", "a" * 5000, "\t x", "\x00", "日本語 テキスト", "🙂🙂"]:
        assert ids(text) == LIB.encode(text)
    rows = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (2, "Hello\nworld", "t")], "doc_id long, text string, token_digest string")
    got = fst.decoded(fst.encoded(rows, DATA), DATA).collect()
    assert [(r.token_ids, r.decoded) for r in got] == [([], ""), ([], ""), (LIB.encode("Hello\nworld"), "Hello\nworld")]
    assert fst.digested(rows.limit(0), DATA).count() == 0
    # A column that is there already is replaced, equal rows get equal results.
    again = fst.digested(rows.union(rows), DATA).select("token_digest.*").collect()
    assert {r.n_tokens for r in again if r.round_trip} == {0, len(LIB.encode("Hello\nworld"))}
    assert {r.token_ids[0] for r in fst.encoded(rows.where("text <> ''").withColumn("token_ids", F.lit("x")), DATA).collect()} == {LIB.encode("Hello\nworld")[0]}


def message(n, data):
    size, left = b"", len(data)
    while left > 127:
        size, left = size + bytes([left & 127 | 128]), left >> 7
    return bytes([n << 3 | 2]) + size + bytes([left]) + data


def piece(p, score, kind=fst.NORMAL):
    return message(1, message(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + bytes([3 << 3, kind]))


def own(kind, pieces, spec, fallback=False):
    """A model of ours, and the library's processor of it."""
    data = piece("<unk>", 0, fst.UNKNOWN) + piece("<s>", 0, fst.CONTROL) + piece("</s>", 0, fst.CONTROL) + b"".join(piece(f"<0x{b:02X}>", 0, fst.BYTE) for b in range(256 * fallback)) + b"".join(piece(*p) for p in pieces)
    data += message(2, bytes([3 << 3, kind]) + (bytes([35 << 3 & 127 | 128, 35 >> 4, 1]) if fallback else b"")) + message(3, spec)
    return fst.Transducer(data), sentencepiece.SentencePieceProcessor(model_proto=data)


RULES = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
SPEC = next(v for n, v in fst._fields(RULES.serialized_model_proto()) if n == 3)


@given(st.text(alphabet=st.one_of(st.characters(blacklist_categories=["Cs"]), st.sampled_from("Åﬁ①ＡＢ ｶﾞ\u0301e\t\u3000 ")), max_size=30))
@settings(max_examples=400, deadline=None)
def test_rewriting_rules_match_the_library(text):
    t, lib = own(fst.UNIGRAM, [("▁", -1.0), ("a", -2.0), ("b", -2.0)], SPEC)
    text = text.replace("▁", "")
    assert t.normalise(text) == lib.normalize(text)


@given(st.text(alphabet="ab c▁é", max_size=25), st.booleans(), st.booleans(), st.sampled_from([fst.UNIGRAM, fst.BPE]), st.booleans())
@settings(max_examples=600, deadline=None)
def test_small_models_match_the_library(text, prefix, squeeze, kind, fallback):
    """Scores that tie, pieces whose parts have lower scores than they, spaces inside pieces."""
    pieces = [("ab", -1.0), ("▁a", -1.0), ("aa", -0.5), ("aab", -0.25), ("bb", -1.0), ("▁▁", -3.0), ("ba▁", -2.5), ("abab", -0.125), ("a", -4.0), ("b", -4.5), ("▁", -5.0), ("é", -6.0)]
    t, lib = own(kind, pieces, bytes([3 << 3, prefix, 4 << 3, squeeze]), fallback)
    assert np.frombuffer(t.encode(text), "<i4").tolist() == lib.encode(text)


def test_unigram_takes_the_cheapest_path():
    model = piece("<unk>", 0, fst.UNKNOWN) + piece("▁a", -2) + piece("b", -1) + piece("ab", -1.5) + piece("▁", -1) + piece("▁ab", -4) + piece("a", -3)
    model += message(2, bytes([3 << 3, fst.UNIGRAM])) + message(3, bytes([3 << 3, 1, 4 << 3, 0]))
    t = fst.Transducer(model)
    assert np.frombuffer(t.encode("ab"), "<i4").tolist() == [4, 3]
    assert np.frombuffer(t.encode("az"), "<i4").tolist() == [1, 0]


@given(st.text(alphabet="abthe rn.,!*&0192é(\n'", max_size=60))
@settings(max_examples=400, deadline=None)
def test_chunk_boundaries_match_the_library(text):
    assert ids(text) == LIB.encode(text)
