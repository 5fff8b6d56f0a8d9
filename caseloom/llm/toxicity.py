"""Toxicity by classifier chains.

Categories are predicted one after another; a category's linear model sees the text's features and the probabilities of the
categories before it. In training those come from models that haven't seen the document (out-of-fold), as they will in use. The labels only say toxic or
not, so what kind a toxic document is of is told by its evidence: the chain is abusive (labelled toxic, with a whole word of abuse), veiled (labelled toxic,
with nothing but parts of words that tell), severe (labelled toxic, with SEVERE terms or more), toxic (the label). The terms are not a given list:
they are the words, and beginnings and ends of words, that labelled toxic documents have far more often than others. Parts of
words stand for compounds each of which is rare. Number and kind of a text's terms are no features: a category has to be predicted for documents without a label.

Fitted on at most PER_CLASS labelled documents of each class, those with the smallest hashes of their ids (of several rows with one id one is
taken); everything else is by the whole text of all documents. Features: the share of each telling word or part (all of them: the least number of documents
is the same for a language with few). The threshold is the lowest whose out-of-fold precision is PRECISION, or else the best by F1.

Null and empty texts have no words and get the models' base rates. Documents with contradicting labels, null labels or ids aren't
learned from. Without both classes nothing can be learned: all probabilities are 0. Repeated rows get equal results, very long texts are read whole, empty tables
give no rows. A column named `toxicity` that is there already is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import map_slices, table, written
from caseloom.llm.linear import logistic_sparse, sigmoid

CHAIN = ("abusive", "veiled", "severe", "toxic")
PER_CLASS, FOLDS, PRECISION = 3000, 3, 0.97
#: A word's or part's least number of documents of the class it tells, and least z-score of its difference; how much larger its share of the
#: words is there if a term; terms that make a text severe.
LEAST, Z, ODDS, SEVERE = 5, 5.0, 8.0, 3
#: Lengths of parts. Longer ones count by the part they begin or end with.
PARTS = range(4, 8)

_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def units(word: str) -> list[str]:
    """The word, its beginnings ("abcd-") and ends ("-abcd"); a word's letters are never "-"."""
    inner = [n for n in PARTS if n < len(word)]
    return [word, *(f"{word[:n]}-" for n in inner), *(f"-{word[-n:]}" for n in inner)]


def _within(unit: str) -> list[str]:
    """The parts that each word with this unit has as well."""
    body = unit.strip("-")
    inner = [n for n in PARTS if n < len(body)]
    heads = [] if unit[0] == "-" else [f"{body[:n]}-" for n in inner]
    return heads + ([] if unit[-1] == "-" else [f"-{body[-n:]}" for n in inner])


def telling(z: dict[str, float]) -> list[str]:
    """Without words and parts that a more telling part stands for, and parts that say no more than a longer one does."""
    out = set(z)
    for u in z:
        for part in _within(u):
            if part in z and (z[part] > 0) == (z[u] > 0):
                out.discard(u if abs(z[part]) > abs(z[u]) else part)
    return sorted(out, key=lambda u: (-abs(z[u]), u))


@dataclass
class Model:
    vocabulary: dict[str, int] = field(default_factory=dict)
    terms: frozenset[str] = frozenset()
    #: Of each category in the chain: weights of the features and earlier probabilities, the bias last.
    weights: list[np.ndarray] = field(default_factory=list)
    threshold: float = 2.0

    def __post_init__(self) -> None:
        least = PARTS[0]
        self.heads = frozenset(u[:least] for u in self.vocabulary if u[-1] == "-")
        self.tails = frozenset(u[-least:] for u in self.vocabulary if u[0] == "-")

    @property
    def width(self) -> int:
        return len(self.vocabulary)

    def features(self, counts: Counter) -> tuple[list[int], list[float], int, int]:
        """Places and values of the features that are not 0; the numbers of terms, and of those that are whole words."""
        found: Counter = Counter()
        terms, whole, size = 0, 0, max(1, sum(counts.values()))
        least = PARTS[0]
        for w, n in counts.items():
            # Most words have no part of the vocabulary: they are known by their first and last letters.
            if w in self.vocabulary or w[:least] in self.heads or w[-least:] in self.tails:
                has = [u for u in units(w) if u in self.vocabulary]
                for u in has:
                    found[u] += n
                terms += n if not self.terms.isdisjoint(has) else 0
                whole += n if w in self.terms else 0
        return [self.vocabulary[u] for u in found], np.log1p([100.0 * n / size for n in found.values()]).tolist(), terms, whole

    def predict(self, found: list[tuple[list[int], list[float], int, int]]) -> np.ndarray:
        """Probabilities (rows, categories) down the chain."""
        row, col, val = _triples(found)
        done = np.zeros((len(found), 0))
        for w in self.weights:
            z = np.bincount(row, val * w[col], minlength=len(found)) + done @ w[self.width : -1] + w[-1]
            done = np.hstack([done, sigmoid(z)[:, None]])
        return done


def _triples(found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
    return row, np.array([c for f in found for c in f[0]], np.int64), np.array([v for f in found for v in f[1]], np.float64)


def _labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """text, toxic, h of the sample."""
    agreed = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    agreed = agreed.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit("toxicity")).alias("h"))
    picked = [agreed.where(F.col("toxic") == c).orderBy("h").limit(per_class) for c in (0, 1)]
    # At most 2 * per_class rows of three numbers: bounded, so broadcast.
    found = docs.select("doc_id", "text").join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    return found.groupBy("doc_id", "toxic", "h").agg(F.min("text").alias("text")).select("text", "toxic", "h")


def kinds_of(toxic: np.ndarray, terms: np.ndarray, whole: np.ndarray) -> dict[str, np.ndarray]:
    """The categories of labelled documents."""
    toxic = toxic > 0
    return {"abusive": toxic & (whole > 0), "veiled": toxic & (whole == 0) & (terms > 0), "severe": toxic & (terms >= SEVERE), "toxic": toxic}


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    def units_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic, unit, ppm = [], [], []
        for t, x in zip(batch["toxic"].to_pylist(), batch["text"]):
            words, n = Counter(tokens(x.as_py())), Counter()
            for w, k in words.items():
                for u in units(w):
                    n[u] += k
            size = sum(words.values())
            toxic += [t] * len(n)
            unit += n
            ppm += [k * 1_000_000 // size for k in n.values()]
        return pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(unit, pa.string()), pa.array(ppm, pa.int64())], names=["toxic", "unit", "ppm"])

    sample = written(_labelled(docs, labels, per_class))
    size = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n, p = size.get(0, 0), size.get(1, 0)
    if not n or not p:
        return Model()
    seen = map_slices(sample.select("toxic", "text"), units_of, "toxic int, unit string, ppm bigint").groupBy("unit")
    seen = seen.agg(F.sum("toxic").alias("p"), F.count("*").alias("all"), F.sum(F.col("toxic") * F.col("ppm")).alias("p_ppm"), F.sum("ppm").alias("ppm")).withColumn("n", F.col("all") - F.col("p"))
    share = F.col("all") / (p + n)
    more = F.col("p") / p - F.col("n") / n
    # With the correction for continuity: few documents tell less than the normal law says.
    z = F.signum(more) * F.greatest(F.abs(more) - 0.5 * (1 / p + 1 / n), F.lit(0.0)) / F.sqrt(share * (1 - share + 1e-6) * (1 / p + 1 / n))
    words = {r.unit: r for r in seen.withColumn("z", z).where((F.col("z") >= Z) & (F.col("p") >= LEAST) | (F.col("z") <= -Z) & (F.col("n") >= LEAST)).collect()}
    kept = telling({u: r.z for u, r in words.items()})
    odds = lambda r: ((r.p_ppm + 1000) / (p + 1)) / ((r.ppm - r.p_ppm + 1000) / (n + 1))
    model = Model({u: i for i, u in enumerate(kept)}, frozenset(u for u in kept if odds(words[u]) >= ODDS))

    @F.arrow_udf("at array<int>, value array<double>, n_terms int, n_whole int")
    def features_of(texts: pa.Array) -> pa.Array:
        found = [model.features(Counter(tokens(x.as_py()))) for x in texts]
        kinds = (pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32(), pa.int32())
        return pa.StructArray.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names=["at", "value", "n_terms", "n_whole"])

    rows = sample.select("toxic", "h", features_of("text").alias("x")).select("toxic", "h", "x.*").collect()
    rows.sort(key=lambda r: (r.h, r.toxic, r.at, r.value))
    row, col, val = _triples([(r.at, r.value) for r in rows])
    y = kinds_of(*(np.array([r[c] for r in rows]) for c in ("toxic", "n_terms", "n_whole")))
    fold = np.array([r.h % FOLDS for r in rows])
    for k, category in enumerate(CHAIN):
        t = y[category].astype(np.float64)
        width = model.width + k
        out = np.full(len(rows), t.mean())
        for f in range(FOLDS):
            if (fold == f).any() and len(set(t[fold != f])) == 2:
                w = logistic_sparse(row, col, val, width, t, l2=0.3, weight=(fold != f).astype(np.float64))
                z = np.bincount(row, val * w[col], minlength=len(rows)) + w[-1]
                out[fold == f] = sigmoid(z[fold == f])
        model.weights.append(logistic_sparse(row, col, val, width, t, l2=0.3))
        row, col, val = np.append(row, np.arange(len(rows))), np.append(col, np.full(len(rows), width)), np.append(val, out)
    order = np.argsort(-out, kind="stable")
    truth = y["toxic"][order]
    hits, tried = np.cumsum(truth), np.arange(1, len(truth) + 1)
    last = np.append(out[order][1:] < out[order][:-1], True)
    precise = np.flatnonzero((hits / tried >= PRECISION) & last)
    at = precise[-1] if len(precise) else int(np.argmax(np.where(last, 2 * hits / (tried + truth.sum()), -1)))
    nxt = out[order][at + 1] if at + 1 < len(out) else 0.0
    model.threshold = float((out[order][at] + nxt) / 2)
    return model


def with_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `toxicity`, a struct: probability of each category, toxic, and the terms found."""

    @F.arrow_udf("p_abusive double, p_veiled double, p_severe double, p_toxic double, toxic boolean, n_terms int")
    def score(texts: pa.Array) -> pa.Array:
        found = [model.features(Counter(tokens(x.as_py()))) for x in texts]
        p = model.predict(found) if model.weights else np.zeros((len(found), len(CHAIN)))
        cols = [pa.array(p[:, k]) for k in range(len(CHAIN))]
        cols += [pa.array(p[:, -1] >= model.threshold), pa.array([f[2] for f in found], pa.int32())]
        return pa.StructArray.from_arrays(cols, names=[*(f"p_{c}" for c in CHAIN), "toxic", "n_terms"])

    return docs.withColumn("toxicity", score(F.col("text")))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_toxicity(docs, learn(docs, table(spark, sf_dir, "labels"))).select("doc_id", "toxicity.*")
