"""Language identification by hierarchical discrimination.

A text becomes hashed counts of its one-, two- and three-letter grams (whole text, lower case, other than
letters as spaces). Linear support vector machines tell the language family first (one against the rest); within it,
one-versus-one machines tell related languages apart by votes, summed margins settling ties.

The models are fitted on a sample of the labelled documents outside the held-out quarter (CRC-32 of the
id modulo 4 is 2), about PER_LANG of each language, chosen by a hash of the id. Text and language are all that is
learned from. A null text, or one without letters, is "und" with score 0; so is every text if nothing could be
learned. Rows with a null id are not learned from and count as not held out. Repeated rows get equal results, very long texts are read whole, empty tables give no
rows. Columns whose names clash with the operator's own are kept by `identified`; `predicted` replaces one named `__lang`.

What goes to the driver is PER_LANG rows of DIM small numbers a language, and no more than MOST_LANGS languages, the most frequent ones, are learned (ties
by name), so that a column full of typing errors doesn't fill it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import shielded, table
from caseloom.llm.linear import sigmoid, svm

#: Hashed grams; documents of each language that are learned from, about.
DIM, PER_LANG = 4096, 400
#: Languages that are learned at most.
MOST_LANGS = 500
UND = "und"

#: Languages by family; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "semitic": "ar he mt",
    "indic": "bn gu hi mr ne pa ur",
}
FAMILY = {lang: name for name, langs in FAMILIES.items() for lang in langs.split()}

_LETTER = np.array([chr(c).isalpha() for c in range(0xD800)] + [False] * 0x800 + [chr(c).isalpha() for c in range(0xE000, 0x10000)])


def features(text: str) -> np.ndarray:
    """Square roots of the grams' shares: a vector of length one."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_LETTER[np.minimum(c, 0xFFFF)] | (c > 0xFFFF), c, np.uint32(32))
    c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]  # runs of other than letters are one space
    one = c * np.uint32(2654435761)
    two = (one[:-1] ^ (one[:-1] >> 15)) * np.uint32(2246822519) + c[1:] * np.uint32(3266489917)
    three = (two[:-1] ^ (two[:-1] >> 13)) * np.uint32(668265263) + c[2:] * np.uint32(374761393)
    counts = np.zeros(DIM, np.int64)
    for gram in (one, two, three):
        counts += np.bincount((gram ^ (gram >> 16)) >> 4 & (DIM - 1), minlength=DIM)
    return np.sqrt(counts / counts.sum(), dtype=np.float32)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    families: list[str]
    #: Machines of the families, a row each, and of the pairs (family, i, j of its languages).
    family_w: np.ndarray
    family_b: np.ndarray
    langs: list[list[str]]
    pairs: list[tuple[int, int, int]]
    pair_w: np.ndarray
    pair_b: np.ndarray
    #: A margin's slope in the score's logistic function.
    slope: float = 4.0

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        if not self.families:
            return UND, 0.0
        margins = self.family_w @ x + self.family_b
        f = int(np.argmax(margins))
        rest = np.delete(margins, f)
        score = float(sigmoid(self.slope * (margins[f] - rest.max()) / 2)) if len(rest) else 1.0
        langs = self.langs[f]
        votes, total = np.zeros(len(langs)), np.zeros(len(langs))
        own = [(k, i, j) for k, (g, i, j) in enumerate(self.pairs) if g == f]
        for k, i, j in own:
            m = float(self.pair_w[k] @ x + self.pair_b[k])
            votes[i if m >= 0 else j] += 1
            total[i] += m
            total[j] -= m
        best = max(range(len(langs)), key=lambda i: (votes[i], total[i]))
        for k, i, j in own:
            if best in (i, j):
                m = float(self.pair_w[k] @ x + self.pair_b[k])
                score = min(score, float(sigmoid(self.slope * (m if best == i else -m))))
        return langs[best], score


def fit(x: np.ndarray, y: list[str]) -> Model:
    """x: a row of features for each label in y."""
    langs = sorted(set(y))
    families = sorted({FAMILY.get(lang, lang) for lang in langs})
    grouped = [[lang for lang in langs if FAMILY.get(lang, lang) == f] for f in families]
    label = np.array(y, object)
    fam = np.array([FAMILY.get(lang, lang) for lang in y], object)
    machines = [svm(x, np.where(fam == f, 1.0, -1.0)) for f in families] if len(families) > 1 else [(np.zeros(DIM, np.float32), 0.0)] * len(families)
    pairs = [(f, i, j) for f, g in enumerate(grouped) for i in range(len(g)) for j in range(i + 1, len(g))]
    between = []
    for f, i, j in pairs:
        rows = (label == grouped[f][i]) | (label == grouped[f][j])
        between.append(svm(x[rows], np.where(label[rows] == grouped[f][i], 1.0, -1.0)))
    stack = lambda ms: (np.array([w for w, _ in ms], np.float32).reshape(-1, DIM), np.array([b for _, b in ms], np.float32))
    return Model(families, *stack(machines), grouped, pairs, *stack(between))


def _fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def held_out() -> Column:
    return F.coalesce(_fold() == 2, F.lit(False))


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fit on about per_lang documents of each language, of those not held out."""
    known = docs.where(F.col("lang").isNotNull() & (_fold() != 2) & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()}
    if not counts:
        return fit(np.zeros((0, DIM), np.float32), [])
    rate = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, per_lang / n))])
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)

    @F.arrow_udf("binary")
    def features_of(text: pa.Array) -> pa.Array:
        return pa.array([features(t).astype(np.float16).tobytes() for t in text.to_pylist()], pa.binary())

    rows = known.where(chance < rate[F.col("lang")]).select("lang", F.xxhash64("doc_id").alias("h"), features_of("text").alias("x")).collect()
    rows.sort(key=lambda r: (r.h, r.lang, r.x))
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.float16).reshape(-1, DIM).astype(np.float32)
    return fit(x, [r.lang for r in rows])


def predicted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with __lang, a struct of lang_pred and score."""
    model = model or learn(docs)

    @F.arrow_udf("lang_pred string, score double")
    def predict(text: pa.Array) -> pa.Array:
        got = [model.predict(features(t)) if has_letter(t) else (UND, 0.0) for t in (s.as_py() for s in text)]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["lang_pred", "score"])

    return docs.withColumn("__lang", predict(F.col("text")))


def identified(docs: DataFrame) -> DataFrame:
    """docs without those whose language can't be told ("und"); all columns are kept."""
    docs, back = shielded(docs)
    return back(predicted(docs).where(F.col("__lang.lang_pred") != UND))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predicted(docs).select("doc_id", held_out().alias("held_out"), "__lang.lang_pred", "__lang.score")
