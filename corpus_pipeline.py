"""A corpus pipeline over `documents`: language, exact copies, near copies, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
`documents`. run() writes each stage's rows as Parquet to the shared folder and reads them again as the next one's.

In every stage columns besides those of `documents` are kept, whatever their names; very long texts are read whole; an empty table gives no rows. What a
stage does with nulls, ties and repeated rows is said with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import exact_dedup, langid, mixing, sentencepiece_fst, simhash
from caseloom.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those with null, empty and letterless texts go. Null ids stay, and repeated rows stay or go together."""
    return langid.identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest id; a null id is smaller than any other, null and empty texts are equal. Of several rows with that id one stays."""
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash the one with the smallest id, or one without an id if none has one; texts without words are linked. Of several rows with that id one stays."""
    return simhash.simhash_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document 0 to 3 times, as the target weights of its source take it. Null sources are one source; repeated rows' copies are counted in all; texts without words come once."""
    return mixing.mixture(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of each document's whole text; a null text has none. Repeated rows have equal ids."""
    coded = sentencepiece_fst.encoded(docs.select("doc_id", "lang", "source", "text"), sentencepiece_fst.load(spark))
    return coded.select("doc_id", "lang", "source", F.size("token_ids").alias("n_tokens"), "token_ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", source_mix),
    ("sentencepiece", tokens),
]

#: Models and components are beyond SQL: tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
