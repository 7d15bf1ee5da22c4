"""Corpus pipeline: language ID, SimHash near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes
every stage's rows to the shared folder and reads them again for the next.
Null ids, repeated rows, empty tables and null, empty or long texts are handled
as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD_BPE, ship, table, vocabulary, written
from strata.llm.langid import UNDETERMINED, Tagger, identify, train_on
from strata.llm.packing import pack
from strata.llm.simhash import one_of_each_group
from strata.llm.substring import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text is rejected if no language reaches this mean probability over its letters.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts of no recognisable language; only the former if no row is labelled."""
    ship(spark)
    tagger = train_on(docs)
    if not tagger.languages:
        tagger = Tagger(["any"])  # the only language, so every text with a letter is in it
    rows = identify(docs, tagger, keep=COLUMNS)
    return rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 3-word shingles, at most 2 differing bits."""
    ship(spark)
    return one_of_each_group(docs.select(*COLUMNS), words=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of repeated windows of 35; a text that loses none is left as it is, one that loses all goes."""
    ship(spark)
    rows = remove_repeats(docs, window=35, keep=("lang", "source"), as_is=True)
    rows = rows.where("n_removed < n_words or n_words = 0")
    return rows.select("doc_id", F.col("kept").alias("text"), "lang", "source",
                       F.length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, with their ids."""
    ship(spark)
    return pack(docs, vocabulary(WORD_BPE))


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: The language network, the dedups and the packing have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
