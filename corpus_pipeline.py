"""A training corpus from raw documents: language, exact copies, near copies,
mixture, tokens.  Each stage calls one operator of ``odometer.llm``, works on
all rows that the stage before it kept, and is stored before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odometer.llm.bpe import encode_documents, token_digests
from odometer.llm.common import stash, table
from odometer.llm.exact_dedup import drop_exact_duplicates
from odometer.llm.language_id import drop_unidentified
from odometer.llm.mixing import mixed_documents
from odometer.llm.queries import tokenizer_path
from odometer.llm.simhash import drop_near_duplicates


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go."""
    return drop_unidentified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return drop_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (3-word shingles, 3 bits) the smallest
    doc_id stays."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it; the document in
    which a budget ends is cut there, to the word."""
    return mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per kept document and pass: doc_id, ids, n_tokens and digests of
    the ids and of the decoded text."""
    encoded = encode_documents(docs, tokenizer_path())
    return token_digests(encoded, "ids")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

#: Trained classification, hashing by seed and tokenization aren't SQL; tests
#: hold every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
