"""The contract queries of the operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometer.llm.ann import nearest_neighbours
from odometer.llm.bpe import encode_documents, token_digests
from odometer.llm.common import table
from odometer.llm.conversation_repair import repair, spoiled
from odometer.llm.exact_dedup import exact_duplicates
from odometer.llm.html_text import extract_pages
from odometer.llm.language_id import held_out, identify, train_on_open_rows
from odometer.llm.license_scan import scan_licences
from odometer.llm.manifest import manifest, manifest_digests
from odometer.llm.mixing import mix_plan
from odometer.llm.sentencepieces import encode_documents as encode_pieces
from odometer.llm.sentencepieces import piece_digests
from odometer.llm.sharding import shard_documents, topology
from odometer.llm.simhash import near_duplicates
from odometer.llm.url_filter import RULES, judge_urls, rule_rows


#: The tokenizer files of the contracts, at a path that is the same on every machine.
TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(file: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = identify(docs.select("doc_id", "text"), train_on_open_rows(docs), ["doc_id"])
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.*")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(encode_documents(table(spark, sf_dir, "documents"), tokenizer_path()))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_plan(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "source", "mix.copies")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_rows(spark, RULES))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return shard_documents(docs, topology(8), topology(9)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(conversations, spoiled(conversations))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest_digests(manifest(docs, found))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ann,
        op2_language_id,
        op3_bpe,
        op4_license_scan,
        op5_exact_dedup,
        op6_mixing,
        op7_url_filter,
        op8_html_text,
        op9_simhash,
        op10_sharding,
        op11_conversation_repair,
        op12_manifest,
        op13_sentencepiece,
    )
}
