"""Every query of this subpackage on the smallest tables: against its SQL, or
against plain Python."""

import collections
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from odometer.llm.oracle_sql import ORACLES
from odometer.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rel = con.sql(ORACLES[name])
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    order = [rel.columns.index(n) for n in names]
    ours = collections.Counter(tuple(r[n] for n in names) for r in df.collect())
    assert ours == collections.Counter(tuple(r[i] for i in order) for r in rel.fetchall())


def test_language_query(spark):
    rows = QUERIES["op2_language_id"](spark, SF_DIR)
    assert rows.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.97 * len(test)


@pytest.mark.parametrize("name, columns", [
    ("op1_ann", ["query_id", "rank", "vec_id", "score"]),
    ("op3_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    ("op13_sentencepiece", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    ("op6_mixing", ["doc_id", "size", "source_size", "target", "taken"]),
    ("op8_html_text", ["page_id", "url", "text", "n_chars"]),
    ("op9_simhash", ["doc_id", "fingerprint", "component_id"]),
    ("op10_sharding", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
])
def test_columns_and_rows(spark, name, columns):
    df = QUERIES[name](spark, SF_DIR)
    assert set(columns) <= set(df.columns)
    source = {"op1": "embeddings", "op8": "pages"}.get(name.split("_")[0], "documents")
    n = spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()
    assert df.count() == (n if name != "op1_ann" else -(-n // 20) * 20)
