"""Every registered query against its DuckDB oracle on the smallest tables,
the way the driver's correctness gate compares them."""

import collections
import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from odometer.plans.contract import QUERIES
from odometer.plans.oracle_sql import ORACLES

SF_DIR = os.environ.get("ODOMETER_TEST_SF_DIR", "/root/testdata/sf0.001")
DUCK_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
TABLES = ("events", "supplier")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return f"{type(v).__name__}:{v}"


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    oracle_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for col, spark_type in df.dtypes:
        assert oracle_types[col] == DUCK_TYPE.get(spark_type, spark_type.upper()), (col, spark_type)
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(list(rel.columns), orows)


def test_entry_is_non_empty(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["report_date", "vehicle_id"]


HOSTILE = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.mark.parametrize(
    "name", ["health_transitions", "unprofitable_vehicles", "profitability_report", "utilization_upsert"]
)
def test_query_matches_oracle_without_aqe_or_broadcasts(spark, con, name):
    """Results must not depend on AQE re-planning, exchange reuse or join choice."""
    saved = {k: spark.conf.get(k) for k in HOSTILE}
    for k, v in HOSTILE.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES[name](spark, SF_DIR)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    rel = con.sql(ORACLES[name])
    assert _bag(df.columns, rows) == _bag(list(rel.columns), rel.fetchall())
