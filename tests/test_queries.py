"""A sample of the named queries against the SQL that states their results; all of them with FULL_CHECK=1."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
SAMPLE = [
    "agg_components", "agg_golden_record", "jn_name_exact", "jn_related", "agg_stats_daily", "dq_apply_verified",
    "mentions", "src_json_records", "snk_blacklist_csv",
]
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
CHOSEN = sorted(ORACLES) if os.environ.get("FULL_CHECK") else [n for n in SAMPLE if n in ORACLES]


def plain(value):
    if isinstance(value, bool):
        return int(value)
    return f"{value:.6g}" if isinstance(value, float) else value


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str([plain(row[names.index(c)]) for c in columns]) for row in cursor.fetchall())
    got = sorted(str([plain(row[c]) for c in columns]) for row in df.collect())
    assert got == want and got


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
