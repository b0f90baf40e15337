"""Every registered training-data query against its SQL twin, on plain and on skewed tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import check_oracle
from docmart.llm import queries as llm

QUERIES = {name: q for name, q in entry.queries().items() if name in llm.QUERIES or name == "pipeline"}
SQL = entry.oracle_sql()
# Tested against brute force instead.
WITHOUT_SQL = {"op2_simhash", "op6_language_id", "op8_mixing", "op10_toxicity", "op11_bpe", "op12_importance", "op13_prefix_trie", "pipeline"}


def test_registry():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert sorted(int(n.split("_")[0][2:]) for n in llm.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    verdict, n = check_oracle.compare(spark, check_oracle.connect(sf), QUERIES[name], SQL.get(name), sf)
    assert verdict == ("rows only" if name in WITHOUT_SQL else "ok")
    assert n > 0


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf):
    """A third of all documents of one text, a third of all turns in one conversation, no ids twice."""
    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    docs = f"(SELECT * FROM '{sf}/documents.parquet' ORDER BY doc_id LIMIT 120)"
    con.execute(
        f"COPY (SELECT * FROM {docs} UNION ALL SELECT 100000 + i, d.* EXCLUDE doc_id FROM range(60) AS t(i),"
        f" (SELECT * FROM {docs} WHERE length(text) BETWEEN 800 AND 3000 ORDER BY doc_id LIMIT 1) AS d) TO '{target}/documents.parquet'"
    )
    con.execute(
        f"COPY (SELECT * FROM '{sf}/conversations.parquet' UNION ALL SELECT 77777, i, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END,"
        f" 'turn ' || i // 3 FROM range(400) AS t(i)) TO '{target}/conversations.parquet'"
    )
    for name in ("benchmark", "labels"):
        con.execute(f"COPY (SELECT * FROM '{sf}/{name}.parquet') TO '{target}/{name}.parquet'")
    return str(target)


@pytest.mark.parametrize("name", QUERIES)
def test_query_on_skewed_tables(spark, skewed, name):
    verdict, n = check_oracle.compare(spark, check_oracle.connect(skewed), QUERIES[name], SQL.get(name), skewed)
    assert verdict == ("rows only" if name in WITHOUT_SQL else "ok")
    assert n > 0


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", QUERIES)
def test_plan(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]
