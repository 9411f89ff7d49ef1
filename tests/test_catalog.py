"""Every query against its SQL, on the smallest tables."""

import pytest
from compare import connect, difference, spark_rows, sql_rows

from sievework.catalog import inputs as fx
from sievework.catalog.oracle import ORACLE_SQL
from sievework.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    assert difference(spark_rows(QUERIES[name](spark, SF)), sql_rows(sql, ORACLE_SQL[name])) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 142
    assert set(__spark_entry__.queries()) >= set(__spark_entry__.oracle_sql())


def test_inputs_reach_every_case(spark):
    evidence = QUERIES["rubric_evidence"](spark, SF).collect()
    fields = [c for c in evidence[0].asDict() if c != "doc_id"]
    assert all({r[f] for r in evidence} == {True, False} for f in fields)
    raw = {r["doc_id"]: r["text"] for r in fx.padded_texts(spark, SF).collect()}
    assert sum(r["stripped"] != raw[r["doc_id"]] for r in QUERIES["stripped_text"](spark, SF).collect()) > 20
    requests = QUERIES["person_requests"](spark, SF).count()
    assert 0 < requests < QUERIES["profile_trimmed"](spark, SF).count()
    assert fx.prepared_pages(spark, SF).groupBy("page_url").count().filter("count > 1").count() > 5
    leads = [r["s1_score"] for r in QUERIES["rubric_leads"](spark, SF).collect()]
    assert len(leads) == 142
