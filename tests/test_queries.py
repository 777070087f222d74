"""Every registered query against its SQL, and the shape of the plans."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, _rows
from seqspark.plans import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    found = _rows(df.columns, df.collect())
    assert found
    if name in oracle_sql():
        cursor = db.execute(oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert found == _rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 8


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["cluster_top_primers", "primer_search", "extract_sequences", "consensus", "expression_stats",
                                  "primer_row_hits", "primer_row_overlap", "knn_graph", "anchor_align", "remove_divergent"])
def test_no_pairwise_joins(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_index_plan(spark):
    """The text is moved once by row; k-mers are shuffled once, already combined; top-n needs no sort."""
    plan = _plan(queries()["top_by_coverage"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "SortAggregate" not in plan
    above = plan.split("posexplode")[0]
    assert above.count("Exchange hashpartitioning") == 1
    assert "partial_count" in above


def test_group_limit_is_planned(spark):
    assert "WindowGroupLimit" in _plan(queries()["cluster_top_primers"](spark, SF))


def test_scan_reads_what_it_needs(spark):
    plan = _plan(inputs.genome(spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
