"""Every registered query against its DuckDB SQL on the smallest tables."""
import pytest

from conftest import SF_SMALL
from tessera.plans.oracle_check import compare, duckdb_conn
from tessera.plans.registry import oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF_SMALL, queries(), oracle_sql(), con)
    assert res["status"] in ("match", "rows-only"), res


def test_every_query_has_sql_or_is_declared_rows_only():
    rows_only = {"enrich_lookup"}
    missing = set(queries()) - set(oracle_sql())
    assert missing <= rows_only, missing


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.queries()) >= set(e.oracle_sql())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned_and_filters_pushed(spark):
    q = queries()
    plan = _plan(q["sql_query"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    plan = _plan(q["json_flatten"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in plan
    plan = _plan(q["geo_encode"](spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan and "Python" not in plan


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan_has_no_pair_enumeration_or_row_udf(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


@pytest.mark.parametrize("name", sorted(queries()))
def test_generated_methods_stay_jit_compilable(spark, name):
    dbg = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package
    df = queries()[name](spark, SF_SMALL)
    it = dbg.codegenStringSeq(df._jdf.queryExecution().executedPlan()).iterator()
    sizes = [0]
    while it.hasNext():
        sizes.append(it.next()._3().maxMethodCodeSize())
    assert max(sizes) < 8000, (name, max(sizes))
