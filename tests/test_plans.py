"""What single plans must contain; what none may contain is looked at where all queries run."""

from conftest import TINY

from chartmill.catalog import catalog


def test_scan_reads_what_is_used(spark):
    plan = catalog()["rate_and_count_per_group"].run(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan
    pushed = catalog()["append_rows"].run(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,200000.0)" in pushed and "EqualTo(o_orderstatus,F)" in pushed
