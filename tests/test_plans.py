"""Physical-plan shape of every registered query (the scale review as a test)."""

from dimwright.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

def test_plans_have_no_cartesian_products_or_python(spark):
    offenders = {}
    for name, fn in QUERIES.items():
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        bad = [p for p in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                           "FlatMapGroupsInPandas") if p in plan]
        if bad:
            offenders[name] = bad
    assert offenders == {}
