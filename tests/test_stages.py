"""Stage tables in buckets: the assembly of C20 joins them as they lie."""

from poolwright.operators import features as C
from poolwright.plans.stages import stage_tables
from poolwright.registry import PARKED
from poolwright.sources.fixtures import Fixtures


def test_assembly_of_stage_tables_has_no_exchange(spark, tmp_path):
    fx = Fixtures(spark, "/root/testdata/sf0.001", PARKED)
    inputs = C.feature_inputs(fx, PARKED)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = C.assemble(stage_tables(spark, inputs, "pw_stage", f"file://{tmp_path}", 8), PARKED)
        plan = staged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= len(C.INPUTS) - 1 and "Exchange" not in plan
        plain = C.assemble(inputs, PARKED)._jdf.queryExecution().executedPlan().toString()
        assert plain.count("hashpartitioning(company_id") >= 6  # what the buckets save
        assert staged.count() == fx.companies.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE IF EXISTS pw_stage CASCADE")
