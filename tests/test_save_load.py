"""The comparison of a saved model with its reloaded self."""

from wardflow.plans import registry


def test_the_two_scorings_are_not_joined_by_broadcast(spark):
    out = registry.queries()["s09_model_save_load"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert out.first().max_abs_diff == 0
