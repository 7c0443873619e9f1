"""Listing rows made of the test tables."""

from stratamart.catalogue.stand_in import silver


def test_bounds_on_the_month_reach_below_the_choice_of_the_latest_row(spark, sf_dir):
    plan = silver(spark, sf_dir).where("month_key >= DATE'1998-01-01'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.rindex("Filter") and "trunc" in plan[plan.rindex("Filter"):].split("\n")[0]
