"""Plans under a key that holds a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratamart.operators.metrics import exact_quantile
from stratamart.operators.storage import bounded_broadcast
from stratamart.operators.temporal import as_of_join
from stratamart.plans import analysis

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def hot_facts(spark, n=60_000):
    """One host and month holds a third of the rows."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, numPartitions=8).select(
        F.col("id").alias("listing_id"),
        F.when(hot, 7).otherwise(F.col("id") % 500 + 100).alias("host_id"),
        F.when(hot, F.lit(dt.date(2020, 1, 1)))
        .otherwise(F.add_months(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 12).cast("int")))
        .alias("month"),
        (F.col("id") % 1000).cast("double").alias("price"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_temporal_join_splits_the_hot_host(spark, small_thresholds, how):
    facts = hot_facts(spark)
    versions = (
        facts.select("host_id").distinct()
        .select("host_id", F.lit(dt.date(2020, 1, 1)).alias("valid_from"),
                F.lit(None).cast("date").alias("valid_to"), F.lit("x").alias("v"))
    )
    joined = as_of_join(facts, versions, "host_id", "month", how, until=dt.date(2020, 12, 1))
    assert len(joined.collect()) == 60_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_median_of_a_hot_group_sees_counts_not_rows(spark):
    facts = hot_facts(spark)
    got = {r.host_id: r.m for r in exact_quantile(facts, ["host_id"], "price", "m").collect()}
    hot = sorted(float(i % 1000) for i in range(0, 60_000, 3))
    assert got[7] == (hot[9_999] + hot[10_000]) / 2
    plan = exact_quantile(facts, ["host_id"], "price", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan


def test_host_questions_have_no_per_host_row_lists(spark):
    """Hosts are reduced by aggregates that combine in the map tasks; no window over a host's rows."""
    facts = hot_facts(spark).select(
        "host_id", "listing_id", F.concat(F.lit("a"), F.col("listing_id") % 5).alias("lga_code"),
        F.lit(True).alias("has_availability"), F.lit(1).cast("decimal(29,4)").alias("est_revenue_30"),
    )
    plan = analysis.multi_listing_hosts(facts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Expand" not in plan and "distinct" not in plan.lower()
    medians = spark.createDataFrame([("a1", 1)], "lga_code string, median_mortgage_monthly int")
    areas = spark.createDataFrame([("a1", "A")], "lga_code string, lga_name string")
    plan = analysis.mortgage_coverage(facts, medians, areas)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect" not in plan


def test_a_million_values_inside_one_bucket_are_cut_again(spark):
    """Amounts within a thousandth of each other share a bucket; no ordered pass may see them all."""
    n = 1_000_000
    crowded = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.lit("a")).alias("k"),
        (F.lit(5_000_000) + F.col("id").cast("decimal(18,4)") / 250).cast("decimal(18,4)").alias("v"),
    )
    got = exact_quantile(crowded, ["k"], "v", "m")
    rows = {r.k: r.m for r in got.collect()}
    own = {None: range(0, n, 3), "a": [i for i in range(n) if i % 3]}
    for key, ids in own.items():
        middle = (ids[(len(ids) - 1) // 2] + ids[len(ids) // 2]) / 2
        assert rows[key] == pytest.approx(5_000_000 + middle / 250, abs=1e-9)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "ReusedExchange" in plan
    # the last window orders the values of a piece: far fewer than the group's
    windows = [line for line in plan.splitlines() if "Window [" in line and "value" in line]
    assert windows and all("piece" in line for line in windows)


def test_versions_are_not_broadcast_on_the_size_of_their_files(spark, tmp_path):
    """Histories pack to a few bytes a row; listed by month they would fill the driver."""
    versions = spark.range(300).selectExpr(
        "id AS host_id", "DATE'2000-01-01' AS valid_from", "CAST(NULL AS DATE) AS valid_to", "'x' AS name"
    )
    versions.write.parquet(str(tmp_path / "v"))
    versions = spark.read.parquet(str(tmp_path / "v"))
    facts = spark.range(600).selectExpr("id % 310 AS host_id", "add_months(DATE'2020-01-01', CAST(id % 12 AS INT)) AS month")
    found = []
    for spread in (True, False):
        joined = as_of_join(facts, versions, "host_id", "month", "left", dt.date(2020, 12, 1), "month", spread=spread)
        found.append(sorted((r.host_id, r.month, r.name or "") for r in joined.collect()))
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert found[0] == found[1] and len(found[0]) == 600 and sum(r[2] == "" for r in found[0]) > 0


def test_a_side_over_the_bound_is_not_broadcast_for_its_small_files(spark):
    large, other = spark.range(40).withColumnRenamed("id", "k"), spark.range(100).withColumnRenamed("id", "k")
    joined = other.join(bounded_broadcast(large, 10), "k")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in other.join(bounded_broadcast(large, 40), "k")._jdf.queryExecution().executedPlan().toString()
