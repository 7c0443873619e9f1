"""Rules told from counts: one scan per table, and the same verdicts as the frames of failing rows."""

import re

import pytest
from pyspark.sql import functions as F

from stratamart.catalogue.queries import _planted
from stratamart.operators.tallies import null_counter, tallies
from stratamart.plans.checks import (
    ChecksFailed,
    FAR,
    failing_rows,
    require_all,
    rule_counts,
    rule_tallies,
)


def test_tallies_of_several_key_sets(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 5), (1, "a", 2, 7), (None, "b", None, 1), (1, None, 3, None)], "k int, t string, x int, v int"
    )
    found = tallies(df, [("k", "t"), ("t",)], ["x", "k"], {"top": F.col("v")})
    rows = {(r.key_set, r.k, r.t): (r.n, r.top, r[null_counter("x")]) for r in found.collect()}
    assert rows == {
        (0, 1, "a"): (2, 7, 1), (0, None, "b"): (1, 1, 1), (0, 1, None): (1, None, 0),
        (1, None, "a"): (2, 7, 1), (1, None, "b"): (1, 1, 1), (1, None, None): (1, None, 0),
    }
    assert null_counter("k") not in found.columns


def test_tallies_of_one_key_set_and_of_none(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.when(F.col("id") > 7, 1).alias("x"))
    one = tallies(df, [("k",)], ["x"])
    assert sorted((r.key_set, r.k, r.n, r[null_counter("x")]) for r in one.collect()) == [(0, 0, 4, 3), (0, 1, 3, 3), (0, 2, 3, 2)]
    none = tallies(df, [], ["x", "k"]).collect()
    assert [tuple(r) for r in none] == [(0, 10, 8, 0)]
    empty = tallies(df.where("k > 5"), [("k",), ("x",)])
    assert empty.count() == 0


def test_one_key_with_most_rows_combines_before_the_shuffle(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("t"))
    plan = tallies(df, [("k",), ("k", "t")])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "partial_count" in physical


def test_each_table_is_scanned_once_and_verdicts_agree(spark, sf_dir, tmp_path):
    planted = {}
    for name, df in _planted(spark, sf_dir).items():
        path = str(tmp_path / name)
        df.write.parquet(path)
        planted[name] = spark.read.parquet(path)
    for table, counted in rule_tallies(planted).items():
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"FileScan parquet", plan)) == 1, table
        assert len(re.findall(r"Exchange (hash|Single)", plan)) == 1, table
    counts = rule_counts(planted, FAR)
    told = {r.rule: r.failing for r in counts.collect()}
    assert len(told) == 26
    frames = failing_rows(planted, FAR)
    broken = {name for name, rows in frames.items() if not rows.isEmpty()}
    merged = {rule if rule in frames else next(f for f in frames if f.startswith(rule.split("(")[0] + "(")) for rule, n in told.items() if n}
    assert merged == broken
    for rule in told:
        if rule.startswith("unique") or rule in ("no overlap", "snapshots cover all months"):
            assert told[rule] == frames[rule].count(), rule
    with pytest.raises(ChecksFailed, match="no overlap: "):
        require_all(counts)
    require_all(counts.where("failing = 0"))
