"""Positions, change logs, overlapping pairs, gaps between months and sketches, against plain Python."""

import datetime as dt
import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from stratamart.operators.history import changes_from_history, merge_changes
from stratamart.operators.metrics import with_changes
from stratamart.operators.ordering import numbered
from stratamart.operators.quality import overlapping_pairs
from stratamart.operators.sketches import month_sketches, rank_error, trailing_quantile


def month(n):
    return dt.date(2020 + n // 12, n % 12 + 1, 1)


def test_positions_follow_the_order_in_any_number_of_ranges(spark):
    pick = random.Random(1)
    rows = [(i, pick.choice([None, "a", "b", "ü"]), pick.randrange(50)) for i in range(700)]
    df = spark.createDataFrame(rows, "i int, k string, v int").repartition(7)
    order = [F.col("k").asc_nulls_first(), F.col("v").desc(), F.col("i")]
    found = {r.i: r.position for r in numbered(df, *order, start=1).collect()}
    wanted = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), -r[2], r[0]))
    assert [found[r[0]] for r in wanted] == list(range(1, 701))
    assert numbered(df.where("i < 0"), *order).count() == 0
    same = numbered(spark.range(300).select(F.lit(1).alias("x")), F.col("x"), name="at")
    assert sorted(r.at for r in same.collect()) == list(range(300))


def test_no_task_of_a_numbering_sorts_all_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    plan = numbered(df, F.col("id"))._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "count(1)" in window and "id#" not in window.splitlines()[0]


def log_by_hand(rows):
    out = []
    for key, own in groupby(sorted(rows, key=lambda r: (r[0], r[1])), key=lambda r: r[0]):
        runs = [next(run) for _, run in groupby(own, key=lambda r: r[2:])]
        out += [(key, *a[2:], a[1], b and b[1]) for a, b in zip(runs, [*runs[1:], None])]
    return sorted(out, key=str)


def test_change_log_in_one_pass_and_month_by_month(spark):
    pick = random.Random(2)
    rows = [(k, month(m), pick.choice([None, 1, 2]), pick.choice([None, "x"])) for k in range(40) for m in range(14) if pick.random() < 0.7]
    df = spark.createDataFrame(rows, "k int, m date, a int, b string")
    once = changes_from_history(df, "k", "m", ["a", "b"])
    assert once.columns == ["k", "a", "b", "valid_from", "valid_to"]
    assert sorted(map(tuple, once.collect()), key=str) == log_by_hand(rows)
    log = changes_from_history(df.where(F.col("m") == F.lit(month(0))), "k", "m", ["a", "b"])
    for m in [1, 2, 2, 3, 4]:
        merged = merge_changes(log, df.where(F.col("m") == F.lit(month(m))), "k", "m").collect()
        log = spark.createDataFrame(merged, once.schema)
    assert sorted(map(tuple, log.collect()), key=str) == log_by_hand([r for r in rows if r[1] <= month(4)])


def test_overlapping_pairs_are_found_once(spark):
    pick = random.Random(3)
    rows = []
    for _ in range(200):
        start = dt.date(2020, 1, 1) + dt.timedelta(days=pick.randrange(500))
        rows.append((pick.choice([1, 2, 3]), start, pick.choice([None, start, start + dt.timedelta(days=pick.randrange(1, 90))])))
    got = overlapping_pairs(spark.createDataFrame(rows, "k int, valid_from date, valid_to date"), "k", "d").collect()
    wanted = [("d", k, a, b) for k, a, end in rows for j, b, _ in rows if j == k and a < b and (end is None or end > b)]
    assert sorted(map(tuple, got)) == sorted(wanted) and wanted
    clean = [(1, month(0), month(3)), (1, month(3), None), (2, month(1), None)]
    assert overlapping_pairs(spark.createDataFrame(clean, "k int, valid_from date, valid_to date"), "k", "d").count() == 0


def test_change_against_the_calendar_month_before(spark):
    rows = [("a", month(0), 4), ("a", month(1), 6), ("a", month(3), 3), ("a", month(11), 8), ("a", month(12), 2), ("b", month(1), 0), ("b", month(2), 5)]
    df = spark.createDataFrame(rows, "k string, month date, n int")
    got = {(r.k, r.month): r.c for r in with_changes(df, ["k"], "month", {"n": "c"}, gap_aware=True).collect()}
    assert {key: c and float(c) for key, c in got.items()} == {
        ("a", month(0)): None, ("a", month(1)): 50, ("a", month(3)): None, ("a", month(11)): None, ("a", month(12)): -75,
        ("b", month(1)): None, ("b", month(2)): None,
    }
    with_gaps = {(r.k, r.month): r.c for r in with_changes(df, ["k"], "month", {"n": "c"}).collect()}
    assert float(with_gaps["a", month(3)]) == -50


@pytest.mark.parametrize("months", [1, 4])
def test_sketches_of_months_merge_within_the_stated_error(spark, months):
    pick = random.Random(4)
    rows = [(g, month(m), pick.lognormvariate(g, 1)) for g in range(3) for m in range(6) if (g, m) != (1, 3) for _ in range(3000 if g else 20)]
    rows += [(0, month(2), None)] * 5
    df = spark.createDataFrame(rows, "g int, month date, v double")
    found = trailing_quantile(month_sketches(df, ["g"], "month", "v"), ["g"], "month", months, "median").collect()
    assert {(r.g, r.month) for r in found} == {(g, m) for g, m, v in rows if v is not None}
    for r in found:
        values = [v for g, m, v in rows if g == r.g and v is not None and r.month >= m > (month(r.month.month - 1 - months) if r.month.month > months else dt.date(2019, 1, 1))]
        assert r.n_values == len(values)
        below, upto = sum(v < r.median for v in values), sum(v <= r.median for v in values)
        error = rank_error() * len(values) + 1
        assert below <= len(values) / 2 + error and upto >= len(values) / 2 - error
