"""De-duplication, history, temporal joins, metrics and checks on small known inputs."""

import datetime as dt
import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.operators import metrics, quality
from stratamart.operators.dedup import first_per_key, latest_per_key
from stratamart.operators.history import (
    as_dimension,
    merge_versions,
    versions_from_history,
)
from stratamart.operators.storage import bounded_broadcast, shared_folder, written_once
from stratamart.operators.temporal import as_of_join, published_until, trailing_months


def month(n):
    return dt.date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- de-duplication ------------------------------------------------------------------------


def test_latest_row_wins_then_later_file(spark):
    rows = [
        (1, dt.date(2020, 9, 1), month(9), "first"),
        (1, dt.date(2020, 9, 9), month(7), "ninth"),
        (2, dt.date(2020, 9, 5), month(7), "july file"),
        (2, dt.date(2020, 9, 5), month(9), "sept file"),
    ]
    df = spark.createDataFrame(rows, "id int, scraped date, loaded date, note string")
    kept = latest_per_key(df, ["id"], ["scraped", "loaded"])
    assert rows_of(kept.select("id", "note")) == [(1, "ninth"), (2, "sept file")]


def test_full_ties_do_not_depend_on_input_order(spark):
    rows = [(1, dt.date(2020, 9, 1), n) for n in ("b", "a", None, "c")]
    seen = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame(order, "id int, scraped date, note string").repartition(3)
        seen.add(latest_per_key(df, ["id"], ["scraped"]).first().note)
    assert seen == {"a"}


def test_a_hot_key_shrinks_before_the_shuffle(spark):
    df = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), "id"
    )
    kept = first_per_key(df, ["key"], [F.col("id").desc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle
    assert kept.where("key = 0").first().id == 29_997


# ---- history -------------------------------------------------------------------------------

HISTORY = [(1, month(1), "a"), (1, month(2), "b"), (1, month(4), "b"), (2, month(1), "x")]
VERSIONS = [
    (1, "a", month(1), month(2)),
    (1, "b", month(2), month(4)),
    (1, "b", month(4), None),
    (2, "x", month(1), None),
]
SHAPE = "key int, period date, v string"


def merged_month_by_month(spark, rows, periods):
    current = spark.createDataFrame([], "key int, v string, valid_from date, valid_to date")
    df = spark.createDataFrame(rows, SHAPE)
    for period in periods:
        current = written_once(
            merge_versions(current, df.where(F.col("period") == F.lit(period)), "key", "period"),
            "versions",
        )
    return current


def test_versions_from_history(spark):
    df = spark.createDataFrame(HISTORY, SHAPE)
    assert rows_of(versions_from_history(df, "key", "period", ["v"])) == VERSIONS


def test_merge_month_by_month_gives_the_same_history(spark):
    merged = merged_month_by_month(spark, HISTORY, [month(n) for n in (1, 2, 3, 4)])
    assert rows_of(merged) == VERSIONS


def test_repeating_a_month_changes_nothing(spark):
    current = merged_month_by_month(spark, HISTORY, [month(n) for n in (1, 2, 4)])
    again = spark.createDataFrame([(1, month(4), "corrected"), (2, month(1), "old")], SHAPE)
    assert rows_of(merge_versions(current, again, "key", "period")) == VERSIONS


def test_random_histories_agree(spark):
    draw = random.Random(7)
    rows = [
        (key, month(n), draw.choice("abc"))
        for key in range(40)
        for n in range(1, 7)
        if draw.random() < 0.6
    ]
    df = spark.createDataFrame(rows, SHAPE)
    once = rows_of(versions_from_history(df, "key", "period", ["v"]))
    assert rows_of(merged_month_by_month(spark, rows, [month(n) for n in range(1, 7)])) == once


def test_dimension_form(spark):
    df = spark.createDataFrame(HISTORY, SHAPE)
    dim = as_dimension(versions_from_history(df, "key", "period", ["v"]), "key", ["v"])
    assert rows_of(dim.where("is_current").select("key", "valid_from")) == [
        (1, month(4)), (2, month(1)),
    ]


# ---- temporal joins ------------------------------------------------------------------------


def test_fact_dates_at_the_edges_of_versions(spark):
    versions = spark.createDataFrame(
        [(1, "a", month(2), month(4)), (1, "b", month(4), None)],
        "key int, v string, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame(
        [(1, month(1)), (1, month(2)), (1, month(3)), (1, month(4)), (1, month(20)), (None, month(2))],
        "key int, day date",
    )
    inner = as_of_join(facts, versions, "key", "day")
    assert rows_of(inner) == sorted(
        [(1, month(2), "a"), (1, month(3), "a"), (1, month(4), "b"), (1, month(20), "b")], key=str
    )
    left = as_of_join(facts, versions, "key", "day", how="left", until=month(20))
    assert rows_of(left.where("v IS NULL").select("key", "day")) == sorted(
        [(1, month(1)), (None, month(2))], key=str
    )
    monthly = as_of_join(facts, versions, "key", "day", how="left", grain="month")
    assert rows_of(monthly) == rows_of(left)
    with pytest.raises(ValueError):
        as_of_join(facts, versions, "key", "day", how="right")


def test_as_of_join_equals_the_interval_definition(spark):
    """Any dates, overlapping and empty intervals, gaps: same rows as comparing all pairs."""
    draw = random.Random(3)
    start = dt.date(2020, 1, 1)

    def day():
        return start + dt.timedelta(days=draw.randrange(400))

    facts = [(i, draw.randrange(5), day()) for i in range(120)]
    versions = []
    for i in range(60):
        a, b = day(), draw.choice([None, day()])
        versions.append((draw.randrange(5), i, a, b))
    expected = {
        (i, v)
        for i, key, on in facts
        for k, v, a, b in versions
        if k == key and on >= a and (b is None or on < b)
    }
    joined = as_of_join(
        spark.createDataFrame(facts, "i int, key int, day date"),
        spark.createDataFrame(versions, "key int, v int, valid_from date, valid_to date"),
        "key",
        "day",
    )
    got = [(r.i, r.v) for r in joined.collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_trailing_months(spark):
    df = spark.createDataFrame([(month(n),) for n in range(1, 20)], "m date")
    kept = [r.m for r in trailing_months(df, "m").orderBy("m").collect()]
    assert kept == [month(n) for n in range(8, 20)]
    assert trailing_months(df, "m", 3, until=month(5)).count() == 3
    assert published_until(df, "m", month(5)).count() == 5


# ---- metrics -------------------------------------------------------------------------------

METRIC_SHAPE = (
    "g string, host_id bigint, host_is_superhost boolean, has_availability boolean, "
    "price decimal(18,4), review_scores_rating int, booked_nights_30 int, est_revenue_30 decimal(29,4)"
)


def metric_rows(spark, rows):
    made = [
        (g, h, s, a, None if p is None else Decimal(p), r, n, None if p is None or n is None else Decimal(p) * n)
        for g, h, s, a, p, r, n in rows
    ]
    return spark.createDataFrame(made, METRIC_SHAPE)


def test_group_metrics_by_hand(spark):
    df = metric_rows(
        spark,
        [
            ("a", 1, True, True, "10", 80, 3),
            ("a", 1, False, True, "20", None, 5),
            ("a", 2, False, False, "99", 10, 9),
            ("a", None, True, None, "50", 10, 9),
            ("off", 3, None, False, "7", 10, 1),
            (None, 4, True, True, None, 60, 2),
        ],
    )
    got = {r.g: r.asDict() for r in metrics.group_metrics(df, ["g"]).collect()}
    assert set(got) == {"a", "off", None}
    assert got["a"] == {
        "g": "a", "listings_total": 4, "listings_active": 2, "listings_inactive": 1,
        "min_price_active": Decimal(10), "max_price_active": Decimal(20),
        "median_price_active": 15.0, "avg_price_active": 15.0, "hosts_total": 2, "hosts_super": 1,
        "avg_rating_active": 80.0, "total_stays_active": 8, "avg_est_revenue_active": 65.0,
    }
    off = got["off"]
    assert (off["listings_active"], off["listings_inactive"]) == (0, 1)
    assert off["hosts_super"] == 0
    for name in ("min_price_active", "median_price_active", "avg_price_active",
                 "total_stays_active", "avg_est_revenue_active"):
        assert off[name] is None
    assert got[None]["listings_total"] == 1 and got[None]["median_price_active"] is None


def test_flags_all_null_give_null_counts(spark):
    df = metric_rows(spark, [("a", 1, None, None, "10", 80, 3)])
    row = metrics.group_metrics(df, ["g"]).first()
    assert (row.listings_total, row.listings_active, row.listings_inactive) == (1, None, None)


@pytest.mark.parametrize("q", [0.5, 0.25, 0.9])
def test_exact_quantile_against_sorting(spark, q):
    draw = random.Random(11)
    groups = defaultdict(list)
    for _ in range(3000):
        # one group holds a third of the rows; ties, negatives, zeros and large values occur
        g = draw.choice(["hot", "hot", *"abcd"]) if draw.random() < 0.9 else None
        v = draw.choice([0.0, -5.5, draw.uniform(-100, 100), draw.uniform(0, 1e7), 3.25])
        groups[g].append(v)
    groups["one"], groups["two"] = [4.0], [1.0, 2.0]
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r.m for r in metrics.exact_quantile(df, ["g"], "v", "m", q).collect()}
    expected = {}
    for g, vs in groups.items():
        vs, at = sorted(vs), q * (len(vs) - 1)
        low = int(at)
        high = min(low + 1, len(vs) - 1)
        expected[g] = vs[low] + (vs[high] - vs[low]) * (at - low)
    assert got.keys() == expected.keys()
    for g in expected:
        assert got[g] == pytest.approx(expected[g], rel=1e-12, abs=1e-12)
    if q == 0.5:
        assert got["hot"] == pytest.approx(statistics.median(groups["hot"]))


def test_median_of_amounts_is_exact(spark):
    df = spark.createDataFrame([("a", Decimal("85928.07")), ("a", Decimal("5515.89"))], "g string, p decimal(18,4)")
    assert metrics.exact_quantile(df, ["g"], "p", "m").first().m == 45721.98


def test_change_skips_missing_months_and_zero_bases(spark):
    rows = [("a", month(1), 4), ("a", month(3), 6), ("a", month(4), 0), ("a", month(5), 2), (None, month(1), 1), (None, month(2), 2)]
    df = spark.createDataFrame(rows, "g string, m date, n bigint")
    changed = metrics.with_changes(df, ["g"], "m", {"n": "pct"}).orderBy("g", "m").collect()
    assert [(r.g, r.pct) for r in changed] == [
        (None, None), (None, Decimal(100)),
        ("a", None), ("a", Decimal(50)), ("a", Decimal(-100)), ("a", None),
    ]


# ---- checks --------------------------------------------------------------------------------


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, None), (None, "x")], "id int, v string")
    assert rows_of(quality.check_not_null(df, ["id", "v"])) == [("id", 2), ("v", 2)]
    assert rows_of(quality.check_not_null(df.where("id = 1"), ["id"])) == []
    assert rows_of(quality.check_unique(df, "id")) == [(1, 2)]
    pairs = spark.createDataFrame([(1, None), (1, None), (2, "x")], "id int, v string")
    assert rows_of(quality.check_unique_combination(pairs, ["id", "v"])) == [(1, None, 2)]


def test_relationship_allows_null(spark):
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "p int")
    assert rows_of(quality.check_relationship(child, "k", parent, "p")) == [(3, 2)]


def test_overlap(spark):
    versions = spark.createDataFrame(
        [
            (1, month(1), month(4)), (1, month(3), None),
            (2, month(1), month(2)), (2, month(2), None),
            (3, month(1), None), (3, month(2), month(3)), (3, month(5), None),
        ],
        "key int, valid_from date, valid_to date",
    )
    assert rows_of(quality.check_no_overlap(versions, "key", "dim")) == [
        ("dim", 1, month(1), month(3)), ("dim", 3, month(1), month(2)),
    ]


def test_join_balance_sees_losses_that_totals_hide(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    joined = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows_of(quality.join_balance(facts, joined, ["k"])) == [(3, 3, 1, 1)]
    assert quality.check_join_preserves(facts, joined, ["k"]).count() == 1
    assert quality.check_join_preserves(facts, facts, ["k"]).count() == 0


def test_periods_covered(spark):
    periods = spark.createDataFrame([(month(1),), (month(2),), (month(2),)], "m date")
    versions = spark.createDataFrame([(month(1),)], "f date")
    assert rows_of(quality.check_periods_covered(periods, "m", versions, "f")) == [(month(2),)]


# ---- storage -------------------------------------------------------------------------------


def test_broadcast_only_within_the_bound(spark):
    small, large = spark.range(10), spark.range(11)

    def marked(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert marked(bounded_broadcast(small, 10))
    assert not marked(bounded_broadcast(large, 10))


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
