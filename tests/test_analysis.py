"""The marts and the five questions on a hand-made gold layer."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratamart import schemas
from stratamart.operators.temporal import as_of_join
from stratamart.plans import analysis, gold, marts, silver
from stratamart.schemas import text_schema


def month(n):
    return dt.date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


FACT = (
    "snap_month date, listing_id bigint, host_id bigint, lga_code string, has_availability boolean, "
    "booked_nights_30 int, est_revenue_30 decimal(29,4)"
)


def fact(spark, rows):
    return spark.createDataFrame(
        [(*r[:6], None if r[6] is None else Decimal(r[6])) for r in rows], FACT
    )


def census(spark, rows):
    return spark.createDataFrame(
        rows,
        "lga_code string, lga_name string, median_age_persons int, median_mortgage_monthly int, "
        "average_household_size double",
    )


def persons(spark, codes):
    return spark.createDataFrame(
        [(c, c, 1, 2, 3) for c in codes],
        "lga_code string, lga_name string, total_pop_male int, total_pop_female int, total_pop int",
    )


def test_places_prefer_area_names_and_low_codes(spark):
    areas = spark.createDataFrame(
        [("LGA00003", "FAIR-FIELD"), ("LGA00001", "CUMBER"), ("LGA00002", "RYDE")],
        "lga_code string, lga_name string",
    )
    suburbs = spark.createDataFrame(
        [("FAIRFIELD", "CUMBER"), ("NORTH", "RYDE"), ("NORTH", "CUMBER"), ("LOST", "NOWHERE")],
        "suburb_name string, lga_name string",
    )
    got = {r.place_key: (r.lga_code, r.match_type) for r in gold.dim_place(areas, suburbs).collect()}
    assert got == {
        "FAIRFIELD": ("LGA00003", "lga_name"),
        "CUMBER": ("LGA00001", "lga_name"),
        "RYDE": ("LGA00002", "lga_name"),
        "NORTH": ("LGA00001", "suburb"),
    }


def test_reference_silver_tables(spark):
    codes = spark.createDataFrame(
        [("10300", " Albury "), ("lga00300", "b"), ("abc", "c"), (None, "d")], "lga_code string, lga_name string"
    )
    assert sorted(tuple(r) for r in silver.silver_area_codes(codes).collect()) == [
        ("LGA00300", "B"), ("LGA10300", "ALBURY"),
    ]
    suburbs = spark.createDataFrame(
        [("x", " a"), ("X ", "a"), (None, "a")], "lga_name string, suburb_name string"
    )
    assert [tuple(r) for r in silver.silver_area_suburbs(suburbs).collect()] == [("A", "X")]
    medians = spark.createDataFrame(
        [(" LGA1 ", "36", "", "1", "2", "3", "0.8", "4", "2.6")],
        text_schema(
            ("lga_code_2016", "median_age_persons", "median_mortgage_repay_monthly",
             "median_tot_prsnl_inc_weekly", "median_rent_weekly", "median_tot_fam_inc_weekly",
             "average_num_psns_per_bedroom", "median_tot_hhd_inc_weekly", "average_household_size")
        ),
    )
    row = silver.silver_census_medians(medians).first()
    assert (row.lga_code, row.median_age_persons, row.median_mortgage_monthly) == ("LGA1", 36, None)
    assert (row.avg_persons_per_bedroom, row.average_household_size) == (0.8, 2.6)


def test_lenient_typing_counts_what_it_drops(spark):
    columns = schemas.LISTING_COLUMNS
    good = {"listing_id": "1", "scraped_date": "2020-05-02", "price": "$5", "has_availability": "t"}
    rows = [good, good | {"accommodates": "many", "price": "1.2.3"}, good | {"host_since": "32/9/2009", "price": ""},
            good | {"listing_id": "x", "host_is_superhost": "maybe"}]
    raw = spark.createDataFrame(
        [tuple(r.get(c) for c in columns) for r in rows], text_schema(columns)
    ).withColumn("load_month", F.lit(month(5)))
    counts = {r.column_name: r.n_rejected for r in silver.rejected_values(raw).collect()}
    assert counts == {"accommodates": 1, "price": 1, "host_since": 1, "listing_id": 1, "host_is_superhost": 1}
    assert silver.typed_listings(raw, on_bad="null").count() == 3
    with pytest.raises(PySparkException):
        silver.typed_listings(raw).collect()


def test_host_representative_takes_latest_scrape_then_lowest_listing(spark):
    rows = [
        (2, 7, dt.date(2020, 5, 9), "two"), (1, 7, dt.date(2020, 5, 9), "one"),
        (3, 7, dt.date(2020, 5, 8), "three"), (4, None, dt.date(2020, 5, 9), "nobody"),
    ]
    df = spark.createDataFrame(
        [(l, h, month(5), d, n, None, None) for l, h, d, n in rows],
        "listing_id bigint, host_id bigint, month_key date, scraped_dt date, host_name string, "
        "host_is_superhost boolean, host_neighbourhood string",
    )
    assert [(r.host_id, r.host_name) for r in gold.host_months(df).collect()] == [(7, "one")]


def test_host_mart_buckets_unmapped_and_counts_hosts_once(spark):
    facts = fact(spark, [
        (month(1), 1, 7, None, True, 1, "10"), (month(1), 2, 7, None, True, 1, "30"),
        (month(1), 3, 7, None, False, 1, "99"), (month(1), 4, 8, None, False, 1, "99"),
        (month(1), 5, 9, None, True, 1, "5"), (month(1), 6, None, None, True, 1, "5"),
    ])
    hosts = spark.createDataFrame(
        [(7, "Ryde", month(1), None), (8, None, month(1), None), (9, "x", month(2), None)],
        "host_id bigint, host_neighbourhood string, valid_from date, valid_to date",
    )
    places = spark.createDataFrame([("RYDE", "RYDE")], "place_key string, lga_name string")
    got = sorted(tuple(r) for r in marts.dm_host_neighbourhood(facts, hosts, places).collect())
    assert got == [
        ("RYDE", month(1), 1, Decimal(40), Decimal(40)),
        ("UNMAPPED", month(1), 1, None, None),
    ]


def test_q1_ties_and_areas_without_revenue(spark):
    rows = [(month(1), 1, 1, "old", True, 1, "99999")]  # before the trailing year
    for code, revenue in [("a", 50), ("b", 40), ("c", 40), ("d", 10)]:
        rows += [(month(13), 1, 1, code, True, 1, str(revenue)), (month(13), 2, 1, code, False, 1, "1000")]
    rows += [(month(13), 3, 1, None, False, 1, "70")]
    report = analysis.top_and_bottom_areas(
        fact(spark, rows),
        census(spark, [("a", "AREA A", 40, 1, 2.5), ("d", "AREA D", 30, 1, 2.0)]),
        persons(spark, ["a"]),
    ).collect()
    got = [(r.bucket, r.lga_name, r.rev_per_active) for r in report]
    # no revenue ranks first from above; b and c share rank 3; below, both share rank 2
    assert got == [
        ("TOP_3", None, None),
        ("TOP_3", "AREA A", Decimal("50.00")),
        ("TOP_3", None, Decimal("40.00")), ("TOP_3", None, Decimal("40.00")),
        ("BOTTOM_3", None, Decimal("40.00")), ("BOTTOM_3", None, Decimal("40.00")),
        ("BOTTOM_3", "AREA D", Decimal("10.00")),
    ]
    assert [r.total_pop for r in report if r.lga_name == "AREA A"] == [3]


def test_q1_with_few_areas_lists_them_twice(spark):
    rows = [(month(1), 1, 1, c, True, 1, v) for c, v in (("a", "1"), ("b", "2"))]
    report = analysis.top_and_bottom_areas(fact(spark, rows), census(spark, []), persons(spark, []))
    assert sorted(r.bucket for r in report.collect()) == ["BOTTOM_3", "BOTTOM_3", "TOP_3", "TOP_3"]


def test_q2(spark):
    rows = [(month(1), 1, 1, c, True, 1, v) for c, v in (("a", "10"), ("b", "20"), ("c", "40"), (None, "7"))]
    medians = census(spark, [("a", "A", 30, 1, 1.0), ("b", "B", 40, 1, 1.0), ("c", "C", 41, 1, 1.0)])
    row = analysis.age_revenue_correlation(fact(spark, rows), medians).first()
    assert tuple(row) == (3, Decimal("23.33"), Decimal("37.00"), Decimal("0.8072"))
    same = analysis.age_revenue_correlation(fact(spark, rows[:1]), medians).first()
    assert same.n_lgas == 1 and same.corr_rev_age is None


def test_q2_without_spread_has_no_correlation(spark):
    rows = [(month(1), 1, 1, c, True, 1, v) for c, v in (("a", "10"), ("b", "20"), ("c", "40"))]
    one_age = census(spark, [("a", "A", 30, 1, 1.0), ("b", "B", 30, 1, 1.0), ("c", "C", 30, 1, 1.0)])
    row = analysis.age_revenue_correlation(fact(spark, rows), one_age).first()
    assert tuple(row) == (3, Decimal("23.33"), Decimal("30.00"), None)
    ages = census(spark, [("a", "A", 30, 1, 1.0), ("b", "B", 40, 1, 1.0), ("c", "C", 41, 1, 1.0)])
    one_revenue = [(*r[:-1], "10") for r in rows]
    row = analysis.age_revenue_correlation(fact(spark, one_revenue), ages).first()
    assert tuple(row) == (3, Decimal("10.00"), Decimal("37.00"), None)


def test_q3_uses_the_plain_mean_of_monthly_means(spark):
    versions = spark.createDataFrame(
        [(1, "good", "flat", "all", 2, month(1), month(2)), (1, "good", "house", "all", 4, month(2), None),
         (2, "poor", "flat", "all", 2, month(1), None), (3, "good", "flat", "all", 2, month(1), None),
         (4, None, "flat", "all", 2, month(1), None)],
        "listing_id bigint, listing_neighbourhood string, property_type string, room_type string, "
        "accommodates int, valid_from date, valid_to date",
    )
    rows = [
        (month(1), 1, 1, None, True, 5, "100"), (month(2), 1, 1, None, True, 7, "10"),
        (month(1), 3, 1, None, True, 2, "100"), (month(2), 3, 1, None, False, 9, "900"),
        # weighted by listing-months poor would win: (60 + 60 + 30) / 3 = 50 < 70; by means 55 = mean(100, 10)
        (month(1), 2, 1, None, True, 3, "54"), (month(1), 4, 1, None, True, 30, "100000"),
    ]
    months = as_of_join(fact(spark, rows), versions, "listing_id", "snap_month", grain="month")
    months = months.withColumnRenamed("snap_month", "month")
    got = [tuple(r) for r in analysis.best_configurations(months, neighbourhoods=1).collect()]
    assert got == [("good", "flat", "all", 2, 7, 1), ("good", "house", "all", 4, 7, 1)]
    both = analysis.best_configurations(months).collect()
    assert {r.listing_neighbourhood for r in both} == {"good", "poor"}


def test_q4(spark):
    rows = [
        (month(1), 1, 1, "a", True, 1, "1"), (month(2), 1, 1, "a", True, 1, "1"),   # one listing
        (month(1), 2, 2, "a", True, 1, "1"), (month(1), 3, 2, "a", True, 1, "1"),   # two, one area
        (month(1), 4, 3, "b", True, 1, "1"), (month(1), 5, 3, "a", True, 1, "1"),   # two areas
        (month(1), 6, 4, "a", True, 1, "1"), (month(1), 7, 4, None, True, 1, "1"),  # second has none
        (month(1), 8, 5, "a", True, 1, "1"), (month(2), 8, 5, "b", True, 1, "1"),   # moved
    ]
    facts = fact(spark, rows)
    assert tuple(analysis.multi_listing_hosts(facts).first()) == (2, 1, 1, Decimal("50.00"))
    assert [tuple(r) for r in analysis.primary_areas(facts).collect()] == [
        (1, "a", 1), (2, "a", 2), (3, "a", 1), (4, "a", 1), (5, "a", 1),
    ]
    assert analysis.primary_areas(facts, 2).count() == 2
    assert analysis.multi_listing_hosts(facts.where("false")).first().pct_multi_lga is None


def test_q5(spark):
    rows = [
        (month(1), 1, 1, "a", True, 1, "700"), (month(2), 1, 1, "a", True, 1, "500"),   # 1200 covers
        (month(1), 2, 2, "a", True, 1, "1199"), (month(2), 2, 2, "a", False, 1, "9000"),  # does not
        (month(1), 3, 3, "a", False, 1, "9000"),                                        # none active
        (month(1), 4, 4, "a", True, 1, "5000"), (month(2), 4, 4, "b", True, 1, "5000"),  # moved
        (month(1), 5, 5, "a", True, 1, "5000"), (month(1), 6, 5, "a", True, 1, "5000"),  # two listings
        (month(1), 7, None, "a", True, 1, "5000"),                                      # no host
        (month(1), 8, 6, None, True, 1, "5000"),                                        # no area
        (month(1), 9, 7, "a", True, 1, "5000"), (month(2), None, 7, "a", True, 1, "1"),  # unknown listing too
        (month(1), None, 8, "a", True, 1, None),                                        # one, unknown
        (month(1), 10, 9, "z", True, 1, "5000"),                                        # not in the census
        (month(1), 11, 10, "a", True, 1, "5000"), (month(2), 11, 10, None, True, 1, "5000"),
    ]
    medians = census(spark, [("a", "A", 40, 100, 2.0), ("b", "B", 40, 100, 2.0)])
    areas = spark.createDataFrame([("a", "A"), ("b", "B"), ("z", "Z")], "lga_code string, lga_name string")
    got = [tuple(r) for r in analysis.mortgage_coverage(fact(spark, rows), medians, areas).collect()]
    assert got == [("A", "a", 4, 1, Decimal("25.00"))]


@pytest.mark.parametrize("keys", [["listing_neighbourhood"], ["property_type", "room_type", "accommodates"]])
def test_listing_mart_columns(spark, keys):
    df = spark.createDataFrame(
        [("n", "p", "r", 2, month(m), 1, True, m != 2, Decimal(5), 90, 3, Decimal(15)) for m in (1, 2, 3)],
        "listing_neighbourhood string, property_type string, room_type string, accommodates int, month date, "
        "host_id bigint, host_is_superhost boolean, has_availability boolean, price decimal(18,4), "
        "review_scores_rating int, booked_nights_30 int, est_revenue_30 decimal(29,4)",
    )
    rows = marts.listing_mart(df, keys).orderBy("month").collect()
    assert [r.active_listings_rate for r in rows] == [Decimal(100), Decimal(0), Decimal(100)]
    assert [r.pct_change_active for r in rows] == [None, Decimal(-100), None]
    assert [r.pct_change_inactive for r in rows] == [None, None, Decimal(-100)]
    assert [r.superhost_rate for r in rows] == [Decimal(100)] * 3
