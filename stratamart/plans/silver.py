"""Typed, cleaned, de-duplicated tables from the raw text layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import (
    blank_to_null,
    clean_currency,
    empty_to_null,
    month_start,
    parse_date_multi,
    tidy_upper,
    tristate,
    typed,
    unify_code,
)
from stratamart.operators.dedup import latest_per_key

# The published columns, in order.
SILVER_LISTING_COLUMNS = (
    "listing_id",
    "month_key",
    "scraped_dt",
    "scrape_id",
    "host_id",
    "host_name",
    "host_since_dt",
    "host_is_superhost",
    "host_neighbourhood",
    "listing_neighbourhood",
    "property_type",
    "room_type",
    "accommodates",
    "price",
    "has_availability",
    "availability_30",
    "number_of_reviews",
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_value",
    "load_month",
)

_TYPES = {
    "scrape_id": "bigint",
    "host_id": "bigint",
    "accommodates": "int",
    "availability_30": "int",
    "number_of_reviews": "int",
    "review_scores_rating": "int",
    "review_scores_accuracy": "int",
    "review_scores_cleanliness": "int",
    "review_scores_checkin": "int",
    "review_scores_communication": "int",
    "review_scores_value": "int",
}
_TEXTS = ("host_name", "host_neighbourhood", "listing_neighbourhood", "property_type", "room_type")
_FLAGS = ("host_is_superhost", "has_availability")


def typed_listings(raw: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Typed rows with a listing id and a readable scrape date; the month is the scrape's.

    A lenient run (``on_bad='null'``) also drops rows whose id is not a number.
    """

    def value(name: str) -> Column:
        if name in _TYPES:
            return typed(blank_to_null(F.col(name)), _TYPES[name], on_bad)
        if name in _TEXTS:
            return blank_to_null(F.col(name))
        return tristate(F.col(name))

    rows = raw.where(blank_to_null(F.col("listing_id")).isNotNull()).select(
        typed(F.col("listing_id"), "bigint", on_bad).alias("listing_id"),
        parse_date_multi(F.col("scraped_date")).alias("scraped_dt"),
        parse_date_multi(F.col("host_since")).alias("host_since_dt"),
        clean_currency(F.col("price"), on_bad=on_bad).alias("price"),
        *[value(c).alias(c) for c in (*_TYPES, *_TEXTS, *_FLAGS)],
        "load_month",
    )
    return (
        rows.where("listing_id IS NOT NULL AND scraped_dt IS NOT NULL")
        .withColumn("month_key", month_start(F.col("scraped_dt")))
        .select(*SILVER_LISTING_COLUMNS)
    )


def rejected_values(raw: DataFrame) -> DataFrame:
    """(column_name, n_rejected): filled values that a lenient run turns into NULL, in one pass."""

    def rejected(name: str, value: Column) -> Column:
        bad = blank_to_null(F.col(name)).isNotNull() & value.isNull()
        return F.struct(
            F.lit(name).alias("column_name"), F.count(F.when(bad, 1)).alias("n_rejected")
        )

    values = {c: typed(blank_to_null(F.col(c)), to, "null") for c, to in _TYPES.items()}
    values["listing_id"] = typed(F.col("listing_id"), "bigint", "null")
    values["price"] = clean_currency(F.col("price"), on_bad="null")
    values |= {c: parse_date_multi(F.col(c)) for c in ("scraped_date", "host_since")}
    values |= {c: tristate(F.col(c)) for c in _FLAGS}
    counts = raw.agg(F.array(*[rejected(c, v) for c, v in values.items()]).alias("counts"))
    return counts.select(F.inline("counts")).where("n_rejected > 0")


def latest_listings(rows: DataFrame) -> DataFrame:
    """One row per listing and month: latest scrape, then the file loaded for the later month."""
    return latest_per_key(rows, ["listing_id", "month_key"], ["scraped_dt", "load_month"])


def silver_listings(raw: DataFrame, on_bad: str = "fail") -> DataFrame:
    return latest_listings(typed_listings(raw, on_bad))


def silver_area_codes(raw: DataFrame) -> DataFrame:
    """Area codes in one spelling with tidy names; rows without a usable code are dropped."""
    return raw.select(
        unify_code(F.col("lga_code")).alias("lga_code"),
        tidy_upper(F.col("lga_name")).alias("lga_name"),
    ).where("lga_code IS NOT NULL")


def silver_area_suburbs(raw: DataFrame) -> DataFrame:
    return (
        raw.where("suburb_name IS NOT NULL AND lga_name IS NOT NULL")
        .select(
            tidy_upper(F.col("suburb_name")).alias("suburb_name"),
            tidy_upper(F.col("lga_name")).alias("lga_name"),
        )
        .distinct()
    )


def _census(raw: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    return raw.where("lga_code_2016 IS NOT NULL").select(
        F.trim("lga_code_2016").alias("lga_code"),
        *[
            typed(empty_to_null(F.col(source)), to).alias(name)
            for name, (source, to) in columns.items()
        ],
    )


def silver_census_persons(raw: DataFrame) -> DataFrame:
    """Population totals per area; 4 of the 109 delivered columns are read."""
    return _census(
        raw,
        {
            "total_pop_male": ("tot_p_m", "int"),
            "total_pop_female": ("tot_p_f", "int"),
            "total_pop": ("tot_p_p", "int"),
        },
    )


def silver_census_medians(raw: DataFrame) -> DataFrame:
    return _census(
        raw,
        {
            "median_age_persons": ("median_age_persons", "int"),
            "median_mortgage_monthly": ("median_mortgage_repay_monthly", "int"),
            "median_personal_income_weekly": ("median_tot_prsnl_inc_weekly", "int"),
            "median_rent_weekly": ("median_rent_weekly", "int"),
            "median_family_income_weekly": ("median_tot_fam_inc_weekly", "int"),
            "avg_persons_per_bedroom": ("average_num_psns_per_bedroom", "double"),
            "median_household_income_weekly": ("median_tot_hhd_inc_weekly", "int"),
            "average_household_size": ("average_household_size", "double"),
        },
    )
