"""The 26 checks of a build: as numbers of failing rows from one scan per table, and as the failing rows themselves."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.operators.quality import (
    check_join_preserves,
    check_no_overlap,
    check_not_null,
    check_periods_covered,
    check_relationship,
    check_unique,
    check_unique_combination,
)
from stratamart.operators.storage import written_once
from stratamart.operators.tallies import null_counter, tallies

# Which rules each table has to meet.
REQUIRED = {
    "bronze.listings_raw": ("listing_id", "load_month"),
    "silver.silver_listings": ("listing_id", "month_key"),
    "silver.silver_lga_code": ("lga_code",),
    "gold.dim_lga": ("lga_code",),
    "gold.dim_place": ("place_key", "lga_code"),
    "gold.fact_listing_monthly": ("listing_id", "snap_month"),
}
UNIQUE = {
    "silver.silver_lga_code": "lga_code",
    "gold.dim_lga": "lga_code",
    "gold.dim_place": "place_key",
}
UNIQUE_TOGETHER = {
    "silver.silver_listings": ("listing_id", "month_key"),
    "gold.dim_listing": ("listing_id", "valid_from"),
    "gold.dim_host": ("host_id", "valid_from"),
    "gold.fact_listing_monthly": ("listing_id", "snap_month"),
    "gold.dm_listing_neighbourhood": ("listing_neighbourhood", "month"),
    "gold.dm_property_type": ("property_type", "room_type", "accommodates", "month"),
    "gold.dm_host_neighbourhood": ("host_neighbourhood_lga", "month"),
}
RELATED = (
    ("gold.dim_place", "lga_code", "gold.dim_lga", "lga_code"),
    ("gold.fact_listing_monthly", "host_id", "gold.dim_host", "host_id"),
    ("gold.fact_listing_monthly", "lga_code", "gold.dim_lga", "lga_code"),
)


def failing_rows(tables: Mapping[str, DataFrame], until: dt.date) -> dict[str, DataFrame]:
    """Every check of a build as a frame of failing rows, to look into what ``rule_counts`` has found.

    The not-NULL rules of one table are checked in a single pass, so the 26 rules make 22
    frames.
    """
    checks: dict[str, DataFrame] = {}
    for table, columns in REQUIRED.items():
        checks[f"not_null {table}({', '.join(columns)})"] = check_not_null(tables[table], columns)
    for table, column in UNIQUE.items():
        checks[f"unique {table}({column})"] = check_unique(tables[table], column)
    for table, columns in UNIQUE_TOGETHER.items():
        checks[f"unique {table}({', '.join(columns)})"] = check_unique_combination(
            tables[table], columns
        )
    for child, column, parent, parent_column in RELATED:
        checks[f"related {child}({column}) to {parent}"] = check_relationship(
            tables[child], column, tables[parent], parent_column
        )
    checks["no overlap"] = check_no_overlap(
        tables["gold.dim_listing"], "listing_id", "dim_listing"
    ).unionByName(check_no_overlap(tables["gold.dim_host"], "host_id", "dim_host"))
    checks["mart join preserves fact rows"] = check_join_preserves(
        tables["gold.fact_listing_monthly"].withColumnRenamed("snap_month", "month"),
        tables["gold.int_listing_month"],
        ["listing_id", "month"],
    )
    checks["snapshots cover all months"] = check_periods_covered(
        tables["silver.silver_listings"].where(F.col("month_key") <= F.lit(until)),
        "month_key",
        tables["gold.dim_listing"],
        "valid_from",
    )
    return checks


# Tables that the rules over two tables compare, and the columns they compare.
VERSIONED = {"gold.dim_listing": "listing_id", "gold.dim_host": "host_id"}
PRESERVED = {
    "gold.fact_listing_monthly": ("listing_id", "snap_month"),
    "gold.int_listing_month": ("listing_id", "month"),
}
COVERED = {"silver.silver_listings": "month_key", "gold.dim_listing": "valid_from"}
FAR = dt.date(9999, 12, 31)


def _key_sets() -> dict[str, list[tuple[str, ...]]]:
    """The key sets whose counts the rules need, by table; a rule of an equal key set shares its counts."""
    wanted = [(table, (column,)) for table, column in UNIQUE.items()]
    wanted += list(UNIQUE_TOGETHER.items())
    wanted += list(PRESERVED.items())
    wanted += [(table, (column,)) for table, column in COVERED.items()]
    for child, column, parent, parent_column in RELATED:
        wanted += [(child, (column,)), (parent, (parent_column,))]
    found: dict[str, list[tuple[str, ...]]] = {table: [] for table in REQUIRED}
    for table, keys in wanted:
        held = found.setdefault(table, [])
        if keys not in held:
            held.append(keys)
    return found


KEY_SETS = _key_sets()


def rule_tallies(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """For each table under a rule, the counts from which all its rules are told: one scan and one shuffle a table."""
    latest = {"latest": F.coalesce("valid_to", F.lit(FAR))}
    return {
        table: tallies(tables[table], keys, REQUIRED.get(table, ()), latest if table in VERSIONED else None)
        for table, keys in KEY_SETS.items()
    }


def _counts(counted: Mapping[str, DataFrame], table: str, keys: tuple[str, ...]) -> DataFrame:
    return counted[table].where(F.col("key_set") == KEY_SETS[table].index(keys))


def _nulls(table: str, column: str) -> Column:
    for k, keys in enumerate(KEY_SETS[table]):
        if column in keys:
            return F.sum(F.when((F.col("key_set") == k) & F.col(column).isNull(), F.col("n")))
    return F.sum(F.when(F.col("key_set") == 0, F.col(null_counter(column))))


def _repeated(table: str, keys: tuple[str, ...], null_counts: bool) -> Column:
    again = (F.col("key_set") == KEY_SETS[table].index(keys)) & (F.col("n") > 1)
    return F.count_if(again if null_counts else again & F.col(keys[0]).isNotNull())


def _own_rules(counted: Mapping[str, DataFrame], table: str) -> DataFrame | None:
    """Rules that look at one table only, told in a single aggregate over its counts."""
    rules = {f"not_null {table}({c})": _nulls(table, c) for c in REQUIRED.get(table, ())}
    if table in UNIQUE:
        rules[f"unique {table}({UNIQUE[table]})"] = _repeated(table, (UNIQUE[table],), False)
    if table in UNIQUE_TOGETHER:
        keys = UNIQUE_TOGETHER[table]
        rules[f"unique {table}({', '.join(keys)})"] = _repeated(table, keys, True)
    if not rules:
        return None
    told = [F.struct(F.lit(rule).alias("rule"), F.coalesce(n, F.lit(0)).alias("failing")) for rule, n in rules.items()]
    return counted[table].agg(F.array(*told).alias("told")).select(F.inline("told"))


def _one_rule(rule: str, failing: DataFrame, n: Column) -> DataFrame:
    return failing.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failing")).select(F.lit(rule).alias("rule"), "failing")


def _orphans(counted: Mapping[str, DataFrame], child: str, column: str, parent: str, parent_column: str) -> DataFrame:
    held = _counts(counted, child, (column,)).where(F.col(column).isNotNull()).select(F.col(column).alias("_held"), "n")
    known = _counts(counted, parent, (parent_column,)).select(F.col(parent_column).alias("_known"))
    return held.join(known.hint("merge"), F.col("_held") == F.col("_known"), "left_anti")


def _overlapping(counted: Mapping[str, DataFrame]) -> DataFrame:
    """Versions still valid when a later one of their key starts."""
    found = []
    for table, key in VERSIONED.items():
        following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
        versions = _counts(counted, table, (key, "valid_from")).select(key, "valid_from", "latest")
        found.append(versions.withColumn("_next", following).where("latest > _next").select("valid_from"))
    return found[0].unionAll(found[1])


def _unbalanced(counted: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of the fact that the temporal join lost or repeated."""
    sides = []
    for sign, (table, (key, month)) in zip((1, -1), PRESERVED.items(), strict=True):
        rows = _counts(counted, table, (key, month))
        sides.append(rows.select(F.col(key).alias("_key"), F.col(month).alias("_month"), (F.col("n") * sign).alias("n")))
    return sides[0].unionAll(sides[1]).groupBy("_key", "_month").agg(F.sum("n").alias("n")).where("n <> 0")


def _uncovered(counted: Mapping[str, DataFrame], until: dt.date) -> DataFrame:
    (rows, period), (versions, recorded) = COVERED.items()
    seen = _counts(counted, rows, (period,)).where(F.col(period) <= F.lit(until)).select(F.col(period).alias("_seen"))
    known = _counts(counted, versions, (recorded,)).select(F.col(recorded).alias("_known"))
    return seen.join(known, F.col("_seen") == F.col("_known"), "left_anti")


def rule_counts(tables: Mapping[str, DataFrame], until: dt.date, at_once: int = 3) -> DataFrame:
    """(rule, failing), one row for each of the 26 rules; 0 for a rule that holds.

    ``failing`` counts rows with a NULL, keys that repeat, child rows without a parent, versions that overlap a later one,
    fact keys that the join lost or repeated, and months without versions. Each table is scanned once, for counts that
    are written to the shared folder and from which every rule is told; tables are counted side by side.
    """
    with ThreadPoolExecutor(at_once) as pool:
        planned = rule_tallies(tables)
        written = pool.map(lambda table: written_once(planned[table], "tally"), planned)
        counted = dict(zip(planned, written, strict=True))
    told = [rules for table in KEY_SETS if (rules := _own_rules(counted, table)) is not None]
    for child, column, parent, parent_column in RELATED:
        orphans = _orphans(counted, child, column, parent, parent_column)
        told.append(_one_rule(f"related {child}({column}) to {parent}", orphans, F.sum("n")))
    told.append(_one_rule("no overlap", _overlapping(counted), F.count(F.lit(1))))
    told.append(_one_rule("mart join preserves fact rows", _unbalanced(counted), F.count(F.lit(1))))
    told.append(_one_rule("snapshots cover all months", _uncovered(counted, until), F.count(F.lit(1))))
    every = told[0]
    for rules in told[1:]:
        every = every.unionAll(rules)
    return every


class ChecksFailed(RuntimeError):
    """Some rules of a build do not hold."""


def require_all(counts: DataFrame) -> None:
    """Raise with the names of the rules that do not hold and what each counts as failing."""
    failed = {row.rule: row.failing for row in counts.where("failing > 0").collect()}  # at most one row a rule
    if failed:
        raise ChecksFailed(", ".join(f"{name}: {n}" for name, n in failed.items()))
