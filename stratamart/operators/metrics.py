"""Shared metric set per group and period, exact medians, change between periods.

Group sizes are taken to be unbounded. Everything is combined inside map tasks first:
distinct members come from a (group, member) aggregate instead of a distinct count next to
other aggregates, which would copy every row once per distinct column; medians come from
value counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.numbers import percent_change, percent_of

# Large values within 0.1 percent of each other share a bucket.
_BUCKETS_PER_E_FOLD = 1024
# Equal pieces that a bucket holding a wanted rank is cut into.
_PIECES = 1024


@dataclass(frozen=True)
class MetricColumns:
    """Input columns of the metric set, one row per listing and month."""

    member: str = "host_id"
    featured: str = "host_is_superhost"
    active: str = "has_availability"
    price: str = "price"
    rating: str = "review_scores_rating"
    units: str = "booked_nights_30"
    revenue: str = "est_revenue_30"


def _listed(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def exact_quantile(
    df: DataFrame, keys: Sequence[str], value: str, name: str, q: float = 0.5
) -> DataFrame:
    """Interpolated quantile of the non-NULL values of each group, without collecting a group.

    Values are counted per (group, value), then per (group, bucket) of neighbouring values; the
    bucket number never falls as the value rises. The bucket counts tell which one or two buckets
    hold the wanted ranks; only those are cut again into pieces of equal width, and only the pieces
    that hold the ranks are looked at value by value. A group is thus spread over as many tasks as
    it has values, and the ordered passes see bucket counts, piece counts or the values of a single
    piece, a thousandth of a bucket's width.
    """
    if not keys:
        whole = df.select(F.lit(0).alias("_whole"), value)
        return exact_quantile(whole, ["_whole"], value, name, q).drop("_whole")
    is_decimal = df.schema[value].dataType.typeName() == "decimal"
    part = "cast(part AS decimal(10,9))" if is_decimal else "part"  # exact middle of amounts
    group = _listed(keys)
    same_group = " AND ".join(f"c.`{k}` <=> w.`{k}`" for k in keys)
    return df.sparkSession.sql(
        f"""
        WITH counts AS (
          -- never NULL, so that no side of the join below gets a filter of its own: both read one shuffle
          SELECT *, coalesce(floor(signum(x) * log1p(abs(x)) * {_BUCKETS_PER_E_FOLD}), 0L) AS bucket
          FROM (
            SELECT {group}, `{value}` AS value, cast(`{value}` AS double) AS x, count(*) AS n
            FROM {{df}} WHERE `{value}` IS NOT NULL GROUP BY {group}, `{value}`
          )
        ),
        buckets AS (
          SELECT {group}, bucket, n, least_x, most_x,
                 sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto,
                 (sum(n) OVER (PARTITION BY {group}) - 1) * {q}D AS position
          FROM (
            SELECT {group}, bucket, sum(n) AS n, min(x) AS least_x, max(x) AS most_x
            FROM counts GROUP BY {group}, bucket
          )
        ),
        wanted AS (
          SELECT {group}, bucket, upto - n AS before, floor(position) AS low,
                 ceil(position) AS high, position - floor(position) AS part, least_x,
                 nullif(most_x - least_x, 0D) AS width
          FROM buckets WHERE upto > floor(position) AND upto - n <= ceil(position)
        ),
        -- the wanted buckets cut again into equal pieces; dealt out once, for the sums and for the values
        pieces AS (
          SELECT /*+ REPARTITION({group}, bucket, piece) */ * FROM (
            SELECT {", ".join(f"c.`{k}`" for k in keys)}, c.bucket, value, n, low, high, part, before,
                   coalesce(floor((x - least_x) / width * {_PIECES}), 0L) AS piece
            FROM counts c JOIN wanted w ON {same_group} AND c.bucket = w.bucket
          )
        ),
        sums AS (
          SELECT {group}, bucket, piece, n, low, high,
                 before + sum(n) OVER (PARTITION BY {group}, bucket ORDER BY piece) AS upto
          FROM (
            SELECT {group}, bucket, piece, sum(n) AS n, any_value(low) AS low,
                   any_value(high) AS high, any_value(before) AS before
            FROM pieces GROUP BY {group}, bucket, piece
          )
        ),
        ranked AS (
          SELECT {", ".join(f"c.`{k}`" for k in keys)}, value, c.n, c.low, c.high, part,
                 w.upto - w.n + sum(c.n) OVER (
                   PARTITION BY {", ".join(f"c.`{k}`" for k in keys)}, c.bucket, c.piece ORDER BY value
                 ) AS upto
          FROM pieces c JOIN sums w ON {same_group} AND c.bucket = w.bucket AND c.piece = w.piece
          WHERE w.upto > w.low AND w.upto - w.n <= w.high
        ),
        ends AS (
          SELECT {group}, max(part) AS part,
                 max(CASE WHEN upto - n <= low AND low < upto THEN value END) AS lower,
                 max(CASE WHEN upto - n <= high AND high < upto THEN value END) AS upper
          FROM ranked GROUP BY {group}
        )
        SELECT {group}, cast(lower + (upper - lower) * {part} AS double) AS `{name}` FROM ends
        """,
        df=df,
    )


def distinct_members(
    df: DataFrame, keys: Sequence[str], member: str, featured: str
) -> DataFrame:
    """Distinct members and distinct members with the flag set, per group."""
    per_member = df.groupBy(*keys, member).agg(F.expr(f"max(int(`{featured}`)) AS _flag"))
    return per_member.groupBy(*keys).agg(*map(F.expr, _member_counts(member)))


def _member_counts(member: str) -> list[str]:
    return [
        f"count(`{member}`) AS hosts_total",
        f"count(CASE WHEN _flag = 1 THEN `{member}` END) AS hosts_super",
    ]


def group_metrics(
    df: DataFrame, keys: Sequence[str], columns: MetricColumns | None = None
) -> DataFrame:
    """The twelve shared aggregates per group.

    Rows first shrink to one per (group, member); medians join as further partial rows, so a
    single final aggregate brings everything together and NULL groups need no special care.
    Counts of active and inactive rows leave out rows whose flag is NULL.
    """
    c = columns or MetricColumns()
    partial = [
        "count(1) AS _rows",
        f"sum(int(`{c.active}`)) AS _active",
        f"sum(int(NOT `{c.active}`)) AS _inactive",
        f"max(int(`{c.featured}`)) AS _flag",
        *[
            f"{function}(CASE WHEN `{c.active}` THEN `{column}` END) AS {name}"
            for function, column, name in (
                ("min", c.price, "_min_price"),
                ("max", c.price, "_max_price"),
                ("sum", c.price, "_price"),
                ("count", c.price, "_prices"),
                ("sum", c.rating, "_rating"),
                ("count", c.rating, "_ratings"),
                ("sum", c.units, "_units"),
                ("sum", c.revenue, "_revenue"),
                ("count", c.revenue, "_revenues"),
            )
        ],
    ]
    final = [
        "sum(_rows) AS listings_total",
        "sum(_active) AS listings_active",
        "sum(_inactive) AS listings_inactive",
        "min(_min_price) AS min_price_active",
        "max(_max_price) AS max_price_active",
        "max(_median) AS median_price_active",
        "double(sum(_price)) / nullif(sum(_prices), 0) AS avg_price_active",
        *_member_counts(c.member),
        "double(sum(_rating)) / nullif(sum(_ratings), 0) AS avg_rating_active",
        "sum(_units) AS total_stays_active",
        "double(sum(_revenue)) / nullif(sum(_revenues), 0) AS avg_est_revenue_active",
    ]
    per_member = df.groupBy(*keys, c.member).agg(*map(F.expr, partial))
    median = exact_quantile(df.where(f"`{c.active}`"), keys, c.price, "_median")
    return (
        per_member.unionByName(median, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(*map(F.expr, final))
    )


def with_changes(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    changes: Mapping[str, str],
    gap_aware: bool = False,
) -> DataFrame:
    """Percentage change against the group's previous row in time; ``changes`` maps input to output.

    The previous row is the previous period present, even across a gap; with ``gap_aware`` it is that
    of the calendar month before, and after a gap the change is NULL. ``df`` holds one row per group
    and period, so window groups are short.
    """
    if gap_aware:
        month = F.year(period) * 12 + F.month(period)
        before = Window.partitionBy(*keys).orderBy(month).rangeBetween(-1, -1)
        previous = {source: F.first(source).over(before) for source in changes}
    else:
        window = Window.partitionBy(*keys).orderBy(F.col(period).asc_nulls_last())
        previous = {source: F.lag(source).over(window) for source in changes}
    return df.withColumns(
        {name: percent_change(F.col(source), previous[source]) for source, name in changes.items()}
    )


def with_rates(df: DataFrame) -> DataFrame:
    """Share of active listings and of flagged members, in percent."""
    return df.withColumns(
        {
            "active_listings_rate": percent_of(F.col("listings_active"), F.col("listings_total")),
            "superhost_rate": percent_of(F.col("hosts_super"), F.col("hosts_total")),
        }
    )
