"""Session settings the plans rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # runtime re-planning: small shuffled sides become broadcasts, small partitions are merged
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split reducers that a busy key has made large, in joins and in rebalanced writes
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # strict casts: malformed text fails the run
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # call sites of columns are not needed; looking them up slows building large plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def short_methods(spark: SparkSession, limit: int = 3000) -> Iterator[None]:
    """Plans that run inside evaluate wide projections in many short methods, not in one of more than ``limit`` bytes.

    The JVM compiles a long method only after millions of rows, and one of over 8,000 bytes never; until then it is
    interpreted. Set for the session while it lasts: other plans that run meanwhile only differ in speed.
    """
    before = spark.conf.get(_METHOD_LIMIT, None)
    spark.conf.set(_METHOD_LIMIT, limit)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_METHOD_LIMIT)
        else:
            spark.conf.set(_METHOD_LIMIT, before)


def builder(name: str = "stratamart") -> SparkSession.Builder:
    build = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        build = build.config(key, value)
    return build
