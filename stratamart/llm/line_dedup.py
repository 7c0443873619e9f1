"""Line de-duplication over overlapping three-line windows.

Texts are split at newlines. Every run of three consecutive lines is hashed (two independent 64-bit hashes); a window
that is found more than once anywhere keeps its first occurrence, by document id and then by place in the text. The
lines that any later occurrence covers are removed: overlapping windows merge into one removed span.

The windows are counted with map-side combine, so a passage held by a third of all documents arrives at the count as
one row per task. Only the windows that repeat are joined back, and a frequent one is split by adaptive execution.
Texts are never shuffled by the window steps; the removal joins the narrow line lists back by document.

* null text: no lines, unchanged. Fewer than three lines: no window, unchanged. Windows without any visible
  character (three blank lines) are left alone.
* rows equal in id and text share one identity: a window's first occurrence stays in each of them. Rows that share
  only the id (or a null id, which sorts last) are told apart, and ordered, by their texts' hashes.
* empty table: an empty result. Columns other than id and text are carried along under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.storage import documents, own_columns, small_side, stored

WINDOW = 3


def _identity(key: Column, text: Column) -> list[Column]:
    return [key.alias("_key"), F.xxhash64(F.lit(1), text).alias("_tag")]


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """_key, _tag, place (0-based line), h1, h2: one row per window of ``size`` lines."""
    lines = F.split(F.col(text_col), "\n", -1)
    starts = F.when(F.size(lines) >= size, F.sequence(F.lit(0), F.size(lines) - size))
    rows = docs.select(*_identity(F.col(id_col), F.col(text_col)), lines.alias("lines"), starts.alias("starts"))
    joined = F.transform("starts", lambda at: F.array_join(F.slice("lines", at + 1, F.lit(size)), "\n"))
    rows = rows.select("_key", "_tag", F.posexplode(joined).alias("place", "window"))
    return rows.where(F.col("window").rlike(r"[^\x20\x09-\x0D]")).select(
        "_key", "_tag", "place", F.xxhash64(F.lit(1), "window").alias("h1"), F.xxhash64(F.lit(2), "window").alias("h2")
    )


def repeated(found: DataFrame) -> DataFrame:
    """h1, h2 and the first occurrence of each window that is found more than once."""
    order = F.struct(F.col("_key").isNull().alias("last"), "_key", "_tag", "place")
    counted = found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counted.where("n > 1").select("h1", "h2", "first")


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """_key, _tag, removed: per document with any, the sorted 0-based lines that later occurrences cover."""
    found = windows(docs, id_col, text_col, size)
    twice = stored(repeated(found), "windows")
    later = found.join(small_side(twice), ["h1", "h2"]).where(
        ~(F.col("_key").eqNullSafe(F.col("first._key")) & (F.col("_tag") == F.col("first._tag")) & (F.col("place") == F.col("first.place")))
    )
    places = later.groupBy("_key", "_tag").agg(F.collect_set("place").alias("places"))
    spread = F.flatten(F.transform("places", lambda p: F.sequence(p, p + size - 1)))
    return places.select("_key", "_tag", F.array_sort(F.array_distinct(spread)).alias("removed"))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """_row (the document as it came), removed (the cut places), text (what stays)."""
    cut = stored(covered_lines(docs, id_col, text_col, size), "covered")
    packed = docs.select(F.struct(*own_columns(docs)).alias("_row"))
    key, text = F.col(f"_row.`{id_col}`"), F.col(f"_row.`{text_col}`")
    named = packed.select("_row", *_identity(key, text))
    cut = cut.select(F.col("_key").alias("_k"), F.col("_tag").alias("_t"), F.col("removed").alias("_removed"))
    joined = named.join(small_side(cut), F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_tag") == F.col("_t")), "left")
    joined = joined.withColumn("_lines", F.when(F.col("_removed").isNotNull(), F.split(text, "\n", -1)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_removed"))
    kept_text = F.array_join(F.transform(kept, lambda at: F.get("_lines", at)), "\n")
    shorter = F.when(F.col("_removed").isNull(), text).otherwise(kept_text)
    removed = F.coalesce(F.col("_removed"), F.array().cast("array<int>"))
    return joined.select("_row", removed.alias("removed"), shorter.alias("text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut out of the text."""
    cut = cut_texts(docs, id_col, text_col, size)
    return cut.select(F.col("_row").withField(f"`{text_col}`", F.col("text")).alias("_row")).select("_row.*")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines and removed lines, and the md5 of what stays."""
    out = cut_texts(documents(spark, sf_dir).select("doc_id", "text"))
    before = F.col("_row.text")
    return out.select(
        "_row.doc_id",
        F.when(before.isNull(), F.lit(0)).otherwise(F.size(F.split(before, "\n", -1))).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"),
        F.md5("text").alias("kept_md5"),
    )


#: From the definition. Texts with fewer than three lines have no window.
OP1_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(lines) - 2)) AS place, lines FROM l WHERE len(lines) >= 3),
t AS (SELECT doc_id, place, array_to_string(lines[place + 1:place + 3], chr(10)) AS win FROM w),
r AS (SELECT doc_id, place, win, row_number() OVER (PARTITION BY win ORDER BY doc_id, place) AS nth FROM t
      WHERE regexp_matches(win, '[^\x20\x09-\x0D]')),
c AS (SELECT DISTINCT doc_id, place + k AS line FROM r, range(0, 3) x(k) WHERE nth > 1),
g AS (SELECT doc_id, list(line ORDER BY line) AS removed FROM c GROUP BY doc_id),
u AS (SELECT doc_id, unnest(lines) AS one, unnest(range(0, len(lines))) AS line FROM l JOIN g USING (doc_id)),
k AS (SELECT doc_id, string_agg(one, chr(10) ORDER BY line) AS kept FROM u ANTI JOIN c USING (doc_id, line) GROUP BY doc_id)
SELECT l.doc_id,
  CASE WHEN text IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines,
  coalesce(len(removed), 0)::BIGINT AS n_removed,
  coalesce(array_to_string(removed, ','), '') AS removed_lines,
  md5(CASE WHEN removed IS NULL THEN text ELSE coalesce(kept, '') END) AS kept_md5
FROM l LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""
