"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Targets: sources in code point order (null last) get the weights 5, 2, 1, repeating, and share 100 % of all words;
a target stops at 3 times its source's words and the excess goes to the others by weight.

Documents: each is taken ``floor(target / source words)`` whole times for certain. The rest is a Pareto order
sample: documents are ranked by random odds U / (1 - U) divided by inclusion odds, which rise with a document's
words over its source's mean (long documents are likelier, with a bound), and the sample is the longest head of the
ranking that fits into the rest, in words. Two more rounds fill the gap it leaves from the documents behind that are
no longer than the gap. A head is found by summing words over ranking bins, then by a running sum inside the one bin
that the gap ends in, so that no task sorts a whole source. U comes from an md5 of id and
text, and of a number that tells rows of the same id, text and source apart, so that each repeated row has a rank of
its own: reruns agree on how many of them are taken, not on which.

* null text, or one without words: size 0, taken 0; it still gets the whole copies. Null source: a source of its own.
* null id: U from the text alone. Empty table: an empty result. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.copies import numbered_copies, repeated
from stratamart.llm.storage import documents, own_columns, small_side, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BINS = 4096
ROUNDS = 3
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def mark(key: Column, text: Column) -> Column:
    """What a row's draw is made of, fixed by id and text."""
    return F.md5(F.concat_ws("/", F.lit(SEED), key.cast("string"), text))


def draw(mark: Column, copy: Column) -> Column:
    """Uniform in (0, 1), fixed by the mark and the row's number among those alike."""
    own = F.when(copy == 0, mark).otherwise(F.md5(F.concat_ws("/", mark, copy.cast("string"))))
    return (F.conv(F.substring(own, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def measures(key: Column, text: Column, source: Column) -> dict[str, Column]:
    return {
        "doc_id": key,
        "source": source,
        "size": F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"),
        "mark": mark(key, text),
    }


ALIKE = ["mark", "source"]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, mark."""
    columns = measures(F.col("doc_id"), F.col("text"), F.col("source"))
    return docs.select(*[x.alias(n) for n, x in columns.items()])


def drawn(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``sized`` with u. ``groups``: the repeated ones among them."""
    numbered = numbered_copies(rows, ALIKE, "nth_copy", groups)
    return numbered.withColumn("u", draw(F.col("mark"), F.col("nth_copy"))).drop("mark", "nth_copy")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source: source_size, mean, target, whole (certain copies), rest (words to sample)."""
    every = Window.partitionBy()
    order = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    cases = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    earlier = every.orderBy("full_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
        .withColumn("place", order)
        .withColumn("weight", cases)
        .withColumn("cap", F.col("source_size") * MOST_COPIES)
        .withColumn("full_at", F.col("cap").cast("double") / F.col("weight"))
        # the water level if all sources that fill up earlier are full
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
        .withColumn("level", F.col("left").cast("double") / F.col("sharing"))
        .withColumn("fill", F.row_number().over(every.orderBy("full_at", "place")))
        .withColumn("water", F.min_by(F.when(F.col("full_at") > F.col("level"), F.col("level")), F.when(F.col("full_at") > F.col("level"), F.col("fill"))).over(every))
        .withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")), F.col("cap").cast("double")))
        .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("mean", F.col("source_size").cast("double") / F.col("n"))
        .select("source", "source_size", "mean", "target", "whole", "rest")
    )


def ranked(sizes: DataFrame, per_source: DataFrame, bins: int = BINS) -> DataFrame:
    """Adds the source's columns, q (the Pareto rank value; null if never sampled) and its bin."""
    joined = sizes.join(small_side(per_source.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    share = F.col("rest") / F.col("source_size")
    odds = share / (1 - share) * (F.col("size") / (F.col("size") + F.col("mean")))
    q = F.when((F.col("size") > 0) & (F.col("rest") > 0), F.col("u") / (1 - F.col("u")) / odds)
    return joined.withColumn("q", q).withColumn("bin", F.least(F.floor(F.col("q") / (1 + F.col("q")) * bins), F.lit(bins - 1)).cast("int"))


def sampled(rounds: int) -> Column:
    """Whether a row joined with its source's cuts is in the sample after so many rounds."""
    out = F.lit(False)
    for r in range(rounds):
        below = (F.col("bin") < F.col(f"bin_{r}")) | ((F.col("bin") == F.col(f"bin_{r}")) & (F.col("q") <= F.col(f"q_{r}")))
        out = out | F.coalesce((F.col("size") <= F.col(f"gap_{r}")) & below, F.lit(False))
    return out


def next_cut(rows: DataFrame, cuts: DataFrame, r: int, bins: int = BINS) -> DataFrame:
    """Adds bin_r and q_r, the end of the longest head that fits into the open gap_r, and the gap it leaves.

    Only rows that are not in the sample yet and are no longer than the gap take part. Rows of earlier bins are in
    the head, and those of the bin that the gap ends in up to q_r; without such a bin all are.
    """
    open_rows = with_cuts(rows.where("q IS NOT NULL"), cuts).where(F.col("size") <= F.col(f"gap_{r}")).where(~sampled(r))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        open_rows.groupBy("source", "bin")
        .agg(F.sum("size").alias("words"), F.first(f"gap_{r}").alias("gap"))
        .withColumn("upto", F.sum("words").over(running))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    split = summed.where("before <= gap AND gap < upto").select(F.col("source").alias("_of"), F.col("bin").alias("_bin"), "before")
    ranking = Window.partitionBy("source").orderBy("q").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        open_rows.join(small_side(split), F.col("source").eqNullSafe(F.col("_of")) & (F.col("bin") == F.col("_bin")))
        .withColumn("upto", F.col("before") + F.sum("size").over(ranking))
        .where(F.col("upto") <= F.col(f"gap_{r}"))
        .groupBy("source")
        .agg(F.max("q").alias("q"), F.max("upto").alias("upto"))
    )
    totals = summed.groupBy("source").agg(F.sum("words").alias("words"))
    named = lambda df: df.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    out = cuts.join(split, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    out = out.join(named(inside), same, "left").drop("_source").join(named(totals), same, "left").drop("_source")
    used = F.coalesce(F.col("upto"), F.col("before"), F.col("words"), F.lit(0))
    return out.select(
        *cuts.columns,
        F.coalesce(F.col("_bin"), F.lit(bins)).alias(f"bin_{r}"),
        F.coalesce(F.col("q"), F.lit(-1.0)).alias(f"q_{r}"),
        (F.col(f"gap_{r}") - used).alias(f"gap_{r + 1}"),
    )


def with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    named = cuts.withColumnRenamed("source", "_source")
    return rows.join(small_side(named), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def all_cuts(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    cuts = per_source.select("source", F.col("rest").alias("gap_0"))
    for r in range(ROUNDS):
        cuts = stored(next_cut(rows, cuts, r), "cuts")
    return cuts


def with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds copies: the whole ones and one more for the sample."""
    return with_cuts(rows, cuts).withColumn("copies", F.col("whole") + sampled(ROUNDS).cast("long"))


def prepared(docs: DataFrame, weights: tuple[int, ...]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets per source, groups of rows alike, and all rows ranked."""
    sizes = stored(sized(docs), "sizes")
    per_source = stored(targets(sizes, weights), "targets")
    groups = repeated(sizes, ALIKE)
    numbered = drawn(sizes, groups)
    return per_source, groups, ranked(numbered if groups.isEmpty() else stored(numbered, "drawn"), per_source)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies."""
    per_source, _, rows = prepared(docs, weights)
    out = with_copies(rows, all_cuts(rows, per_source)).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: each document's row, whole, as many times as it is taken; columns as they came."""
    per_source, groups, rows = prepared(docs, weights)
    cuts = all_cuts(rows, per_source)
    packed = docs.select(F.struct(*own_columns(docs)).alias("_row"))
    named = packed.select(
        "_row", *[x.alias(n) for n, x in measures(F.col("_row.doc_id"), F.col("_row.text"), F.col("_row.source")).items()]
    )
    taken = with_copies(ranked(drawn(named, groups), per_source), cuts).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def _round(r: int) -> str:
    return f"""
o{r} AS (SELECT c{r}.*, sum(size) FILTER (NOT hit AND q IS NOT NULL AND size <= gap)
           OVER (PARTITION BY source ORDER BY (NOT hit AND q IS NOT NULL AND size <= gap) DESC, q NULLS LAST) AS upto FROM c{r}),
c{r + 1} AS (SELECT * EXCLUDE (hit, gap, upto, now), hit OR coalesce(now, false) AS hit,
           gap - coalesce(max(upto) FILTER (now) OVER (PARTITION BY source), 0) AS gap
         FROM (SELECT *, NOT hit AND q IS NOT NULL AND size <= gap AND upto <= gap AS now FROM o{r}))"""


#: The same mix, from the definition: whole sources are sorted here.
OP9_SQL = (
    r"""
WITH d AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    (('0x' || substr(own, 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  -- rows alike are told apart by their number
  FROM (SELECT doc_id, source, text, md5(concat_ws('/', 'mix', doc_id::VARCHAR, text)) AS mark,
          row_number() OVER (PARTITION BY mark, source) - 1 AS nth,
          CASE WHEN nth = 0 THEN mark ELSE md5(mark || '/' || nth::VARCHAR) END AS own FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
      FROM d GROUP BY source),
-- the level at which the shares add up to all words, if the sources with less room per weight are full
l AS (SELECT ((SELECT sum(source_size) FROM s)
          - coalesce((SELECT sum(3 * b.source_size) FROM s b WHERE b.source_size * a.weight < a.source_size * b.weight), 0))::DOUBLE
        / (SELECT sum(b.weight) FROM s b WHERE b.source_size * a.weight >= a.source_size * b.weight)::DOUBLE AS level,
        3 * a.source_size::DOUBLE / a.weight AS full_at
      FROM s a),
w AS (SELECT arg_min(level, full_at) FILTER (full_at > level) AS water FROM l),
t AS (SELECT source, source_size, source_size::DOUBLE / n AS mean,
        coalesce(least(3 * source_size::DOUBLE, water * weight), 3 * source_size::DOUBLE) AS target FROM s, w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c0 AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS gap, false AS hit,
        CASE WHEN size > 0 AND target - whole * source_size > 0 THEN
          u / (1 - u) / ((target - whole * source_size) / source_size / (1 - (target - whole * source_size) / source_size)
                         * (size::DOUBLE / (size + mean))) END AS q
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),"""
    + ",".join(_round(r) for r in range(ROUNDS))
    + f"""
SELECT doc_id, size, source_size, target, (whole + hit::INT)::BIGINT * size AS taken, source, (whole + hit::INT)::BIGINT AS copies
FROM c{ROUNDS}"""
)
