"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Symbols are the bytes of the text; before a text stand ``ORDER - 1`` line ends. The model is trained on the documents
labelled quality 1 of the learning folds. One pass over the corpus gives every n-gram of any document with its count
in trusted text; counts, continuation counts, discounts and back-off masses are then joined by n-gram, order by order,
in tables sharded by n-gram, up to one log probability for each n-gram of the corpus. Nothing is cut off.

A second pass takes each document as its n-grams with their counts. The log probabilities of the ``HOT`` most frequent
n-grams, a table of fixed size that every task holds, are summed where they are found: as keys of a join they would be
the skewed ones. All others are joined with their log probabilities by n-gram and summed per document; so one pass does,
whatever the number of n-grams, and none of them passes through the driver. Sums are of whole numbers, in units of
``2 ** -UNIT_BITS`` and, for what that leaves, of ``4 ** -UNIT_BITS``, and do not depend on their order. A document is kept if its perplexity (per byte) does not exceed
its language's threshold: the quantile ``QUANTILE`` of the trusted documents held out from training, on a grid of 1e-4
of the logarithm. As single outliers would set the quantile of a few texts, a language with ``n`` of them takes
``n / (n + DRAWN)`` of its own threshold and the rest of that of all languages; one without any uses that of all, and
without any at all everything is kept.

* null and empty text: no perplexity (null), not kept. Null language: a language of its own.
* repeated rows score alike; of an id labelled more than once any trusted label counts. Null ids have no label.
* no trusted text: all n-grams are equally likely. Empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, small_side, stored
from stratamart.llm.text import Block, blocks, sums_per_text, text_of

ORDER = 5
SYMBOLS = 256
FOLDS = 5
QUANTILE = 0.97  # misses of trusted and passes of untrusted held-out documents are near equal there, see the README
DRAWN = 10
GRID = 1e-4
HOT = 1 << 18
UNIT_BITS = 30


def grams(block: Block, order: int) -> np.ndarray:
    """For each byte of the block, itself and the ``order - 1`` symbols before it in its text, as one number."""
    lead = order - 1
    sizes = np.diff(block.offsets)
    at = np.arange(len(block.data)) + lead * (np.repeat(np.arange(len(block)), sizes) + 1)
    padded = np.full(len(block.data) + lead * (len(block) + 1), 0x0A, dtype=np.uint8)
    padded[at] = block.data
    out = np.zeros(len(block.data), dtype=np.int64)
    for back in range(lead, -1, -1):
        out <<= 8
        out |= padded[at - back]
    return out


def _count(order: int):
    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        keys, *counts = (np.concatenate(column) for column in zip(*parts))
        order_of = np.argsort(keys, kind="stable")
        keys = keys[order_of]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], *(np.add.reduceat(c[order_of], first) for c in counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for block in blocks(batch.column("text")):
                keys = grams(block, order)
                if not len(keys):
                    continue
                learns = np.repeat(trusted[block.first : block.first + len(block)], np.diff(block.offsets))
                for some, weight in ((keys[learns], 1), (keys[~learns], 0)):
                    some.sort()
                    cuts = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]])) if len(some) else np.zeros(0, dtype=np.int64)
                    seen = np.diff(np.concatenate([cuts, [len(some)]]))
                    parts.append((some[cuts], weight * seen, seen))
                    held += len(cuts)
                if held > 4_000_000:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held > 2_000_000:  # more kinds than a worker should hold: the shuffle adds them up
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["gram", "n", "seen"])
                        parts, held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(parts)], names=["gram", "n", "seen"])

    return run


def suffix(gram: Column, size: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (8 * size)) - 1))


def discounts(counted: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more, kept above 0 so that every symbol stays
    possible; fixed ones if a count of counts is 0."""
    n = list(counted.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in range(1, 5)]).first())
    if not all(n):
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), float(k)) for k in (1, 2, 3)]


def with_probabilities(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, p, seen: the probability of each n-gram's last symbol after the others. ``counted``: all n-grams of the
    corpus, n their trusted count, seen that in all texts."""
    kinds = [counted.where("n > 0").select("gram", "n")]
    wanted = [counted.select("gram", "seen")]
    for size in range(order - 1, 0, -1):  # continuation counts: by how many symbols an n-gram is preceded
        shorter = kinds[-1].groupBy(suffix(F.col("gram"), size).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        kinds.append(stored(shorter, f"kinds-{size}"))
        wanted.append(stored(wanted[-1].select(suffix(F.col("gram"), size).alias("gram")).distinct(), f"wanted-{size}"))
    below: DataFrame | None = None
    for size in range(1, order + 1):
        known, asked = kinds[order - size], wanted[order - size]
        cut = discounts(known)
        discount = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        contexts = known.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(discount).alias("taken")
        )
        rows = asked.withColumn("context", F.shiftright("gram", 8)).join(known, "gram", "left").join(contexts, "context", "left")
        if below is None:
            rows = rows.withColumn("lower", F.lit(1.0 / SYMBOLS))
        else:
            lower = below.select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
            rows = rows.withColumn("rest", suffix(F.col("gram"), size - 1)).join(lower, "rest")
        own = F.coalesce((F.col("n") - discount) / F.col("total"), F.lit(0.0))
        p = F.when(F.col("total").isNull(), F.col("lower")).otherwise(own + F.col("taken") / F.col("total") * F.col("lower"))
        seen = ["seen"] if size == order else []
        below = stored(rows.select("gram", p.alias("p"), *seen), f"probabilities-{size}")
    return below


def _met(shared, order: int):
    """Column function: text to the sum over its n-grams that all tasks hold, and the others with their counts."""

    @F.arrow_udf("struct<whole: bigint, part: bigint, rest: array<struct<gram: bigint, n: int>>>")
    def met(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, *values = shared.value
        for texts in batches:
            for block in blocks(texts):  # handed over block by block: memory follows the block
                found = grams(block, order)
                at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
                known = keys[at] == found if len(keys) else np.zeros(len(found), dtype=bool)
                sums = []
                for units in values:
                    own = np.zeros(len(found), dtype=np.int64)
                    own[known] = units[at[known]]
                    sums.append(pa.array(sums_per_text(own, block.offsets)))
                text, rest = text_of(block.offsets)[~known], found[~known]
                by = np.lexsort((rest, text))
                text, rest = text[by], rest[by]
                first = np.ones(len(rest), dtype=bool)
                first[1:] = (rest[1:] != rest[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(first)
                n = np.diff(np.append(first, len(rest))).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(rest[first]), pa.array(n)], names=["gram", "n"])
                edges = np.searchsorted(text[first], np.arange(len(block) + 1)).astype(np.int32)
                yield pa.StructArray.from_arrays(
                    [*sums, pa.ListArray.from_arrays(pa.array(edges), pairs)], names=["whole", "part", "rest"]
                )

    return met


def log_sums(docs: DataFrame, probabilities: DataFrame, order: int = ORDER, hot: int = HOT) -> DataFrame:
    """doc_id, lang, n_bytes, log_p: the sum of the log probabilities of all symbols of each text."""
    context = ship(docs.sparkSession)
    unit = float(1 << UNIT_BITS)
    scaled = F.log("p") * unit
    known = probabilities.select("gram", "seen", F.round(scaled).cast("long").alias("whole"), F.round((scaled - F.round(scaled)) * unit).cast("long").alias("part"))
    common = known.orderBy(F.desc("seen"), "gram").limit(hot).select("gram", "whole", "part").toArrow()
    by = np.argsort(common.column("gram").to_numpy())
    met = _met(context.broadcast(tuple(column.to_numpy()[by] for column in common.columns)), order)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes")
    rows = docs.select("doc_id", "lang", size, F.monotonically_increasing_id().alias("_row"), met("text").alias("m"))
    rows = stored(rows.select("doc_id", "lang", "n_bytes", "_row", "m.*"), "document-grams")
    rest = rows.select("_row", F.inline("rest")).join(known.drop("seen"), "gram")
    rest = rest.groupBy("_row").agg(*[F.sum(F.col("n") * F.col(c)).alias(f"rest_{c}") for c in ("whole", "part")])
    joined = rows.drop("rest").join(rest, "_row", "left")
    whole, part = (F.col(c) + F.coalesce(f"rest_{c}", F.lit(0)) for c in ("whole", "part"))
    return joined.select("doc_id", "lang", "n_bytes", (whole / unit + part / unit / unit).alias("log_p"))


def thresholds(held: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """lang, limit (log perplexity) and number of the held-out trusted documents; the row of all languages is marked by every."""
    steps = held.groupBy("lang", F.ceil(F.col("log_ppl") / GRID).alias("step")).agg(F.count(F.lit(1)).alias("n")).select("lang", F.lit(False).alias("every"), "step", "n")
    both = steps.unionByName(steps.groupBy("step").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), F.lit(True).alias("every"), "step", "n"))
    listed = both.groupBy("lang", "every").agg(F.array_sort(F.collect_list(F.struct("step", "n"))).alias("steps"), F.sum("n").alias("total"))
    # some thousands of steps at most: log perplexities of bytes lie between 0 and some tens
    upto = F.aggregate(
        "steps",
        F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("limit")),
        lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.when(acc["seen"] < F.ceil(F.col("total") * quantile), x["step"]).otherwise(acc["limit"]).alias("limit"),
        ),
    )
    return listed.select("lang", "every", (upto["limit"] * GRID).alias("limit"), "total")


def own_limit(every: float, drawn: int = DRAWN) -> Column:
    """A language's limit, drawn towards that of all languages, the more the fewer texts it rests on."""
    share = F.col("total") / (F.col("total") + drawn)
    return share * F.col("limit") + (1 - share) * every


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, hot: int = HOT) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, limit, kept."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang")
    trusted = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    held_out = F.crc32(F.col("_id").cast("string")) % FOLDS == 0
    learn, held = stored(trusted.where(~held_out), "learn"), stored(trusted.where(held_out), "held")
    flagged = docs.join(small_side(learn), F.col("doc_id") == F.col("_id"), "left").select("text", F.col("_id").isNotNull().alias("trusted"))
    counted = flagged.mapInArrow(_count(order), "gram long, n long, seen long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    probabilities = with_probabilities(stored(counted, "grams"), order)
    sums = log_sums(docs, probabilities, order, hot)
    scored = stored(sums.withColumn("log_ppl", F.when(F.col("n_bytes") > 0, -F.col("log_p") / F.col("n_bytes"))), "perplexity")

    limits = stored(thresholds(scored.where("log_ppl IS NOT NULL").join(small_side(held), F.col("doc_id") == F.col("_id"), "left_semi"), quantile), "limits")
    every = limits.where("every").select("limit").collect()
    most = every[0].limit if every else float("inf")
    by_language = limits.where("NOT every").select(F.col("lang").alias("_lang"), own_limit(most).alias("own"))
    limit = F.coalesce(F.col("own"), F.lit(most))
    joined = scored.join(small_side(by_language), F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("limit", limit)
    return joined.select(
        "doc_id", "lang", F.col("n_bytes").cast("long").alias("n_bytes"), F.exp("log_ppl").alias("perplexity"),
        F.exp("limit").alias("limit"), F.coalesce(F.col("log_ppl") <= F.col("limit"), F.lit(False)).alias("kept"),
    )


def op3_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
