"""Quality rules: counts per text, and a log-likelihood ratio between trusted and raw text.

Words and word pairs are hashed into ``n_buckets`` features. Two multinomials are counted over all documents: one from
the trusted ones (labelled quality 1), one from the whole corpus. A document's score is the mean, over its words and
pairs, of log p(trusted) - log p(raw). It is kept if no base rule fails and its score reaches the threshold, the score
below which only ``loss`` of the trusted documents lie (on a grid of 1e-4): every document is decided, none at random.

Each task counts its texts into two arrays of ``n_buckets`` and sends those, so that what is shuffled does not grow
with the texts; the weights are ``n_buckets`` doubles.

* null and empty text: no words, score 0, fails the base rules (fewer than 10 words).
* no trusted document at all: every ratio is 0 and only the base rules decide.
* repeated rows are scored alike; ids labelled more than once are trusted if any label says so. A null id has no label.
* empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, small_side, stored
from stratamart.llm.text import Block, blocks, sums_per_text, text_of

N_BUCKETS = 1 << 14
LOSS = 0.005
GRID = 1e-4
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_BASE_TYPE = pa.struct([(name, pa.int64()) for name in BASE_COUNTS])
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
REPEAT = 5


def _duplicates(keys: np.ndarray, texts: np.ndarray, first_too: bool) -> np.ndarray:
    """Which items equal another item of their text; without ``first_too`` only those that equal an earlier one."""
    order = np.lexsort((keys, texts))
    same = (keys[order][1:] == keys[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    if first_too:
        out[order[:-1][same]] = True
    return out


def _duplicate_lines(text: bytes) -> int:
    seen, repeats = set(), 0
    for line in text.split(b"\n"):
        if line.split(None, 1):
            repeats += line in seen
            seen.add(line)
    return repeats


def base_counts(block: Block) -> pa.StructArray:
    """The base counts of each text of a block."""
    inside = np.zeros(len(block.data) + 1, dtype=np.int8)
    inside[block.starts] += 1
    inside[block.ends] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    chars = sums_per_text(in_word & ((block.data & 0xC0) != 0x80), block.offsets)
    symbols = sums_per_text(_SYMBOL[block.data], block.offsets)

    grams, at = block.ngrams(REPEAT)
    texts = text_of(at)
    again = _duplicates(grams, texts, first_too=True)
    # the first word of each window: windows are numbered text after text, words likewise
    word = np.arange(len(grams)) - at[:-1][texts] + block.word_offsets[:-1][texts]
    marks = np.zeros(len(block.starts) + 1, dtype=np.int64)
    np.add.at(marks, word[again], 1)
    np.subtract.at(marks, word[again] + REPEAT, 1)
    repeat_words = sums_per_text(np.cumsum(marks[:-1]) > 0, block.word_offsets)

    raw = block.data.tobytes()
    lines = [_duplicate_lines(raw[a:b]) for a, b in zip(block.offsets[:-1], block.offsets[1:])]
    columns = (block.words_per_text, chars, symbols, np.array(lines), repeat_words)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(BASE_COUNTS))


def features(block: Block, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of the word pairs, with the offset of each text's pairs."""
    pairs, at = block.ngrams(2)
    cut = np.uint64(n_buckets)
    return (block.word_hashes % cut).astype(np.int64), (pairs % cut).astype(np.int64), at


def _count(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(n_buckets, dtype=np.int64), np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            flags = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for block in blocks(batch.column("text")):
                words, pairs, at = features(block, n_buckets)
                own = flags[block.first : block.first + len(block)]
                for buckets, offsets in ((words, block.word_offsets), (pairs, at)):
                    raw += np.bincount(buckets, minlength=n_buckets)
                    trusted += np.bincount(buckets[own[text_of(offsets)]], minlength=n_buckets)
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(raw[held]), pa.array(trusted[held])], names=["bucket", "raw", "trusted"])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_trusted")).distinct()


def ratios(docs: DataFrame, trusted: DataFrame, n_buckets: int = N_BUCKETS) -> np.ndarray:
    """log p(trusted) - log p(raw) of each bucket, both smoothed by one; counted over all documents."""
    ship(docs.sparkSession)
    flagged = docs.join(small_side(trusted), F.col("doc_id") == F.col("_trusted"), "left").select(
        "text", F.col("_trusted").isNotNull().alias("trusted")
    )
    counted = flagged.mapInArrow(_count(n_buckets), "bucket long, raw long, trusted long")
    counts = np.zeros((2, n_buckets))
    for bucket, raw, good in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("trusted")).collect():
        counts[:, bucket] = good, raw
    if not counts[0].any():
        return np.zeros(n_buckets)
    share = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    return np.log(share[0]) - np.log(share[1])


def scorer(spark: SparkSession, weights: np.ndarray):
    """Column function: the base counts and the score of a text."""
    shared = ship(spark).broadcast(weights)
    n_buckets = len(weights)
    kind = ", ".join(f"{name}: bigint" for name in BASE_COUNTS)

    @F.arrow_udf(f"struct<{kind}, score: double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = shared.value
        for texts in batches:
            parts = []
            for block in blocks(texts):
                words, pairs, at = features(block, n_buckets)
                total = sums_per_text(weight[words], block.word_offsets) + sums_per_text(weight[pairs], at)
                n = np.diff(block.word_offsets) + np.diff(at)
                mean = np.where(n > 0, total / np.maximum(n, 1), 0.0)
                base = base_counts(block)
                parts.append(pa.StructArray.from_arrays([*base.flatten(), pa.array(mean)], names=[*BASE_COUNTS, "score"]))
            kinds = pa.struct([*_BASE_TYPE, ("score", pa.float64())])
            yield pa.concat_arrays(parts) if parts else pa.array([], kinds)

    return score


def threshold(scored: DataFrame, trusted: DataFrame, loss: float = LOSS) -> float:
    """The largest grid value that at most ``loss`` of the trusted documents' scores lie below; -inf without any."""
    own = scored.join(small_side(trusted), F.col("doc_id") == F.col("_trusted"), "left_semi")
    steps = own.groupBy(F.floor(F.col("score") / GRID).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    steps = sorted((r.step, r.n) for r in steps.collect())  # log ratios span some tens: at most about 1e6 steps
    left = loss * sum(n for _, n in steps)
    for step, n in steps:
        if n > left:
            return step * GRID
        left -= n
    return -np.inf


def judge(docs: DataFrame, labels: DataFrame, n_buckets: int = N_BUCKETS, loss: float = LOSS) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, score, threshold."""
    trusted = stored(trusted_ids(labels), "trusted")
    docs = docs.select("doc_id", "text")
    weights = ratios(docs, trusted, n_buckets)
    scored = stored(docs.select("doc_id", scorer(docs.sparkSession, weights)("text").alias("s")).select("doc_id", "s.*"), "scored")
    least = threshold(scored, trusted, loss)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.select(
        "doc_id", *BASE_COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= least)).alias("kept"),
        "score", F.lit(float(least)).alias("threshold"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
