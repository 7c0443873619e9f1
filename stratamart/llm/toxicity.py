"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the runs of 5 and of 7 bytes of the lower-cased text, hashed into ``N_BUCKETS``; a text has a feature or
has not. The log-count ratio of each feature is counted over all labelled rows of the learning folds, and smoothed so
that a feature without evidence has the ratio 0. A logistic classifier on all features times their ratios is then fitted
on all those rows, both classes weighing the same. Weight times ratio is one number per feature, so that a score is a sum
over a text's distinct features.

The features of labelled rows are listed once, in a table written for the time of the training; counts, every pass of the
fit, and the scores that set the bias come from it. The tasks of a pass hold one batch of rows and one number per bucket,
and send the latter to the driver, at most ``MOST_TASKS`` times 4 MB; the driver holds some 20 numbers per bucket, and of
the labelled rows one byte each, and nine each of those that set the bias.

The bias puts the score 0.5 where the share of missed toxic rows and the share of clean rows flagged are smallest in
sum, among all labelled rows that neither the ratios nor the fit have seen: one of ``CUT_FOLDS`` parts of the learning
folds. How rare toxic labels are does not move it. If that part lacks a class, the bias stays as it was fitted.

* null and empty text, and text shorter than 4 bytes: no feature, the score of the bias alone.
* rows of one id share its labels; an id labelled both ways counts as toxic. Repeated rows score alike. Of the rows of
  one id, all count in the ratios, and the one with the smallest text hash is in the fit or sets the bias.
* no labelled row of one of the classes: every score is 0, none is predicted toxic. Empty table: an empty result.
* extra columns are carried by ``without_toxic`` and ignored else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.linear import fit_passes as fit
from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, passing_folder, small_side, stored
from stratamart.llm.text import Block, blocks, char_ngrams, distinct_per_text, lowered, text_of

N_BUCKETS = 1 << 20
SIZES = (5, 7)
CUT_FOLDS = 5
SMOOTHING = 100
LEAST_RATIO = 0.0
FOLDS = 5
MOST_TASKS = 16
PASSES = 40
PIECE_BYTES = 2 << 20
#: In a list of gaps: go on by so many buckets, none of which is held.
_FAR = (1 << 16) - 1
_LISTED = "_id long, toxic int, cut boolean, row long, hash long, last int, gaps binary"


def distinct_features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets of each text, text after text, and the texts' offsets into them."""
    data = lowered(block.data)
    parts = [char_ngrams(data, block.offsets, n, N_BUCKETS) for n in SIZES]
    buckets = np.concatenate([b for b, _ in parts])
    texts = np.concatenate([text_of(at) for _, at in parts])
    return distinct_per_text(buckets, texts, len(block), N_BUCKETS)


def packed(buckets: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Each text's buckets as the gaps between them, two bytes a gap, and its last bucket (0 if it has none)."""
    buckets, sizes = buckets.astype(np.int64), np.diff(at)
    gaps = np.diff(buckets, prepend=0)
    firsts = at[:-1][sizes > 0]
    gaps[firsts] = buckets[firsts]
    ends = np.cumsum(gaps // _FAR + 1)
    out = np.full(ends[-1] if len(ends) else 0, _FAR, dtype=np.uint16)
    out[ends - 1] = gaps % _FAR
    offsets = np.concatenate([[0], ends])[at].astype(np.int32) * 2
    last = np.zeros(len(sizes), dtype=np.int32)
    last[sizes > 0] = buckets[at[1:][sizes > 0] - 1]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(out)]), last


def unpacked(gaps: pa.Array, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets, text after text, and the texts' offsets into them."""
    gaps = gaps.cast(pa.large_binary())
    at = np.frombuffer(gaps.buffers()[1], dtype=np.int64)[gaps.offset : gaps.offset + len(gaps) + 1]
    data = gaps.buffers()[2]
    steps = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]].view(np.uint16) if data is not None else np.zeros(0, np.uint16)
    at = (at - at[0]) // 2
    held = np.diff(at) > 0
    moves = steps.astype(np.int64)
    moves[at[:-1][held][1:]] -= last[held][:-1]
    index = np.cumsum(moves)
    keep = steps != _FAR
    if not keep.all():
        index, at = index[keep], np.concatenate([[0], np.cumsum(keep)])[at]
    return index, at


def _list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["_id", "toxic", "cut", "row", "hash"]
    for batch in batches:
        for block in blocks(batch.column("text")):
            gaps, last = packed(*distinct_features(block))
            columns = [batch.column(c).slice(block.first, len(block)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(last), gaps], names=[*kept, "last", "gaps"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """toxic, buckets, offsets of listed rows, in pieces of about ``PIECE_BYTES`` of gaps or one row."""
    for batch in batches:
        toxic, last = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "last"))
        gaps = batch.column("gaps").cast(pa.large_binary())
        at = np.frombuffer(gaps.buffers()[1], dtype=np.int64)[gaps.offset : gaps.offset + len(gaps) + 1]
        first = 0
        while first < len(gaps):
            end = max(int(np.searchsorted(at, at[first] + PIECE_BYTES, side="right")) - 1, first + 1)
            yield toxic[first:end], *unpacked(gaps.slice(first, end - first), last[first:end])
            first = end


def _summed(rows: DataFrame, vector: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over tasks of the ``size`` numbers that ``vector`` makes of a task's listed rows."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = vector(batches)
        yield pa.RecordBatch.from_arrays([pa.array([made.dtype.str]), pa.array([made.tobytes()])], names=["type", "numbers"])

    tasks = min(max(rows.sparkSession.sparkContext.defaultParallelism, 1), MOST_TASKS)
    found = rows.select("toxic", "last", "gaps").coalesce(tasks).mapInArrow(parts, "type string, numbers binary").toArrow()
    total = np.zeros(size)
    for kind, numbers in zip(found.column("type").to_pylist(), found.column("numbers")):
        total += np.frombuffer(numbers.as_buffer(), dtype=kind)
    return total


def _counts(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    """How many clean rows hold each bucket, then how many toxic ones."""
    counts = np.zeros((2, N_BUCKETS), dtype=np.int32)
    for toxic, buckets, at in _listed(batches):
        own = np.repeat(toxic, np.diff(at))
        for label in (0, 1):
            counts[label] += np.bincount(buckets[own == label], minlength=N_BUCKETS).astype(np.int32)
    return counts.ravel()


class _Scaled:
    """Listed rows, each bucket they hold worth its ratio."""

    def __init__(self, rows: DataFrame, ratio: np.ndarray):
        self.rows, self.ratio, self.width = rows, ratio, len(ratio)

    def evaluate(self, weights: np.ndarray, bias: float, shares: dict[int, float]) -> tuple[float, np.ndarray, float]:
        """Loss, its slopes and its slope in the bias, at 4 bytes a bucket to and from each task."""
        shared = self.rows.sparkSession.sparkContext.broadcast((weights * self.ratio).astype(np.float32))
        width = self.width

        def one_pass(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            weight, slopes, loss, bias_slope = shared.value, np.zeros(width), 0.0, 0.0
            for toxic, buckets, at in _listed(batches):
                side, share = np.where(toxic > 0, 1.0, -1.0), np.where(toxic > 0, shares[1], shares[-1])
                margin = side * (_sums(weight, buckets, at) + bias)
                loss += share @ np.logaddexp(0, -margin)
                slope = -side * share / (1 + np.exp(np.clip(margin, -500, 500)))
                bias_slope += slope.sum()
                slopes += np.bincount(buckets, weights=np.repeat(slope, np.diff(at)), minlength=width)
            return np.append(slopes, [loss, bias_slope]).astype(np.float32)

        found = _summed(self.rows, one_pass, width + 2)
        shared.destroy()
        return float(found[-2]), found[:-2] * self.ratio, float(found[-1])


def _sums(weight: np.ndarray, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each text's sum of its buckets' weights."""
    total = np.concatenate([[0.0], np.cumsum(weight[buckets], dtype=np.float64)])
    return total[at[1:]] - total[at[:-1]]


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for toxic, buckets, at in _listed(batches):
            yield pa.RecordBatch.from_arrays([pa.array(toxic), pa.array(_sums(shared.value, buckets, at))], names=["toxic", "score"])

    return run


def held_out(key: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def learning_labels(labels: DataFrame) -> DataFrame:
    """_id, toxic: one row per labelled id of the learning folds."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def sets_cut(key: Column) -> Column:
    """Whether a labelled id of the learning folds sets the bias, instead of being learnt."""
    return F.pmod(F.xxhash64(F.lit(3), key), F.lit(CUT_FOLDS)) == 0


def balanced_cut(toxic: np.ndarray, clean: np.ndarray) -> float:
    """The cut with the smallest sum of the share of toxic scores below it and of clean scores above; of several, the
    one whose two shares are nearest, then the one in the widest gap between scores."""
    scores = np.unique(np.concatenate([toxic, clean]))
    if len(scores) < 2:
        return float(scores[0])
    cuts, gaps = (scores[1:] + scores[:-1]) / 2, np.diff(scores)
    missed = np.searchsorted(np.sort(toxic), cuts) / len(toxic)
    alarms = 1 - np.searchsorted(np.sort(clean), cuts) / len(clean)
    return float(cuts[np.lexsort((-gaps, np.abs(missed - alarms), (missed + alarms).round(12)))[0]])


def log_ratios(counts: np.ndarray, smoothing: float = SMOOTHING, least_ratio: float = LEAST_RATIO) -> np.ndarray:
    """log p(feature | toxic) - log p(feature | clean), each class smoothed by its share of ``smoothing``; ratios nearer
    to 0 than ``least_ratio`` (0 keeps all) count as 0."""
    totals = counts.sum(axis=1, keepdims=True)
    if not totals.all():
        return np.zeros(N_BUCKETS, dtype=np.float32)
    smooth = np.log((counts + smoothing * totals / totals.sum()) / totals)
    ratio = smooth[1] - smooth[0]
    return np.where(np.abs(ratio) < least_ratio, 0, ratio).astype(np.float32)


def _one_row(rows: DataFrame, folder: str) -> DataFrame:
    """Of the listed rows of one id, the one with the smallest text hash. Written anew only if ids repeat: else the same rows."""
    several = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("hash", "row")).alias("kept")).where("n > 1")
    several = stored(several.select(F.col("_id").alias("again"), F.col("kept.row").alias("kept")), "repeated", folder=folder)
    if several.isEmpty():
        return rows
    chosen = rows.join(small_side(several), F.col("_id") == F.col("again"), "left").where("kept IS NULL OR row = kept")
    return stored(chosen.select(*rows.columns), "one_row", "zstd", folder)


def train(
    docs: DataFrame, labels: DataFrame, per_class: int | None = None, least_ratio: float = LEAST_RATIO
) -> tuple[np.ndarray, float]:
    """One weight per bucket, and the bias. ``per_class`` fits on so many rows of each class only, those with the smallest
    id hashes; ``least_ratio`` leaves out features with a smaller ratio."""
    with passing_folder(docs.sparkSession, "toxicity") as folder:
        return _train(docs, labels, per_class, least_ratio, folder)


def _train(docs: DataFrame, labels: DataFrame, per_class: int | None, least_ratio: float, folder: str) -> tuple[np.ndarray, float]:
    ship(docs.sparkSession)
    nothing = np.zeros(N_BUCKETS, dtype=np.float32), -np.inf
    every = learning_labels(labels).withColumn("cut", sets_cut(F.col("_id")))
    per_label = lambda df: {r.toxic: r.n for r in df.where("NOT cut").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids_of = per_label(every)
    if len(ids_of) < 2:
        return nothing
    texts = docs.select("doc_id", "text").join(small_side(every), F.col("doc_id") == F.col("_id"))
    marked = texts.select("_id", "toxic", "cut", F.monotonically_increasing_id().alias("row"), F.xxhash64(F.lit(1), "text").alias("hash"), "text")
    listed = stored(marked.mapInArrow(_list_features, _LISTED), "listed", "zstd", folder)
    counts = _summed(listed.where("NOT cut"), _counts, 2 * N_BUCKETS).reshape(2, N_BUCKETS)
    ratio = log_ratios(counts, min(SMOOTHING, ids_of[1] / 4), least_ratio)

    learnt = _one_row(listed, folder)
    if per_class is not None:
        first = lambda label: every.where(~F.col("cut") & (F.col("toxic") == label)).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        chosen = stored(first(0).unionByName(first(1)).select(F.col("_id").alias("first")), "first", folder=folder)
        learnt = learnt.join(small_side(chosen), F.col("_id") == F.col("first"), "left").where("cut OR first IS NOT NULL")
    rows_of = per_label(learnt)
    if len(rows_of) < 2:
        return nothing
    sides = np.repeat(np.array([1, -1], dtype=np.int8), [rows_of[1], rows_of[0]])
    weights, bias = fit(_Scaled(learnt.where("NOT cut"), ratio), sides, penalty=1e-5, steps=PASSES)
    weights = (weights * ratio).astype(np.float32)

    shared = docs.sparkSession.sparkContext.broadcast(weights)
    unseen = learnt.where("cut").select("toxic", "last", "gaps").mapInArrow(_scores(shared), "toxic int, score double").toArrow()
    toxic, score = unseen.column("toxic").to_numpy() > 0, unseen.column("score").to_numpy()
    if toxic.any() and not toxic.all():
        bias = -balanced_cut(score[toxic], score[~toxic])
    return weights, bias


def scorer(spark: SparkSession, weights: np.ndarray, bias: float):
    """Column function: text to score."""
    shared = ship(spark).broadcast(weights)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight = shared.value
        for texts in batches:
            parts = [np.zeros(0)]
            for block in blocks(texts):
                buckets, at = distinct_features(block)
                total = np.concatenate([[0.0], np.cumsum(weight[buckets], dtype=np.float64)])
                parts.append(total[at[1:]] - total[at[:-1]] + bias)
            yield pa.array(1 / (1 + np.exp(-np.clip(np.concatenate(parts), -500, 500))))

    return score


def without_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """The rows of ``docs`` whose score is below ``least``."""
    weights, bias = train(docs, labels, least_ratio=least_ratio)
    return docs.where(scorer(docs.sparkSession, weights, bias)(F.col("text")) < least)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    weights, bias = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.withColumn("score", scorer(spark, weights, bias)("text")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
