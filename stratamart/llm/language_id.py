"""Language identification in two steps: the language family first, then the language within it.

Features are the runs of 1, 2 and 3 bytes of the lower-cased text, hashed into ``N_BUCKETS`` and scaled by how much
they vary; a text is the mean over its runs. Families are told apart by one linear support vector machine per family
against the others, languages of one family by one machine per pair (one versus one): a language's votes are the
logistic margins of its pairs. All machines are fitted on at most ``PER_LANGUAGE`` learning rows of each language,
those with the smallest id hashes (the documented bound). One pass over a text serves all machines.

``FAMILIES`` maps languages to families; a language that is not listed is a family of its own.

* null text, or one without a letter: ``und``, score 0. Rows of the learning folds without a language teach nothing.
* one language only: it is predicted with score 1; none at all: ``und``. Ties go to the smaller name.
* repeated rows are predicted alike; of the rows of one id and language, the one with the smallest text hash teaches. Empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.linear import Rows, fit
from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, one_row
from stratamart.llm.text import Block, blocks, char_ngrams, lowered

N_BUCKETS = 1 << 15
SIZES = (1, 2, 3)
PER_LANGUAGE = 500
FOLDS, HELD = 3, 1
UNKNOWN = "und"
FAMILIES = {
    "germanic": ("en", "de", "nl", "da", "sv", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "sl", "hr", "sr", "bg"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lv", "lt"),
    "indic": ("hi", "bn", "mr", "ne", "gu", "pa"),
    "turkic": ("tr", "az", "kk", "uz"),
}


def family_of(language: str) -> str:
    return next((name for name, own in FAMILIES.items() if language in own), language)


@dataclass
class Model:
    """Machine k is ``weights[:, k]`` and ``bias[k]``: one per family, if there are two or more, then one per pair."""

    languages: list[str]
    families: list[str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language, and its score, of each row of margins."""
        odds = 1 / (1 + np.exp(-np.clip(margins * 3, -50, 50)))
        n = len(margins)
        family = np.ones((n, 1)) if len(self.families) < 2 else odds[:, : len(self.families)]
        family = family / np.maximum(family.sum(axis=1, keepdims=True), 1e-12)
        best = family.argmax(axis=1)
        votes, rivals = np.zeros((n, len(self.languages))), np.zeros(len(self.languages))
        first_pair = 0 if len(self.families) < 2 else len(self.families)
        for k, (a, b) in enumerate(self.pairs, first_pair):
            for name, share in ((a, odds[:, k]), (b, 1 - odds[:, k])):
                at = self.languages.index(name)
                votes[:, at] += share
                rivals[at] += 1
        votes = np.where(rivals > 0, votes / np.maximum(rivals, 1), 1.0)
        own = np.array([self.families.index(family_of(x)) for x in self.languages])
        votes = np.where(own == best[:, None], votes, -1.0)
        chosen = votes.argmax(axis=1)
        rows = np.arange(n)
        return chosen, votes[rows, chosen] * family[rows, best]


def grams(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    data = lowered(block.data)
    return [char_ngrams(data, block.offsets, n, N_BUCKETS) for n in SIZES]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            parts = grams(block)
            lists, shares = [], []
            for i in range(len(block)):
                counts = np.bincount(np.concatenate([b[at[i] : at[i + 1]] for b, at in parts]), minlength=N_BUCKETS)
                held = np.flatnonzero(counts)
                lists.append(held.astype(np.int32))
                shares.append((counts[held] / max(counts.sum(), 1)).astype(np.float32))
            languages = batch.column("lang").slice(block.first, len(block))
            yield pa.RecordBatch.from_arrays(
                [languages, pa.array(lists, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32()))],
                names=["lang", "buckets", "shares"],
            )


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD, F.lit(False))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang")
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text RLIKE '\\\\p{L}'").where(~held_out(F.col("doc_id")))
    ids = known.select("doc_id", "lang").distinct().withColumn("hash", F.xxhash64("doc_id"))
    for part in ([F.pmod("hash", F.lit(64))], []):  # a language may hold most rows: first within 64 parts of it
        order = Window.partitionBy("lang", *part).orderBy("hash", "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language).drop("nth")
    sample = F.broadcast(ids.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")))  # per_language of each language
    rows = known.join(sample, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")))
    rows = one_row(rows, "_lang", "_id").select("text", "lang")
    table = rows.mapInArrow(_frequencies, "lang string, buckets array<int>, shares array<float>").toArrow()
    named = np.array(table.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(named))
    if not languages:
        return Model([], [], [], np.zeros((N_BUCKETS, 0)), np.zeros(0))
    lists, shares = (table.column(c).combine_chunks() for c in ("buckets", "shares"))
    offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
    index, values = lists.flatten().to_numpy(), shares.flatten().to_numpy().astype(np.float64)
    squares = np.bincount(index, weights=values**2, minlength=N_BUCKETS) / len(named)
    spread = np.sqrt(np.maximum(squares - (np.bincount(index, weights=values, minlength=N_BUCKETS) / len(named)) ** 2, 0))
    scale = np.where(spread > 0, 1 / (spread + spread[spread > 0].mean()), 0) / np.sqrt(N_BUCKETS) * 8

    def machine(rows_in: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, float]:
        keep = np.repeat(rows_in, np.diff(offsets))
        at = np.concatenate([[0], np.cumsum(np.diff(offsets)[rows_in])])
        sides = np.where(positive[rows_in], 1.0, -1.0)
        weights, bias = fit(Rows(index[keep], (values * scale[index])[keep], at, N_BUCKETS), sides, "squared_hinge", steps=100)
        return weights * scale, bias

    families = sorted({family_of(x) for x in languages})
    pairs = [(a, b) for a, b in combinations(languages, 2) if family_of(a) == family_of(b)]
    everyone, kin = np.ones(len(named), dtype=bool), np.array([family_of(x) for x in named], dtype=object)
    machines = [machine(everyone, kin == name) for name in families] if len(families) > 1 else []
    machines += [machine((named == a) | (named == b), named == a) for a, b in pairs]
    weights = np.stack([w for w, _ in machines], axis=1) if machines else np.zeros((N_BUCKETS, 0))
    return Model(languages, families, pairs, weights, np.array([b for _, b in machines]))


def has_letter(block: Block) -> np.ndarray:
    """Whether each text has a letter (Unicode category L)."""
    lower = block.data | 0x20
    ascii_letters = np.concatenate([[0], np.cumsum((lower >= 0x61) & (lower <= 0x7A))])
    out = ascii_letters[block.offsets[1:]] > ascii_letters[block.offsets[:-1]]
    for i in np.flatnonzero(~out):
        text = block.data[block.offsets[i] : block.offsets[i + 1]].tobytes().decode("utf-8", "replace")
        out[i] = any(c.isalpha() for c in text)
    return out


def margins(block: Block, model: Model) -> np.ndarray:
    """One row per text, one column per machine: the mean weight of its runs, and the bias."""
    total, n = np.zeros((len(block), model.weights.shape[1])), np.zeros(len(block))
    parts = grams(block)
    for k in range(model.weights.shape[1]):
        column = np.ascontiguousarray(model.weights[:, k])
        for buckets, at in parts:
            running = np.concatenate([[0.0], np.cumsum(column[buckets])])
            total[:, k] += running[at[1:]] - running[at[:-1]]
    for _, at in parts:
        n += np.diff(at)
    return total / np.maximum(n, 1)[:, None] + model.bias


def predictor(spark: SparkSession, model: Model):
    """Column function: text to the language and its score."""
    shared = ship(spark).broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for texts in batches:
            chosen, scores = [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
            for block in blocks(texts):
                if model.languages:
                    at, score = model.decide(margins(block, model))
                    known = has_letter(block)
                else:
                    at, score, known = np.zeros(len(block), dtype=np.int64), np.zeros(len(block)), np.zeros(len(block), dtype=bool)
                chosen.append(np.where(known, at, len(model.languages)))
                scores.append(np.where(known, score, 0.0))
            lang = pa.array(names[np.concatenate(chosen)], pa.string())
            yield pa.StructArray.from_arrays([lang, pa.array(np.concatenate(scores))], names=["lang_pred", "score"])

    return predict


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    predict = predictor(spark, train(docs))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
