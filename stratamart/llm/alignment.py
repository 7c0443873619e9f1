"""Alignment of two tokenizers' tokens by their bytes, and how often each pair of ids meets in the corpus.

Both tokenizers encode the same bytes, a space and the text. Where a token of each ends at the same byte, a group ends;
every token of the one is linked to every token of the other in its group.

Texts are handled as Arrow arrays, block by block. Lists of ids are flattened, with the parent index of each id; token
sizes, looked up by id, add up to ends per text by a segmented cumulative sum; an Acero hash join on (text, end) finds
the shared ends, whose cumulative sum numbers the groups on both sides; a second one on the group links distinct ids,
with the product of their numbers. A task counts by ``Table.group_by`` in how many documents a pair is linked, and Spark
adds up the counts of all tasks. Each document's pairs then meet the corpus-wide counts: the ``HOT`` commonest pairs, a
table of fixed size, in the task that holds the document, all others in a join by pair.

* null and empty texts, and texts whose bytes a tokenizer does not give back (such as those with the piece model's own
  sign for a space, or broken UTF-8): no tokens, zeros, and '' for the digest.
* texts of any length are encoded whole; a large group is linked in parts of bounded size.
* repeated rows: each counts as a document. Null ids are kept. Empty table: an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.bpe import byte_symbols
from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, stored
from stratamart.llm.text import blocks

HOT = 1 << 16
LINKED = 1 << 20
HELD = 500_000


class Tokenizers:
    """A: byte-level BPE of a vocabulary file and its splitting pattern. B: a piece model. Built once per worker."""

    def __init__(self, file_text: str, pattern: str, model: bytes) -> None:
        self.file_text, self.pattern, self.model = file_text, pattern, model

    def __reduce__(self):
        return Tokenizers, (self.file_text, self.pattern, self.model)

    @cached_property
    def bytes_a(self) -> list[bytes]:
        back = {c: b for b, c in enumerate(byte_symbols())}
        model = json.loads(self.file_text)["model"]
        out = [b""] * len(model["vocab"])
        for entry, at in model["vocab"].items():
            if all(c in back for c in entry):  # else a special token, which is never made
                out[at] = bytes([back[c] for c in entry])
        merged = [model["vocab"]["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("merges of this vocabulary do not come in the order of their ids")
        return out

    @cached_property
    def a(self):
        from tiktoken import Encoding

        ranks = {entry: at for at, entry in enumerate(self.bytes_a) if entry}
        return Encoding("a", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def b(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def bytes_b(self) -> list[bytes]:
        b = self.b
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        return [bytes([int(x[3:5], 16)]) if b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]

    @cached_property
    def tables(self) -> tuple[tuple[pa.Array, pa.Array, pa.Array], ...]:
        """For A and B: by id, its bytes, their number, and the id in decimal."""
        return tuple(
            (pa.array(own, pa.large_binary()), pa.array([len(x) for x in own], pa.int64()), pa.array(map(str, range(len(own))), pa.large_string()))
            for own in (self.bytes_a, self.bytes_b)
        )

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [self.a.encode_to_numpy(" " + x, disallowed_special=()) for x in texts]
        return a, [np.array(x, dtype=np.int32) for x in self.b.encode(texts, num_threads=1)]


def tokenizers(path_a: str | None = None, path_b: str | None = None, pattern: str | None = None) -> Tokenizers:
    import public_tokenizers

    with open(path_a or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        text = file.read()
    with open(path_b or public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return Tokenizers(text, pattern or public_tokenizers.PATTERN, file.read())


def _lists(ids: list[np.ndarray]) -> pa.LargeListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *ids]).astype(np.int32)))


def _joined(lists: pa.LargeListArray, entries: pa.Array) -> list[bytes]:
    """The bytes of each list's tokens, joined."""
    flat = pc.take(entries, pc.list_flatten(lists))
    at = np.frombuffer(flat.buffers()[1], dtype=np.int64)[lists.offsets.to_numpy()]
    data = memoryview(flat.buffers()[2])
    return [bytes(data[i:j]) for i, j in zip(at[:-1], at[1:])]


def ended(lists: pa.LargeListArray, sizes: pa.Array, side: str) -> pa.Table:
    """One row per token: doc (its list), end (bytes of the list up to and with it), place, id."""
    ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    upto = pc.cumulative_sum(pc.take(sizes, ids))
    before = np.concatenate([[0], upto.to_numpy(zero_copy_only=False)])[lists.offsets.to_numpy()[:-1]]  # where each list starts
    end = pc.subtract(upto, pc.take(pa.array(before), doc))
    return pa.table({"doc": doc, "end": end, f"place_{side}": pa.array(np.arange(len(ids))), f"id_{side}": ids})


def _numbered(tokens: pa.Table, places: pa.ChunkedArray, side: str) -> pa.Table:
    """Adds group: the number of shared ends before the token. Shared ends are given by the places of their tokens."""
    ends = np.zeros(tokens.num_rows, dtype=np.int64)
    ends[places.to_numpy()] = 1
    return tokens.append_column("group", pa.array(np.cumsum(ends) - ends))


def linked(a: pa.Table, b: pa.Table, doc_of_group: pa.Array, most: int = LINKED) -> pa.Table:
    """doc, id_a, id_b, links: distinct pairs of ids of each document. No join inside makes more than ``most`` rows,
    besides those of a single id of A in one group."""
    a = a.group_by(["group", "id_a"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "id_a", "n_a"])
    b = b.group_by(["group", "id_b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "id_b", "n_b"])
    width = np.bincount(b.column("group").to_numpy(), minlength=len(doc_of_group))
    made = np.cumsum(width[a.column("group").to_numpy()])
    cuts = [0, *np.flatnonzero(np.diff(made // most)) + 1, a.num_rows] if len(made) else [0, 0]
    parts = []
    for i, j in zip(cuts[:-1], cuts[1:]):
        met = a.slice(i, j - i).join(b, "group", join_type="inner", use_threads=False)
        pairs = pa.table(
            {
                "doc": pc.take(doc_of_group, met.column("group")),
                "id_a": met.column("id_a"),
                "id_b": met.column("id_b"),
                "links": pc.multiply(met.column("n_a"), met.column("n_b")),
            }
        )
        parts.append(pairs.group_by(["doc", "id_a", "id_b"], use_threads=False).aggregate([("links", "sum")]))
    out = pa.concat_tables(parts)
    if len(parts) > 1:
        out = out.group_by(["doc", "id_a", "id_b"], use_threads=False).aggregate([("links_sum", "sum")])
    return out.rename_columns(["doc", "id_a", "id_b", "links"])


def _texts(tokens: pa.Table, names: pa.Array, side: str, n_groups: int) -> pa.Array:
    """The ids of each group in decimal, with commas."""
    offsets = np.searchsorted(tokens.column("group").to_numpy(), np.arange(n_groups + 1))
    ids = pc.take(names, tokens.column(f"id_{side}").combine_chunks())
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), ids), pa.scalar(",", pa.large_string()))


ALIGNED = "struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string, pairs: array<struct<a: int, b: int, links: bigint>>>"


def align(pair: Tokenizers, texts: list[bytes]) -> pa.StructArray:
    """The columns of ``ALIGNED`` for each text (empty for null)."""
    n = len(texts)
    coded = pair.encode([x.decode("utf-8", "replace") for x in texts])
    wanted = [b" " + x for x in texts]
    whole = [bool(x) for x in texts]
    for ids, (entries, _, _) in zip(coded, pair.tables):
        whole = [ok and own == x for ok, own, x in zip(whole, _joined(_lists(ids), entries), wanted)]
    lists = [_lists([x if ok else x[:0] for x, ok in zip(ids, whole)]) for ids in coded]
    a, b = (ended(own, tables[1], side) for own, tables, side in zip(lists, pair.tables, "ab"))
    shared = a.select(["doc", "end", "place_a"]).join(b.select(["doc", "end", "place_b"]), ["doc", "end"], join_type="inner", use_threads=False)
    a, b = _numbered(a, shared.column("place_a"), "a"), _numbered(b, shared.column("place_b"), "b")
    n_groups = np.bincount(shared.column("doc").to_numpy(), minlength=n)
    doc_of_group = pa.array(np.repeat(np.arange(n), n_groups))
    pairs = linked(a.select(["group", "id_a"]), b.select(["group", "id_b"]), doc_of_group)
    pairs = pairs.sort_by([("doc", "ascending"), ("id_a", "ascending"), ("id_b", "ascending")])
    docs, links = pairs.column("doc").to_numpy(), pairs.column("links").to_numpy()
    at = np.searchsorted(docs, np.arange(n + 1))
    n_links = np.diff(np.concatenate([[0], np.cumsum(links)])[at])
    groups = pc.binary_join_element_wise(*(_texts(own, tables[2], side, len(doc_of_group)) for own, tables, side in zip((a, b), pair.tables, "ab")), pa.scalar("|", pa.large_string()))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)])), groups), pa.scalar(";", pa.large_string()))
    digests = [sha256(memoryview(x.as_buffer())).hexdigest() if ok else "" for x, ok in zip(joined, whole)]
    struct = pa.StructArray.from_arrays([pairs.column(c).combine_chunks() for c in ("id_a", "id_b", "links")], names=["a", "b", "links"])
    sizes = [pa.array(np.diff(own.offsets.to_numpy())) for own in lists]
    return pa.StructArray.from_arrays(
        [*sizes, pa.array(n_groups), pa.array(n_links), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), struct)],
        names=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"],
    )


def aligner(spark: SparkSession, pair: Tokenizers):
    """Column function: text to ``ALIGNED``."""
    shared = ship(spark).broadcast(pair)

    @F.arrow_udf(ALIGNED)
    def aligned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for block in blocks(texts):  # handed over block by block: memory follows the block
                yield align(shared.value, [block.data[i:j].tobytes() for i, j in zip(block.offsets[:-1], block.offsets[1:])])

    return aligned


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, n: in how many of a task's documents a pair is linked."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])

    parts: list[pa.Table] = []
    held = 0
    for batch in batches:
        pairs = pc.list_flatten(batch.column("pairs"))
        a, b = pairs.field("a"), pairs.field("b")
        own = pa.table({"a": a, "b": b}).group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        parts.append(own.rename_columns(["a", "b", "n"]))
        held += own.num_rows
        if held > 2 * HELD:
            parts = [summed(parts)]
            held = parts[0].num_rows
            if held > HELD:  # more kinds than a worker should hold: Spark adds them up
                yield from parts[0].to_batches(max_chunksize=1 << 14)
                parts, held = [], 0
    if parts:
        yield from summed(parts).to_batches(max_chunksize=1 << 14)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n (documents that link them) and best (whether n is the highest of a)."""
    counts = aligned.select("pairs").mapInArrow(_partial, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    # an id of A meets at most all ids of B, whatever the size of the corpus
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def _met(spark: SparkSession, hot: pa.Table):
    """Column function: pairs to the sums over those in ``hot`` and the list of the others."""
    keys = hot.column("a").to_numpy().astype(np.int64) << 32 | hot.column("b").to_numpy()
    order = np.argsort(keys)
    shared = ship(spark).broadcast((keys[order], hot.column("n").to_numpy()[order], hot.column("best").to_numpy()[order].astype(np.int64)))

    @F.arrow_udf("struct<n_best: bigint, count_sum: bigint, rest: array<struct<a: int, b: int, links: bigint>>>")
    def met(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, counts, best = shared.value
        for lists in batches:
            flat, docs = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
            own = flat.field("a").to_numpy().astype(np.int64) << 32 | flat.field("b").to_numpy()
            links = flat.field("links").to_numpy()
            at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
            hit = known[at] == own if len(known) else np.zeros(len(own), dtype=bool)
            sums = []
            for values in (best, counts):
                upto = np.concatenate([[0], np.cumsum(np.where(hit, links * values[at] if len(known) else 0, 0))])
                edges = np.searchsorted(docs, np.arange(len(lists) + 1))
                sums.append(pa.array(np.diff(upto[edges])))
            rest = flat.filter(pa.array(~hit))
            offsets = np.searchsorted(docs[~hit], np.arange(len(lists) + 1))
            yield pa.StructArray.from_arrays([*sums, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest)], names=["n_best", "count_sum", "rest"])

    return met


def alignment(docs: DataFrame, pair: Tokenizers | None = None, hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    coded = docs.select("doc_id", F.monotonically_increasing_id().alias("_row"), aligner(spark, pair or tokenizers())("text").alias("c"))
    aligned = stored(coded.select("doc_id", "_row", "c.*"), "aligned")
    counts = stored(pair_counts(aligned), "pair-counts")
    common = counts.orderBy(F.desc("n"), "a", "b").limit(hot).toArrow()
    scored = stored(aligned.select("_row", _met(spark, common)("pairs").alias("m")).select("_row", "m.*"), "scored")
    rest = scored.select("_row", F.inline("rest")).join(counts, ["a", "b"])
    sums = {"n_best": F.col("links") * F.col("best").cast("long"), "count_sum": F.col("links") * F.col("n")}
    rest = rest.groupBy("_row").agg(*[F.sum(x).alias(f"rest_{name}") for name, x in sums.items()])
    out = aligned.drop("pairs").join(scored.drop("rest"), "_row").join(rest, "_row", "left")
    totals = [(F.col(name) + F.coalesce(f"rest_{name}", F.lit(0))).alias(name) for name in sums]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *totals, "groups_sha256")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir))
