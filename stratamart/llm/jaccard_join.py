"""Similarity join of documents on word n-grams: MinHash banding, then exact verification.

Documents with the same words in the same order are one text; a text is handled once, with its number of copies. A
text's set are its runs of five words (fewer words: one run of all). Bands and rows follow from the similarity and the
recall wanted: a pair at exactly the threshold shares a band with probability ``RECALL``. Texts meet where a band hash
is equal, in a shuffle on band hashes, and every pair that meets is verified on the full sets, in the first band that
both share. Sets travel only to the buckets where their text has a pair to verify.

A bucket of any size is cut into blocks of about ``BLOCK`` texts, and each pair of blocks is one unit of work for any
task; texts are compared inside it as arrays. What leaves a unit is, per text, the number of links found and one edge
to the smallest text it is connected with there: rows grow with a bucket's texts, not with its pairs, and no link is
lost. Classes are the connected components of the edges, contracted round by round in written tables. Where classes
alone are wanted (``one_per_class``), texts meet the smallest text of each bucket first, and after that only those in
different components: a group of near copies costs rows in proportion to its texts.

* null and empty texts, and texts without words: a class of their own, no links. Null ids: handled by their words;
  the class of such rows alone has a null class id.
* repeated rows and equal texts: links to one another (similarity 1), one class.
* ties: a class is named by its smallest document id. Empty table: an empty result.
* extra columns: ignored by ``classes``, carried along by ``one_per_class``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.ship import ship
from stratamart.llm.storage import documents, own_columns, small_side, stored
from stratamart.llm.text import Block, blocks, mix

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
MOST_HASHES = 100
BLOCK = 1000


def bands_and_rows(similarity: float = SIMILARITY, recall: float = RECALL, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows per band, hence the fewest false candidates, that reach the recall with so many hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - similarity)), 1)
    for rows in range(2, most_hashes):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def band_hashes(block: Block, bands: int, rows: int) -> np.ndarray:
    """One row per text, one 64-bit hash per band; rows of texts without words mean nothing."""
    grams, at = block.ngrams(WORDS, whole_if_short=True)
    held = np.flatnonzero(np.diff(at))
    out = np.zeros((len(block), bands), dtype=np.uint64)
    if len(held):
        factors = _multipliers(bands * rows)
        for band in range(bands):
            total = np.full(len(held), band + 1, dtype=np.uint64)
            for row in range(rows):
                least = np.minimum.reduceat(grams * factors[band * rows + row], at[held])
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + least)
            out[held, band] = total
    return out.view(np.int64)


def text_keys(block: Block) -> np.ndarray:
    """16 bytes per text that stand for its words in order; all zero for a text without words."""
    out = np.zeros((len(block), 2), dtype=">u8")
    held = np.flatnonzero(block.words_per_text)
    if len(held):
        words = block.word_hashes
        place = np.arange(len(words), dtype=np.uint64) - np.repeat(block.word_offsets[:-1], block.words_per_text).astype(np.uint64)
        for k in (0, 1):
            seasoned = mix(words * np.uint64(2 * k + 1) + mix(place + np.uint64(k << 40)))
            out[held, k] = mix(np.add.reduceat(seasoned, block.word_offsets[:-1][held]) + block.words_per_text[held].astype(np.uint64))
    return out


def _binary(keys: np.ndarray, missing: np.ndarray) -> pa.Array:
    fixed = pa.Array.from_buffers(pa.binary(16), len(keys), [None, pa.py_buffer(np.ascontiguousarray(keys).tobytes())])
    return pa.array([None if gone else key for key, gone in zip(fixed.to_pylist(), missing)], pa.binary())


def signatures(spark: SparkSession, bands: int, rows: int):
    """Column function: text to its key (null without words) and its band hashes."""
    ship(spark)

    @F.arrow_udf("struct<node: binary, bands: array<bigint>>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for block in blocks(texts):  # handed over block by block: memory follows the block
                nodes = _binary(text_keys(block), block.words_per_text == 0)
                hashes = band_hashes(block, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1) * bands, pa.int32()), pa.array(hashes.ravel()))
                yield pa.StructArray.from_arrays([nodes, lists], names=["node", "bands"])

    return sign


def text_sets(spark: SparkSession):
    """Column function: text to its key and its sorted set of n-gram hashes."""
    ship(spark)

    @F.arrow_udf("struct<node: binary, grams: array<bigint>>")
    def collect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for block in blocks(texts):
                nodes, lists = _binary(text_keys(block), block.words_per_text == 0), []
                grams, at = block.ngrams(WORDS, whole_if_short=True)
                for a, b in zip(at[:-1], at[1:]):
                    own = np.sort(grams[a:b].view(np.int64))
                    lists.append(own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own)
                sizes = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32())
                flat = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *lists]))
                yield pa.StructArray.from_arrays([nodes, pa.ListArray.from_arrays(sizes, flat)], names=["node", "grams"])

    return collect


def _common(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets named by ``rows`` with those named by ``columns``."""
    index = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    grams, place = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(place, minlength=len(grams)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    index, place = index[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    index, place = index[order], place[order]
    out = np.zeros((len(rows), len(columns)), dtype=np.float32)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(place, [start, start + width])
        held = np.zeros((len(sets), min(width, int(shared.sum()) - start)), dtype=np.float32)
        held[index[a:b], place[a:b] - start] = 1
        out += held[rows] @ held[columns].T
    return out


def _fresh(sides: np.ndarray | None, band: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and, for each pair of them, whether it meets in this band first.

    ``sides``: whether a text is of the unit's first block; None for a unit of one block.
    """
    if sides is None:
        rows = columns = np.arange(len(hashes))
    else:
        rows, columns = np.flatnonzero(sides), np.flatnonzero(~sides)
    fresh = np.ones((len(rows), len(columns)), dtype=bool)
    for k in range(band):
        fresh &= hashes[rows, k][:, None] != hashes[columns, k][None, :]
    if sides is None:
        np.fill_diagonal(fresh, False)
    return rows, columns, fresh


def _links(sides: np.ndarray | None, band: int, hashes: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, similarity: float):
    """Number of linked documents of each text of a unit, by pairs that meet first in this band, and the smallest text
    connected with it."""
    n = len(sets)
    rows, columns, fresh = _fresh(sides, band, hashes)
    counts, least = np.zeros(n, dtype=np.int64), np.arange(n)
    sizes = np.array([len(x) for x in sets], dtype=np.float64)
    common = _common(sets, rows, columns).astype(np.float64)
    linked = fresh & (common * (1 + similarity) >= similarity * (sizes[rows][:, None] + sizes[columns][None, :]) - 1e-9)
    counts[rows] += linked @ copies[columns]
    if sides is not None:
        counts[columns] += linked.T @ copies[rows]
    while True:
        before = least.copy()
        np.minimum.at(least, rows, np.where(linked, least[columns][None, :], n).min(axis=1, initial=n))
        if sides is not None:
            np.minimum.at(least, columns, np.where(linked, least[rows][:, None], n).min(axis=0, initial=n))
        if (least == before).all():
            return counts, least


UNIT = ["band", "key", "first", "second"]


def _unit(table: pa.Table) -> tuple[np.ndarray | None, int, np.ndarray]:
    """sides, band and band hashes of the rows of one unit."""
    band, _, first, second = (table.column(c)[0].as_py() for c in UNIT)
    sides = None if first == second else table.column("block").to_numpy() == first
    return sides, band, np.stack([x.values.to_numpy() for x in table.column("bands")])


def _with_fresh_pairs(table: pa.Table) -> list[pa.RecordBatch]:
    """The rows of a unit that have a pair to verify there."""
    rows, columns, fresh = _fresh(*_unit(table))
    use = np.unique(np.concatenate([rows[fresh.any(axis=1)], columns[fresh.any(axis=0)]]))
    return table.select([*UNIT, "block", "node"]).take(use).combine_chunks().to_batches()


def _verified(similarity: float):
    def run(table: pa.Table) -> list[pa.RecordBatch]:
        table = table.sort_by("node")
        sets, copies = [x.values.to_numpy() for x in table.column("grams")], table.column("copies").to_numpy()
        counts, least = _links(*_unit(table), sets, copies, similarity)
        held = np.flatnonzero(counts)
        nodes = table.column("node").combine_chunks()
        return [pa.RecordBatch.from_arrays([nodes.take(held), nodes.take(least[held]), pa.array(counts[held])], names=["node", "least", "links"])]

    return run


def _by_unit(handle):
    """Streams rows sorted by unit, whose rows follow each other, and hands each unit over whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []  # the rows so far of the last unit
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([table.column(c).to_numpy() for c in UNIT])
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), table.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                part = table.slice(a, b - a)
                if waiting and any(part.column(c)[0] != waiting[0].column(c)[0] for c in UNIT):
                    yield from handle(pa.concat_tables(waiting).combine_chunks())
                    waiting = []
                waiting.append(part)
        if waiting:
            yield from handle(pa.concat_tables(waiting).combine_chunks())

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each node's component, for edges (node, least).

    Each round joins every node to its smallest neighbour and contracts; as nodes are hashes, rounds grow with the
    logarithm of the longest path. Each round is a written table.
    """
    edges = stored(edges.select("node", "least").where("node != least").distinct(), "edges")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("least").alias("node"), F.col("node").alias("least")))
        hooked = both.groupBy("node").agg(F.least(F.col("node"), F.min("least")).alias("to"))
        steps.append(stored(hooked, "hooks"))
        renamed = edges
        for end in ("node", "least"):
            hook = steps[-1].select(F.col("node").alias(end), F.col("to").alias(f"new_{end}"))
            renamed = renamed.join(hook, end)
        renamed = renamed.select(F.col("new_node").alias("node"), F.col("new_least").alias("least"))
        edges = stored(renamed.where("node != least").distinct(), "edges")
    if not steps:
        return edges.select("node", F.col("least").alias("root"))
    found = steps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(steps[:-1]):
        above = found.select(F.col("node").alias("to"), "root")
        found = step.join(above, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return found


def _texts(docs: DataFrame, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Two tables. Per document: doc_id, node, bands. Per text: node, copies, first_id, first_rows, bands."""
    sign = signatures(docs.sparkSession, bands, rows)
    signed = stored(docs.select("doc_id", sign("text").alias("s")).select("doc_id", "s.*"), "signatures")
    per_id = signed.where("node IS NOT NULL").groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands"))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "n"))
    nodes = per_id.groupBy("node").agg(F.sum("n").alias("copies"), smallest.alias("f"), F.first("bands").alias("bands"))
    return signed, stored(nodes.select("node", "copies", F.col("f.doc_id").alias("first_id"), F.col("f.n").alias("first_rows"), "bands"), "texts")


def _met(nodes: DataFrame) -> DataFrame:
    """Texts in buckets of two or more: node, band, key, the bucket's blocks and its smallest text, the hub."""
    spread = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    crowded = spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
    crowded = crowded.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    joined = spread.join(small_side(stored(crowded, "buckets")), ["band", "key"])
    return stored(joined.select("node", "band", "key", "blocks", "hub"), "met")


def _open_units(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of the units (UNIT, block, node) that have a pair to verify there."""
    units = units.select("node", "band", "key", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    sorted_units = units.join(nodes.select("node", "bands"), "node").repartition(*UNIT).sortWithinPartitions(*UNIT)
    kept = "band int, key long, first int, second int, block int, node binary"
    return stored(sorted_units.mapInArrow(_by_unit(_with_fresh_pairs), kept), "units")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, grams of the texts named by ``wanted``; each text is read at the smallest of its ids."""
    wanted = stored(wanted.select("node").distinct().join(nodes.select("node", "first_id"), "node"), "wanted")
    by_id = wanted.select(F.col("first_id").alias("_id")).distinct()
    sets = docs.select("doc_id", "text").join(small_side(by_id), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = sets.select(text_sets(docs.sparkSession)("text").alias("s")).select("s.*")
    sets = sets.join(small_side(wanted.select("node")), "node", "left_semi")
    return stored(sets.groupBy("node").agg(F.first("grams").alias("grams")), "sets")


def _verified_units(units: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """node, least, links: for each text of a unit that has links there, one edge and their number."""
    full = units.join(sets.join(nodes.select("node", "copies", "bands"), "node"), "node")
    sorted_units = full.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return stored(sorted_units.mapInArrow(_by_unit(_verified(similarity)), "node binary, least binary, links long"), "links")


def linked_texts(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Two tables. Per document: doc_id, node. Per text: node, class_id, n_links."""
    signed, nodes = _texts(docs, *bands_and_rows(similarity, recall))
    block = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    units = _met(nodes).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_units = _open_units(units, nodes)
    verified = _verified_units(open_units, nodes, _sets(docs, nodes, open_units), similarity)

    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(verified)
    found = nodes.select("node", "copies", "first_id").join(links, "node", "left").join(roots, "node", "left")
    found = stored(found.withColumn("root", F.coalesce("root", "node")), "found")
    speaker = F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id"))
    names = found.groupBy("root").agg(speaker.alias("s")).select("root", F.col("s.first_id").alias("class_id"))
    n_links = F.coalesce(F.col("links"), F.lit(0)) + F.col("copies") - 1
    per_text = found.join(names, "root").select("node", "class_id", n_links.alias("n_links"))
    return signed.select("doc_id", "node"), stored(per_text, "classes")


def _star_units(met: DataFrame) -> DataFrame:
    """Units in which each text meets the hubs of its buckets: rows grow with the texts, whatever the size of a bucket.

    A hub's texts are cut into blocks, and the hub goes to each of them.
    """
    pairs = stored(met.where("node != hub").select("node", "hub").distinct(), "pairs")
    sized = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sized = stored(sized, "hubs")
    key, zero = F.xxhash64("hub").alias("key"), F.lit(0)
    part = (F.pmod(F.xxhash64("node"), F.col("blocks")) + 1).cast("int")
    leaves = pairs.join(small_side(sized), "hub").select("node", key, part.alias("second"), part.alias("block"))
    centres = sized.select(
        F.col("hub").alias("node"), key, F.explode(F.sequence(F.lit(1), F.col("blocks"))).alias("second"), zero.alias("block")
    )
    both = leaves.unionByName(centres)
    return both.select(zero.alias("band"), "key", zero.alias("first"), "second", "block", "node")


def _rest_units(met: DataFrame, roots: DataFrame) -> DataFrame:
    """What the hubs have left open: of each bucket without its hub, the pairs of texts that no component joins.

    The texts of a bucket's largest component meet the others only, never one another.
    """
    member = met.where("node != hub").select("node", "band", "key").join(roots, "node", "left")
    member = stored(member.withColumn("root", F.coalesce("root", "node")), "members")
    per_root = member.groupBy("band", "key", "root").agg(F.count(F.lit(1)).alias("n"))
    buckets = per_root.groupBy("band", "key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    buckets = buckets.where("main.n < n").select(
        "band",
        "key",
        F.col("main.root").alias("main"),
        F.ceil(F.col("main.n") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("odd_blocks"),
    )
    met_again = member.join(small_side(stored(buckets, "open-buckets")), ["band", "key"])
    odd, salt = F.col("root") != F.col("main"), F.xxhash64("node", "key")
    block = F.when(odd, F.pmod(salt, "odd_blocks")).otherwise(F.col("odd_blocks") + F.pmod(salt, "main_blocks")).cast("int")
    last = F.col("odd_blocks") - 1 + F.when(odd, F.col("main_blocks")).otherwise(0)
    return met_again.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))


def speakers(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """node, first_id, first_rows of the one text that stands for its class: the classes of ``linked_texts``, without counts.

    Links are not counted, so a pair that other links join already need not be verified: every text meets the hub of
    each of its buckets first, and only pairs still in different components meet after that.
    """
    _, nodes = _texts(docs, *bands_and_rows(similarity, recall))
    met = _met(nodes)
    sets = _sets(docs, nodes, met)
    roots = stored(components(_verified_units(_star_units(met), nodes, sets, similarity)), "roots")
    rest = _verified_units(_open_units(_rest_units(met, roots), nodes), nodes, sets, similarity)
    for end in ("node", "least"):
        above = roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        rest = rest.join(above, end, "left").withColumn(end, F.coalesce(f"_{end}", end))
    tops = components(rest).select(F.col("node").alias("root"), F.col("root").alias("top"))
    found = nodes.select("node", "first_id", "first_rows").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = found.join(tops, "root", "left").withColumn("root", F.coalesce("top", "root"))
    speaker = F.min(F.struct(F.col("first_id").isNull().alias("last"), "first_id", "node", "first_rows"))
    return stored(found.groupBy("root").agg(speaker.alias("s")).select("s.node", "s.first_id", "s.first_rows"), "speakers")


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (other documents at least so similar)."""
    per_document, per_text = linked_texts(docs, similarity, recall)
    joined = per_document.join(small_side(per_text), "node", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The row with the smallest id of each class, and all rows without words; columns as they came."""
    spark = docs.sparkSession
    own = speakers(docs, similarity, recall).withColumnRenamed("node", "_node")
    packed = docs.select(F.struct(*own_columns(docs)).alias("_row"), signatures(spark, 1, 1)("text").alias("_s"))
    named = packed.select("_row", F.col("_s.node").alias("node"), F.col("_row.doc_id").alias("_id"))
    kept = named.join(small_side(own), (F.col("node") == F.col("_node")) & F.col("_id").eqNullSafe(F.col("first_id")))
    single = kept.where("first_rows = 1").select("_row")
    repeated = kept.where("first_rows > 1").dropDuplicates(["node"]).select("_row")
    return named.where("node IS NULL").select("_row").unionAll(single).unionAll(repeated).select("_row.*")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))
