"""Merkle manifest of a dataset: a digest per row, a root per source, a root of all, and proofs that lead up to it.

A row's leaf is the digest of its fields. The leaves of a source, in the order of their ids, form a tree in which every
``FANOUT`` consecutive nodes (fewer at the end) are digested into one until one is left; the sources' roots form the
tree above in the same way. A proof holds, level by level, what stands before and after the own node in its run.

The rows of a source are numbered over ranges of the order, so that no task sorts a source, and dealt into aligned
blocks of ``FANOUT ** LEVELS`` leaves. A block builds its own subtree. From there on blocks meet in a butterfly
exchange: in each round, those that agree in all digits of their number but one (base ``FANOUT``) swap the roots they
have reached, and each digests the same ancestor for itself. So every block gains one level of its proof a round, and
none waits for proofs from above. Where the last run is incomplete, the blocks that are there stand in for the missing
ones by turns. The sources' roots are exchanged in the same way; then each row's proof is the block's own levels, those
of the rounds, and those of the source.

* a null field is written as "-"; an empty text as "0:". Null source: a source of its own, the first. Null ids come
  first in their source; such a row is never tampered with.
* rows of the same id: ordered by leaf. Repeated rows: each has a place of its own, and which takes which is arbitrary
  but without effect on roots. A source that holds a single row: its leaf is its subroot.
* texts of any length are digested whole. Empty table: an empty result. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.storage import documents, small_side, stored
from stratamart.operators.ordering import numbered

FANOUT = 3
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: How many blocks the one that stands in for missing partners serves as one row of the exchange.
SERVED = 1000
_STEPS = "array<struct<before: string, after: string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A field's part of a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, text: str = "text") -> DataFrame:
    """doc_id, source, leaf, and changed: the leaf of the tampered row, null for a row that is left alone or stays as it is."""
    parts = {name: field(F.col(name)) for name in fields}
    cut = F.replace(F.col(text), F.lit("\n"), F.lit(""))
    tampered = (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0) & F.contains(F.col(text), F.lit("\n"))
    return docs.select(
        "doc_id",
        "source",
        digest(F.concat(*parts.values())).alias("leaf"),
        F.when(tampered, digest(F.concat(*(parts | {text: field(cut)}).values()))).alias("changed"),
        F.monotonically_increasing_id().alias("nth"),
    )


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with tree (their source's number, from 0) and at (their place in it); per tree: tree, source, n."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("nth")]
    rows = stored(numbered(rows, *order), "placed")
    first = rows.groupBy("source").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    trees = stored(numbered(first, F.col("source").asc_nulls_first(), name="tree"), "trees")
    own = trees.select(F.col("source").alias("_source"), "first", "tree")
    rows = rows.join(small_side(own), F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.select("tree", (F.col("position") - F.col("first")).alias("at"), "doc_id", "leaf", "changed")
    return rows, trees.select("tree", "source", "n")


def _runs(level: Column, fanout: int) -> Column:
    """The digests of the level above."""
    above = F.sequence(F.lit(0), F.ceil(F.size(level) / fanout).cast("int") - 1)
    return F.transform(above, lambda i: digest(F.array_join(F.slice(level, i * fanout + 1, F.lit(fanout)), "")))


def depth(n: Column, fanout: int, most: int) -> Column:
    """Levels above ``n`` leaves until one node is left, at most ``most``."""
    return sum((F.when(n > fanout**k, 1).otherwise(0) for k in range(most)), F.lit(0))


def blocks_of(rows: DataFrame, trees: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per block: tree, block, blocks (of the tree), leaves (at, doc_id, leaf, changed), levels (digests), root."""
    size = fanout**levels
    block = F.floor(F.col("at") / size).cast("long")
    packed = rows.groupBy("tree", block.alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "doc_id", "leaf", "changed"))).alias("leaves")
    )  # at most ``size`` leaves, however large the source
    sizes = trees.select("tree", "n", F.ceil(F.col("n") / size).cast("long").alias("blocks"))
    packed = packed.join(small_side(sizes), "tree")
    ground = F.array(F.transform("leaves", lambda x: x["leaf"]))
    up = F.aggregate(
        F.array_repeat(F.lit(0), depth(F.col("n"), fanout, levels)),
        ground,
        lambda acc, _: F.concat(acc, F.array(_runs(F.element_at(acc, -1), fanout))),
    )
    built = stored(packed.select("tree", "block", "blocks", "leaves", up.alias("levels")), "blocks")
    return built.withColumn("root", F.element_at(F.element_at("levels", -1), 1))


def exchange(nodes: DataFrame, fanout: int = FANOUT, served: int = SERVED) -> DataFrame:
    """Swap roots round by round: ``nodes`` are tree, at (0 to n - 1), n and root, in any number of trees.

    Returns tree, at, root (of the whole tree) and steps: for each round what stands before and after the own node.
    """
    state = stored(nodes.select("tree", "at", "n", "root", F.array().cast(_STEPS).alias("steps")), "exchange")
    span, most = 1, state.agg(F.max("n")).first()[0] or 0
    while span < most:  # after a round each node has the root of span consecutive ones, its own among them
        active = state.where(F.col("n") > span)
        # partners: same place in each group of span nodes under the same ancestor; in a shorter group, by turns
        inner, run = F.pmod("at", F.lit(span)), F.floor(F.col("at") / (span * fanout)).cast("long")
        digit = F.explode(F.sequence(F.lit(0), F.lit(fanout - 1)))
        asks = active.select("tree", "at", "n", inner.alias("inner"), run.alias("run"), digit.alias("digit"))
        asks = asks.withColumn("base", F.col("run") * (span * fanout) + F.col("digit") * span).where("base < n")
        there = F.least(F.lit(span).cast("long"), F.col("n") - F.col("base"))
        asks = asks.select(
            "tree", "at", "digit",
            (F.col("base") + F.pmod("inner", there)).alias("partner"),
            F.floor(F.floor(F.col("inner") / there) / served).cast("long").alias("copy"),
        )
        group = F.least(F.lit(span).cast("long"), F.col("n") - F.floor(F.col("at") / span) * span)
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.lit(span) / group / served).cast("long")))
        offers = active.select("tree", F.col("at").alias("partner"), "root", copies.alias("copy"))
        met = asks.join(offers, ["tree", "partner", "copy"]).groupBy("tree", "at").agg(F.array_sort(F.collect_list(F.struct("digit", "root"))).alias("run"))
        own = F.pmod(F.floor(F.col("at") / span), F.lit(fanout)).cast("int")
        text = lambda array: F.array_join(F.transform(array, lambda x: x["root"]), "")
        step = F.struct(text(F.slice("run", F.lit(1), own)).alias("before"), text(F.slice("run", own + 2, F.lit(fanout))).alias("after"))
        met = met.select("tree", "at", digest(text(F.col("run"))).alias("above"), F.array(step).alias("step"))
        joined = active.join(met, ["tree", "at"]).select("tree", "at", "n", F.col("above").alias("root"), F.concat("steps", "step").alias("steps"))
        state = stored(joined.unionByName(state.where(F.col("n") <= span)), "exchange")
        span *= fanout
    return state.select("tree", "at", "root", "steps")


def folded(start: Column, steps: Column) -> Column:
    """The digest that a proof's steps lead to from ``start``."""
    return F.aggregate(steps, start, lambda acc, s: digest(F.concat(s["before"], acc, s["after"])))


def joined_steps(steps: Column) -> Column:
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def _local_steps(levels: Column, at: Column, fanout: int) -> Column:
    """The steps inside a block, for its leaf number ``at``."""

    def step(level: Column, k: Column) -> Column:
        width = F.pow(F.lit(fanout), k)
        place = F.floor(at / width).cast("int")
        own = F.pmod(place, F.lit(fanout))
        first = place - own + 1
        return F.struct(
            F.array_join(F.slice(level, first, own), "").alias("before"),
            F.array_join(F.slice(level, first + own + 1, fanout - 1 - own), "").alias("after"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows, trees = placed(stored(leaves(docs), "leaves"))
    blocks = blocks_of(rows, trees, fanout, levels)
    upper = exchange(blocks.select("tree", F.col("block").alias("at"), F.col("blocks").alias("n"), "root"), fanout)
    subroots = upper.where("at = 0").select("tree", F.col("root").alias("subroot"))
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(trees.count()).cast("long").alias("n"), F.col("subroot").alias("root"))
    tops = exchange(tops, fanout).select(F.col("at").alias("tree"), F.col("root").alias("top"), F.col("steps").alias("top_steps"))
    # one row per source, the blocks of a large one meet copies of it
    sources = trees.join(subroots, "tree").join(tops, "tree")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / (fanout**levels * SERVED)).cast("long")))
    sources = sources.withColumn("copy", copies).drop("n")
    proofs = upper.select("tree", F.col("at").alias("block"), "steps", F.floor(F.col("at") / SERVED).cast("long").alias("copy"))
    proofs = proofs.join(small_side(sources), ["tree", "copy"])
    above = F.concat("steps", "top_steps")
    proofs = stored(proofs.select("tree", "block", "source", "subroot", "top", above.alias("above"), joined_steps(above).alias("above_text")), "proofs")
    whole = blocks.join(small_side(proofs), ["tree", "block"])

    def proved(x: Column) -> Column:
        own = _local_steps(F.col("levels"), F.pmod(x["at"], F.lit(fanout**levels)), fanout)
        return F.struct(x["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"), F.coalesce(x["changed"], x["leaf"]).alias("start"), own.alias("own"))

    def checked(x: Column) -> Column:
        return F.struct(
            x["doc_id"].alias("doc_id"),
            x["leaf"].alias("leaf"),
            digest(F.concat(joined_steps(x["own"]), F.col("above_text"))).alias("proof_sha256"),
            folded(folded(x["start"], x["own"]), F.col("above")).alias("folded_root"),
        )

    each = F.transform(F.transform("leaves", proved), checked)
    out = whole.select("source", "subroot", F.col("top").alias("root"), F.inline(each))
    return out.select("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(documents(spark, sf_dir)).drop("source")


#: The same manifest level by level over whole sources.
OP12_SQL = r"""
WITH RECURSIVE
f AS (SELECT doc_id, source,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
    text, replace(text, chr(10), '') AS cut_text,
    -- CRC-32 of the decimal id, bit by bit; its last bit tells whether 2 divides it
    xor(list_reduce(flatten([[(ascii(substr(doc_id::VARCHAR, i, 1)) >> k) & 1 for k in range(8)] for i in range(1, len(doc_id::VARCHAR) + 1)]),
      lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT), 4294967295) AS crc
  FROM documents),
l AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 2 = 0 THEN sha256(head || coalesce(strlen(cut_text) || ':' || cut_text, '-'))
         ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS start FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM l),
low AS (SELECT tree, 0 AS level, pos, leaf AS h, n FROM r
  UNION ALL SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY tree, level, pos // 3),
subroots AS (SELECT tree, h AS subroot FROM low WHERE n = 1),
high AS (SELECT 0 AS level, tree AS pos, subroot AS h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY level, pos // 3),
depths AS (SELECT tree, max(level) AS depth FROM low GROUP BY tree),
-- where each row stands at each level of its source and above
path AS (SELECT r.tree, r.pos AS leaf_pos, low.level, r.pos // (3 ** low.level)::BIGINT AS pos, low.n AS n
    FROM r JOIN (SELECT tree, level, any_value(n) AS n FROM low GROUP BY tree, level) low ON r.tree = low.tree WHERE low.n > 1
  UNION ALL SELECT r.tree, r.pos, d.depth + h.level, r.tree // (3 ** h.level)::BIGINT, h.n
    FROM r JOIN depths d ON r.tree = d.tree JOIN (SELECT level, any_value(n) AS n FROM high GROUP BY level) h ON h.n > 1),
nodes AS (SELECT tree, level, pos, h FROM low WHERE n > 1
  UNION ALL SELECT d.tree, d.depth + high.level, high.pos, high.h FROM high, depths d WHERE high.n > 1),
step AS (SELECT p.tree, p.leaf_pos, p.level, coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos < p.pos), '') AS before,
    coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos > p.pos), '') AS after
  FROM path p JOIN nodes x ON p.tree = x.tree AND p.level = x.level AND x.pos // 3 = p.pos // 3 GROUP BY p.tree, p.leaf_pos, p.level, p.pos),
proof AS (SELECT tree, leaf_pos, string_agg(before || after, '' ORDER BY level) AS whole, max(level) AS top FROM step GROUP BY tree, leaf_pos),
fold AS (SELECT tree, pos AS leaf_pos, 0 AS level, start AS h FROM r
  UNION ALL SELECT f.tree, f.leaf_pos, f.level + 1, sha256(s.before || f.h || s.after)
    FROM fold f JOIN step s ON f.tree = s.tree AND f.leaf_pos = s.leaf_pos AND f.level = s.level),
ends AS (SELECT tree, leaf_pos, arg_max(h, level) AS h FROM fold GROUP BY tree, leaf_pos),
root AS (SELECT h FROM high WHERE n = 1)
SELECT r.doc_id, r.leaf, s.subroot, root.h AS root, sha256(coalesce(p.whole, '')) AS proof_sha256, e.h AS folded_root, e.h = root.h AS verified
FROM r JOIN subroots s ON r.tree = s.tree CROSS JOIN root JOIN ends e ON r.tree = e.tree AND r.pos = e.leaf_pos
LEFT JOIN proof p ON r.tree = p.tree AND r.pos = p.leaf_pos"""
