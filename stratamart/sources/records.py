"""Records of large CSV files, read in splits although cells may hold line breaks.

Whether a line begins a record depends on whether a quoted cell is open there, and so on everything before it in
its file. Each line has a transition: the state after it, for either state before it. Transitions of the lines of a
chunk (some ten thousand lines of a file block) compose to that of the chunk; a scan over the chunks in file order gives
the state each starts in, and from there the state before each of its lines. The first step moves counts only; chunks in
which no cell stays open hold one record a line and are not shuffled, the lines of others are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.operators.storage import bounded_broadcast, written_once
from stratamart.sources.delimited import CELL, checked_rows, row_schema

#: Longest record, in lines: a cell left open by mistake must not gather the rest of a file in one row.
MOST_LINES = 100_000
_SPLIT = "spark.sql.files.maxPartitionBytes"
_CHUNK = ["file", "block", "chunk"]
#: A chunk is what a block holds of 2^15 consecutive lines: lines are ordered inside chunks only, whatever a block's size.
_CHUNK_BITS = 15
_CHUNKS_A_TASK, _MOST_TASKS = 8, 10_000


@contextmanager
def _split_size(spark: SparkSession, size: int | None) -> Iterator[None]:
    before = spark.conf.get(_SPLIT)
    if size is not None:
        spark.conf.set(_SPLIT, str(size))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def _fixes() -> Column:
    """Whether a line leaves the same state behind whatever that before it."""
    return F.col("from_closed") == F.col("from_open")


def _swaps() -> Column:
    return F.col("from_closed") & ~F.col("from_open")


def _after_closed(line: Column) -> Column:
    """Whether a cell is open after a line that begins outside of any."""
    return ~line.rlike(rf"^(?:{CELL},)*+{CELL}$")


def _after_open(line: Column) -> Column:
    """Whether a cell is open after a line that begins inside one."""
    return ~line.rlike(rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{CELL})*+$')


def staged_lines(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """file, block, chunk, nth (order inside the block), line, from_closed, from_open (state after it), stored.

    Stored, because later steps have to meet the same blocks, whatever the number of executors is then.
    """
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value").alias("line"),
    )
    quoted = F.contains("line", F.lit('"'))
    bare = F.when(F.col("block") == 0, F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line"))  # byte-order mark
    lines = text.withColumns(
        {
            "chunk": F.shiftright("nth", _CHUNK_BITS),
            "from_closed": F.when(quoted, _after_closed(bare)).otherwise(False),
            "from_open": F.when(quoted, _after_open(F.col("line"))).otherwise(True),
        }
    )
    with _split_size(spark, split_bytes):
        return written_once(lines, "lines", "zstd")


def _composed(order: Sequence[str], partition: Sequence[str], upto: int) -> dict[str, Column]:
    """State after all rows up to ``upto`` (0: the own one) for either state at the start.

    A row either fixes the state, whatever it was, or keeps or swaps it: the state is that fixed last, or that
    of the start, swapped as often as rows have done so since.
    """
    window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    swaps = F.coalesce(F.sum(F.when(_swaps(), 1).otherwise(0)).over(window), F.lit(0))
    return {"swaps": swaps}


def block_states(lines: DataFrame) -> DataFrame:
    """file, block, chunk, least (its first line), opens (whether a cell is open at its start), plain (whether none is
    open before or after any line), first (of its file).

    Only counts leave the map tasks: first the last line of each chunk that fixes the state, then the swaps after it.
    """
    last = F.max(F.when(_fixes(), F.col("nth") * 2 + F.col("from_closed").cast("int")))
    found = written_once(lines.groupBy(*_CHUNK).agg(last.alias("last"), F.min("nth").alias("least")), "fixed")
    since = F.col("last").isNull() | (F.col("nth") > F.shiftright("last", 1))
    chunks = lines.drop("line").join(bounded_broadcast(found), _CHUNK).groupBy(*_CHUNK).agg(
        F.max("last").alias("last"),
        F.max("least").alias("least"),
        (F.count_if(_swaps() & since) % 2 == 1).alias("swapped"),
        F.bool_or("from_closed").alias("opens_inside"),
    )
    fixed = F.col("last") % 2 == 1
    ends = {
        "from_closed": F.when(fixed.isNotNull(), fixed != F.col("swapped")).otherwise(F.col("swapped")),
        "from_open": F.when(fixed.isNotNull(), fixed != F.col("swapped")).otherwise(~F.col("swapped")),
    }
    chunks = chunks.select(*_CHUNK, "least", "opens_inside", *[c.alias(n) for n, c in ends.items()])
    # one row per chunk from here on
    in_file = Window.partitionBy("file").orderBy("block", "chunk")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumns(_composed(["block", "chunk"], ["file"], 0))
    known = F.last(F.when(_fixes(), F.struct("from_closed", "swaps")), ignorenulls=True).over(before)
    swaps = F.coalesce(F.last("swaps").over(before), F.lit(0))
    start = F.coalesce(known["from_closed"] != ((swaps - known["swaps"]) % 2 == 1), swaps % 2 == 1)
    chunks = chunks.withColumns({"opens": start, "first": F.row_number().over(in_file) == 1})
    return chunks.select(*_CHUNK, "least", "opens", (~F.col("opens") & ~F.col("opens_inside")).alias("plain"), "first")


def _only(df: DataFrame, condition: Column, record: Column) -> DataFrame:
    """Records where ``condition`` holds. Null elsewhere, so that a later check that is moved before this filter does
    not judge lines that are no records."""
    return df.select(F.when(condition, record).alias("record")).where("record IS NOT NULL")


def _gathered(rest: DataFrame, tasks: int) -> DataFrame:
    """least, begun (the line a record begins with, -1: in an earlier chunk), text, n, header, open (goes on behind its
    chunk), stored: what the lines of a chunk hold of each record. A chunk's lines are dealt out once."""
    rest = rest.repartition(tasks, "least").withColumns(_composed(["nth"], ["least"], 0))
    order = Window.partitionBy("least").orderBy("nth")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.last(F.when(_fixes(), F.struct("from_closed", "swaps")), ignorenulls=True).over(upto)
    swaps = F.coalesce(F.last("swaps").over(upto), F.lit(0))
    before = F.coalesce(fixed["from_closed"] != ((swaps - fixed["swaps"]) % 2 == 1), F.col("opens") != (swaps % 2 == 1))
    rest = rest.withColumn("inside", before)
    begun = F.last(F.when(~F.col("inside"), F.col("nth")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    stays = F.when(F.col("inside"), F.col("from_open")).otherwise(F.col("from_closed"))
    rest = rest.select("least", F.coalesce(begun, F.lit(-1)).alias("begun"), "nth", "line", "first", stays.alias("stays"))
    held = F.array_sort(F.collect_list(F.struct("nth", "line", "stays")))
    records = rest.groupBy("least", "begun").agg(held.alias("held"), F.bool_or("first").alias("first"))
    return written_once(
        records.select(
            "least",
            "begun",
            F.array_join(F.transform("held", lambda x: x["line"]), "\n").alias("text"),
            F.size("held").alias("n"),
            (F.col("first") & (F.col("begun") == F.col("least"))).alias("header"),
            F.element_at("held", -1)["stays"].alias("open"),
        ),
        "gathered",
        "zstd",
    )


def csv_records(spark: SparkSession, path: str, split_bytes: int | None = None, most_lines: int = MOST_LINES) -> DataFrame:
    """record: each record of the files at ``path`` but their headers, line breaks in cells as single newlines.

    Files are read in splits of ``split_bytes`` (the session's, if not given). A record of more than ``most_lines``
    lines is an error.
    """
    lines = staged_lines(spark, path, split_bytes)
    chunks = written_once(block_states(lines), "chunks")
    marked = lines.join(bounded_broadcast(chunks), _CHUNK)
    # the first record of a file is its header
    plain = _only(marked, F.col("plain") & ~(F.col("first") & (F.col("nth") == F.col("least"))), F.col("line"))

    tasks = min(max(1, chunks.where("NOT plain").count() // _CHUNKS_A_TASK), _MOST_TASKS)
    rest = marked.where(~F.col("plain")).select("least", "nth", "line", "from_closed", "from_open", "opens", "first")
    gathered = _gathered(rest, tasks)
    cut = (F.col("begun") == -1) | F.col("open")
    whole = _only(gathered, ~cut & ~F.col("header"), F.col("text"))
    # lines that go on with a record of an earlier chunk belong to the last one begun before theirs; at most two parts a chunk
    order = Window.partitionBy("file").orderBy("block", "chunk", "begun").rowsBetween(Window.unboundedPreceding, 0)
    parts = gathered.where(cut).drop("text").join(bounded_broadcast(chunks.select("least", *_CHUNK)), "least")
    owner = F.last(F.when(F.col("begun") != -1, F.col("begun")), ignorenulls=True).over(order)
    parts = parts.withColumns({"owner": owner, "place": F.count(F.lit(1)).over(order)})
    parts = written_once(parts.select("file", "least", "begun", "n", "owner", "place"), "parts")
    long = gathered.where(~cut & (F.col("n") > most_lines)).join(chunks, "least").select("file", F.col("n").cast("bigint"))
    long = long.unionByName(parts.groupBy("file", "owner").agg(F.sum("n").alias("n")).where(F.col("n") > most_lines).drop("owner"))
    if sizes := long.limit(1).collect():
        raise ValueError(f"a cell of {sizes[0].file} stays open over {sizes[0].n} lines")
    several = gathered.where(cut).join(bounded_broadcast(parts.select("least", "begun", "owner", "place")), ["least", "begun"])
    joined = several.groupBy("owner").agg(
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("texts"), F.bool_or("header").alias("header")
    )
    joined = _only(joined, ~F.col("header"), F.array_join(F.transform("texts", lambda x: x["text"]), "\n"))
    return plain.unionByName(whole).unionByName(joined)


def read_split_csv(
    spark: SparkSession, path: str, columns: Sequence[str], cut_extra: bool = False, split_bytes: int | None = None
) -> DataFrame:
    """As ``read_positional_csv``, but a file of any size is read by many tasks. Work is staged in the shared folder."""
    records = csv_records(spark, path, split_bytes)
    cells = F.from_csv("record", row_schema(columns).toDDL(), {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": row_schema(columns).names[-1]})
    # generated, so that the checks on rows do not parse a record anew for every cell they look at
    return checked_rows(records.select(F.inline(F.array(cells))), columns, cut_extra)
