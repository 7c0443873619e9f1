"""Positional CSV with strict row lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stratamart.schemas import text_schema

_RAW = "_raw_row"


# A cell is quoted only when a quote opens it; quotes further on in a cell are ordinary signs.
CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
_WHOLE_LINE = rf"^(?:{CELL},)*+{CELL}$"


def _require_whole_lines(spark: SparkSession, path: str) -> None:
    """Fail when a quoted cell is still open at the end of a line."""
    broken = spark.read.text(path).where(~F.col("value").rlike(_WHOLE_LINE)).limit(1).collect()
    if broken:
        raise ValueError(f"a cell spans lines, read with multiline=True: {broken[0].value[:200]}")


def read_positional_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    cut_extra: bool = False,
    multiline: bool = True,
) -> DataFrame:
    """Delivered rows as text columns, bound by position; the header line is skipped.

    Fully blank rows are dropped. A row with too few cells fails the job that reads it. Cells
    beyond the last column are cut with ``cut_extra`` and fail the job otherwise. Empty cells,
    quoted or not, are NULL; quotes inside a quoted cell are doubled; a line break inside one
    reads as a single newline; a byte-order mark is ignored.

    ``path`` may be a file or a folder of files. A file is read by one task, as any cell may hold
    line breaks, whatever the file's size; ``records.read_split_csv`` reads large files by many. The caller may
    state with ``multiline=False`` that no cell does; files are then read in splits, after a pass over
    the lines that fails when the statement is wrong.
    """
    if not multiline:
        _require_whole_lines(spark, path)
    rows = (
        spark.read.schema(row_schema(columns))
        .option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        # row lengths are checked on every read, whatever columns a query asks for
        .option("columnPruning", False)
        .csv(path)
    )
    return checked_rows(rows, columns, cut_extra)


def row_schema(columns: Sequence[str]) -> StructType:
    """The columns as text, and last the raw row of another length."""
    return text_schema(tuple(columns)).add(_RAW, StringType())


def checked_rows(rows: DataFrame, columns: Sequence[str], cut_extra: bool) -> DataFrame:
    """Rows of ``row_schema`` without blank ones; a row with too few cells (or, uncut, too many) fails the job."""
    odd = F.col(_RAW).isNotNull()  # a row of another length than the schema
    cells = F.regexp_count(_RAW, F.lit(rf"(?:^|,){CELL}"))
    accepted = cells > len(columns) if cut_extra else F.lit(False)
    # most rows show by their first cell that they are not blank, without all cells put together
    first = F.coalesce(F.col(columns[0]).rlike(r"(?U)\S"), F.lit(False))
    filled = F.when(odd, F.col(_RAW).rlike(r'(?U)[^",\s]')).otherwise(
        first | F.concat_ws("", *[F.col(c) for c in columns]).rlike(r"(?U)\S")
    )
    refused = F.raise_error(
        F.concat(F.lit(f"row does not have {len(columns)} cells: "), F.substring(_RAW, 1, 200))
    ).cast("boolean")
    return rows.where(
        F.when(~filled, False).when(~odd | accepted, True).otherwise(refused)
    ).drop(_RAW)
