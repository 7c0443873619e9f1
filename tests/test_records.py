"""Records of CSV files read in splits, against Python's own CSV reader and the reader of whole files."""

import csv
import io
import random

import pytest

from stratamart.catalogue.queries import _delivered
from stratamart.sources import records
from stratamart.sources.delimited import read_positional_csv
from stratamart.sources.records import block_states, csv_records, read_split_csv, staged_lines

CELLS = ["", "a", '5" pipe', '"x,y"', '"two\nlines"', '"say ""hi"""', '"""\n"""', '"\n\n"', '"a\n,b\n"""', "tail", '"q" r', '"', " "]


def made_file(path, n, seed, header='"OR\nDER",NOTE,LINE', cells=CELLS[:-2]):
    pick = random.Random(seed)
    lines = [",".join([str(i), pick.choice(cells), pick.choice(cells)]) for i in range(n)]
    path.write_bytes(("﻿" + header + "\n" + "\n".join(lines) + "\n").encode())
    return path


def as_tuples(df):
    return sorted(tuple("" if v is None else v for v in r) for r in df.collect())


@pytest.mark.parametrize("split", [37, 211, 5_000, None])
def test_splits_do_not_change_what_is_read(spark, tmp_path, split):
    for seed in (1, 2):
        made_file(tmp_path / f"f{seed}.csv", 150, seed)
    got = as_tuples(read_split_csv(spark, str(tmp_path), ["a", "b", "c"], split_bytes=split))
    assert got == as_tuples(read_positional_csv(spark, str(tmp_path), ["a", "b", "c"]))
    assert len(got) == 300


def test_records_equal_those_of_a_reader_that_starts_at_the_top(spark, tmp_path):
    path = made_file(tmp_path / "f.csv", 200, 5, header="A,B,C", cells=[c for c in CELLS[:-2] if c != '"q" r'])
    expected = list(csv.reader(io.StringIO(path.read_text().removeprefix("﻿"), newline="")))[1:]
    got = [next(csv.reader(io.StringIO(r.record, newline=""))) for r in csv_records(spark, str(path), 64).collect()]
    assert sorted(got) == sorted(expected)


def test_several_tasks_read_one_file(spark, tmp_path):
    path = made_file(tmp_path / "f.csv", 400, 6)
    lines = staged_lines(spark, str(path), 500)
    assert lines.select("block").distinct().count() > 10
    states = block_states(lines).collect()
    assert {r.plain for r in states} <= {True, False} and any(r.opens for r in states)


def test_a_cell_longer_than_blocks_and_one_that_never_closes(spark, tmp_path):
    inner = "\n".join(f"line {i}" for i in range(60))
    (tmp_path / "f.csv").write_text(f'A,B\n1,"{inner}"\n2,x\n')
    assert as_tuples(read_split_csv(spark, str(tmp_path), ["a", "b"], split_bytes=50)) == [("1", inner), ("2", "x")]
    (tmp_path / "g.csv").write_text('A,B\n1,"open\n' + "2,x\n" * 30)
    with pytest.raises(ValueError, match="stays open"):
        csv_records(spark, str(tmp_path / "g.csv"), 50, most_lines=20)


def test_short_rows_fail_and_blank_ones_go(spark, tmp_path):
    (tmp_path / "f.csv").write_text("A,B\n1,x\n , \n\n,\n2,y,z\n")
    rows = read_split_csv(spark, str(tmp_path), ["a", "b"], cut_extra=True, split_bytes=9)
    assert as_tuples(rows) == [("1", "x"), ("2", "y")]
    (tmp_path / "f.csv").write_text("A,B\n1,x\n2\n")
    with pytest.raises(Exception, match="does not have 2 cells"):
        read_split_csv(spark, str(tmp_path), ["a", "b"], split_bytes=9).collect()


@pytest.mark.parametrize("bits", [1, 3])
def test_lines_are_ordered_in_short_chunks_of_a_large_block(spark, tmp_path, monkeypatch, bits):
    """One block of many chunks: records cross the borders of chunks, and some are longer than a chunk."""
    monkeypatch.setattr(records, "_CHUNK_BITS", bits)
    path = made_file(tmp_path / "f.csv", 120, 8, cells=[*CELLS[:-2], '"' + "x\n" * 20 + '"'])
    lines = staged_lines(spark, str(path))
    assert lines.select("block").distinct().count() == 1
    assert lines.groupBy("chunk").count().agg({"count": "max"}).first()[0] <= 1 << bits
    states = block_states(lines)
    assert states.count() == lines.select("chunk").distinct().count() and states.where("opens").count() > 0
    assert states.where("first").count() == 1
    got = as_tuples(read_split_csv(spark, str(path), ["a", "b", "c"]))
    assert got == as_tuples(read_positional_csv(spark, str(path), ["a", "b", "c"])) and len(got) == 120


def test_deliveries_begin_with_their_header_and_are_written_unsorted(spark, tmp_path):
    spark.range(300).selectExpr("id AS l_orderkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber").write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    for files in (1, 4):
        whole = spark.read.text(_delivered(spark, str(tmp_path), files), wholetext=True).collect()
        assert len(whole) == files
        for text in (r.value for r in whole):
            assert text.startswith("\ufeffORDER,NOTE,LINE\n") and text.count("ORDER") == 1
        keys = sum(len([x for x in r.value.split("\n") if x[:1].isdigit()]) for r in whole)
        assert keys == sum(1 for i in range(300) if i % 7 != 6)


def test_a_record_is_parsed_once(spark, tmp_path):
    path = made_file(tmp_path / "f.csv", 20, 9)
    rows = read_split_csv(spark, str(path), ["a", "b", "c"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") <= 2 * plan.count("Generate inline")
