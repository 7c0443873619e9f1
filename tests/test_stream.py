"""Streamed arrivals against batch loads."""

import shutil

import pytest

from stratamart.sources.bronze import load_listings_label
from stratamart.sources.tables import Warehouse
from stratamart.streaming.stream import stream_arrivals, stream_listings
from tests.test_pipeline import LABELS, PERIODS, write_deliveries


def stored(warehouse):
    rows = warehouse.read("bronze.listings_raw").drop("loaded_at").collect()
    return sorted(map(tuple, rows), key=str)


def test_a_stream_loads_like_batch_runs(spark, tmp_path):
    listings = f"{write_deliveries(tmp_path / 'in')}/listings"
    batch, streamed = (Warehouse(spark, str(tmp_path / name)) for name in ("batch", "streamed"))
    for label in LABELS:
        load_listings_label(batch, listings, label)
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()
    for label in LABELS[2:]:
        shutil.copy(f"{listings}/{label}.csv", landing)
    assert stream_listings(streamed, str(landing), checkpoint) == [[*LABELS[2:]]]  # oldest first
    for label in LABELS[:2]:
        shutil.copy(f"{listings}/{label}.csv", landing)
    assert stream_listings(streamed, str(landing), checkpoint) == [[*LABELS[:2]]]
    assert stored(streamed) == stored(batch)
    assert stream_listings(streamed, str(landing), checkpoint) == []
    # the same batches again: the same months with the same rows
    assert stream_listings(streamed, str(landing), str(tmp_path / "empty")) == [[*LABELS]]
    assert stored(streamed) == stored(batch)


def test_a_month_that_gets_another_file_is_loaded_whole(spark, tmp_path):
    listings = f"{write_deliveries(tmp_path / 'in')}/listings"
    warehouse, landing, checkpoint = Warehouse(spark, str(tmp_path / "warehouse")), tmp_path / "landing", str(tmp_path / "checkpoint")
    month = landing / f"{LABELS[0]}.csv"
    month.mkdir(parents=True)
    shutil.copy(f"{listings}/{LABELS[0]}.csv", month / "part-0.csv")
    stream_listings(warehouse, str(landing), checkpoint)
    n = len(stored(warehouse))
    shutil.copy(f"{listings}/{LABELS[0]}.csv", month / "part-1.csv")
    assert stream_listings(warehouse, str(landing), checkpoint) == [[LABELS[0]]]
    assert len(stored(warehouse)) == 2 * n and warehouse.slices("bronze.listings_raw", "load_month") == PERIODS[:1]


def test_a_stopped_load_is_repeated_and_other_names_are_refused(spark, tmp_path):
    landing, checkpoint, seen = tmp_path / "landing", str(tmp_path / "checkpoint"), []
    landing.mkdir()
    (landing / "03_2021.csv").write_text("A\n1\n")

    def stop(label):
        seen.append(label)
        if len(seen) == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        stream_arrivals(spark, str(landing), checkpoint, stop)
    assert stream_arrivals(spark, str(landing), checkpoint, stop) == [["03_2021"]] and seen == ["03_2021"] * 2
    (landing / "notes.csv").write_text("A\n1\n")
    with pytest.raises(Exception):
        stream_arrivals(spark, str(landing), checkpoint, stop)
    assert len(seen) == 2
