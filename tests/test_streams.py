"""Streams against the batch steps: replays, restarts and rows that come late."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.operators import current_state, validation
from lendloom.plans import stored_catalogue
from lendloom.plans.contracts import CUSTOMERS
from lendloom.plans.ingest import BATCHES, FILES, RECONCILIATIONS, Ingestion
from lendloom.sources.store import TableStore
from lendloom.streaming import arrivals

VERSION = "customer_id string, updated_at timestamp, created_at timestamp, load_timestamp timestamp, file_last_modified timestamp, ingestion_record_id string, record_hash string"


def version(key, updated, loaded, hash):
    day = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(days=d)
    return (key, day(updated), day(updated), day(loaded), None, hash, hash)


def test_late_rows_are_ranked_and_counted(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    batches = [
        [version("C1", 2, 10, "newer"), version("C2", 1, 10, "c2")],
        [version("C1", 1, 12, "older"), version("C3", 5, 12, "c3")],
        [version("C2", 9, 2, "late but newer"), version("C1", 0, 3, "late and older"), version("C4", 1, 1, "late and new"), version("C5", 1, 9, "in the look-back")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(VERSION).parquet(str(tmp_path / "in"))
        arrivals.merge_stream(stream, store, "SILVER.customers", current_state.CUSTOMERS, str(tmp_path / "check")).awaitTermination(60)
    got = {r.customer_id: r.record_hash for r in store.read("SILVER.customers").collect()}
    everything = spark.createDataFrame([r for b in batches for r in b], VERSION)
    assert got == {r.customer_id: r.record_hash for r in current_state.latest(everything, current_state.CUSTOMERS).collect()}
    assert got["C2"] == "late but newer" and len(got) == 5
    assert [tuple(r) for r in arrivals.late_rows(store, "SILVER.customers").collect()] == [("2", 3)]


def test_an_epoch_that_is_merged_again_counts_the_same_late_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([version("C1", 1, 10, "a")], VERSION)
    later = spark.createDataFrame([version("C1", 2, 20, "b"), version("C2", 2, 5, "c")], VERSION)
    assert arrivals._mark(store, "S.T", rows, 0) is None
    assert arrivals._mark(store, "S.T", later, 1) == arrivals._mark(store, "S.T", later, 1) == "2026-01-11 00:00:00"
    assert arrivals._mark(store, "S.T", rows, 2) == "2026-01-21 00:00:00"


def test_a_stream_of_payments_keeps_no_copy_of_its_batches(spark, monkeypatch, tmp_path):
    """batches were kept on disk between the steps, and landed as records several times as large as the table."""
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: pytest.fail("a batch is kept"))
    monkeypatch.setattr(stored_catalogue, "scratch_folder", lambda spark, name: f"{tmp_path}/{name}")
    assert stored_catalogue.stream_late_rows(spark, "/root/testdata/sf0.001").count() > 0
    landed = sum(f.stat().st_size for f in (tmp_path / "late" / "in").glob("*.parquet"))
    assert landed < 3 * os.path.getsize("/root/testdata/sf0.001/lineitem.parquet")


RECORD = "ingestion_record_id string, record_hash string, arrived timestamp"


def records(spark, rows):
    return spark.createDataFrame([(i, h, dt.datetime(2026, 1, d)) for i, h, d in rows], RECORD)


PARTS = [
    [("1", "x", 1), ("2", "y", 1), ("3", "y", 1), ("n1", None, 1)],
    [("4", "x", 2), ("5", "z", 3), ("n2", None, 3)],
    [("6", "w", 9)],
    [("7", "x", 10), ("8", "w", 10), ("9", "v", 10)],
]


def land(spark, folder, rows):
    records(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(RECORD).parquet(folder)


def test_state_drops_what_repeats_within_the_horizon(spark, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for part in PARTS:  # each start is a restart from the checkpoint
        stream = arrivals.first_records(land(spark, str(tmp_path / "in"), part), "3 days", "arrived")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination(60)
    got = Counter(r.record_hash for r in spark.read.parquet(out).collect())
    # the batch mark over the records of the horizon, and x once more, which came back beyond it
    near = records(spark, PARTS[0] + PARTS[1])
    pending = validation.mark_duplicates(near, near.limit(0), within=True).where("processed_status = 'PENDING'")
    assert Counter(r.record_hash for r in pending.collect()) == {"x": 1, "y": 1, "z": 1, None: 2}
    assert got == {"x": 2, "y": 1, "z": 1, "w": 1, "v": 1, None: 2}


def test_records_are_loaded_once_however_late_they_repeat(spark, tmp_path):
    store, source = TableStore(spark, str(tmp_path / "store")), str(tmp_path / "in")
    for part in PARTS:
        arrivals.load_stream(land(spark, source, part), store, "RAW.T", str(tmp_path / "check"), at="arrived").awaitTermination(60)
    everything = records(spark, [r for p in PARTS for r in p])
    pending = validation.mark_duplicates(everything, everything.limit(0), within=True).where("processed_status = 'PENDING'")
    loaded = store.read("RAW.T")
    assert Counter(r.record_hash for r in loaded.collect()) == Counter(r.record_hash for r in pending.collect())
    again = loaded.drop("batch_id").where("record_hash = 'v'")
    arrivals.load_stream(land(spark, source, [("10", "v", 11), ("11", "u", 11)]), store, "RAW.T", str(tmp_path / "check"), at="arrived").awaitTermination(60)
    assert store.read("RAW.T").count() == loaded.count() + 1 and again.count() == 1


HEAD = "customer_id,customer_name,email,city,customer_status,created_at,updated_at\n"


def customers(*ids):
    return HEAD + "".join(f"{i},Name {i},{'a@b.c' if i > 0 else 'bad'},oslo,ACTIVE,2026-01-01 00:00:00,\n" for i in ids)


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["stage", "validate", "load", "_set_batch"])
def test_files_are_loaded_once_though_a_step_is_lost(spark, tmp_path, monkeypatch, step):
    (tmp_path / "landing" / "customers").mkdir(parents=True)
    (tmp_path / "landing" / "customers" / "a.csv").write_text(customers(1, 2, -3))
    job = Ingestion(spark, TableStore(spark, str(tmp_path / "store")), str(tmp_path / "landing"))
    start = lambda: arrivals.ingest_stream(job, "customers", str(tmp_path / "check"))
    act = getattr(job, step)

    def broken(*args, **values):
        if step != "_set_batch" or values.get("batch_status") == "COMPLETED":
            raise Lost
        return act(*args, **values)

    monkeypatch.setattr(job, step, broken)
    with pytest.raises(Exception):
        start().awaitTermination(60)
    monkeypatch.undo()
    start().awaitTermination(60)
    raw = job.store.read(CUSTOMERS.raw_target_table)
    assert raw.count() == 2 and job.store.read(BATCHES).count() == 1 and job.store.read(FILES).count() == 1
    batch = job.store.read(BATCHES).first()
    assert (batch.batch_status, batch.source_row_count, batch.loaded_row_count, batch.rejected_row_count, batch.duplicate_row_count) == ("COMPLETED", 3, 2, 1, 0)
    if step != "load":
        return
    start().awaitTermination(60)  # nothing new
    assert job.run("customers", batch_id=batch.batch_id)["done_before"]
    (tmp_path / "landing" / "customers" / "b.csv").write_text(customers(1, 2, -3))
    (tmp_path / "landing" / "customers" / "c.csv").write_text(customers(2, 5))
    start().awaitTermination(60)
    assert job.store.read(CUSTOMERS.raw_target_table).count() == 3
    assert {(r.file_name, r.file_status, r.skip_reason) for r in job.store.read(FILES).collect()} == {("a.csv", "LOADED", None), ("b.csv", "SKIPPED", "DUPLICATE_FILE_CONTENT"), ("c.csv", "LOADED", None)}
    assert {(r.source_row_count, r.loaded_row_count, r.duplicate_row_count, r.reconciliation_status) for r in job.store.read(RECONCILIATIONS).collect()} == {(3, 2, 0, "PASSED"), (2, 1, 1, "PASSED")}
