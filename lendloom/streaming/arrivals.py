"""Structured Streaming over arriving files and records: the batch steps, a micro-batch at a time, each done once.

Every step is named by the epoch of its micro-batch, so that one that is run again after a crash replaces what it had done.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lendloom.operators import current_state, validation
from lendloom.plans.ingest import Ingestion
from lendloom.sources.hashes import HashIndex
from lendloom.sources.store import TableStore

EPOCH = "epoch"


def _started(rows: DataFrame, each, checkpoint: str) -> StreamingQuery:
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


# the current state


def late_table(table: str) -> str:
    return f"{table}_LATE"


def _mark(store: TableStore, table: str, rows: DataFrame, epoch: int) -> str | None:
    """The latest load_timestamp that was seen before this epoch; a replay of the epoch gets the same."""
    folder = store.folder(late_table(table))
    note = json.loads(store._note(f"{folder}/_MARK") or "{}")
    if note.get("epoch") == epoch:
        return note["before"]
    if note:
        before = note["after"]
    else:
        held = store.read(table)
        before = held.agg(F.max("load_timestamp").cast("string")).first()[0] if held is not None else None
    now = rows.agg(F.max("load_timestamp").cast("string")).first()[0]
    store._put_note(folder, "_MARK", json.dumps({"epoch": epoch, "before": before, "after": max((x for x in (before, now) if x), default=None)}))
    return before


def merge_stream(staged: DataFrame, store: TableStore, table: str, keyed: current_state.Keyed, checkpoint: str, days: int = current_state.LOOK_BACK_DAYS) -> StreamingQuery:
    """Keeps a current-state table up to date from a stream of staged records.

    The mark is the latest load time seen in earlier micro-batches. Rows that were loaded more than `days` before it, which a
    look-back in batches would miss, are ranked like all others, so they never displace a newer version nor get lost; they are
    also kept in the table's _LATE table, by epoch, where late_rows counts them.

    A micro-batch isn't kept between the steps: each reads it again from the source, and of its columns what it needs.
    """

    def merge(rows: DataFrame, epoch: int) -> None:
        if rows.isEmpty():
            return
        before = _mark(store, table, rows, epoch)
        kind = dict(rows.dtypes)["load_timestamp"]
        late = rows.where(F.col("load_timestamp") < F.lit(before).cast(kind) - F.expr(f"interval {days} days")) if before else rows.limit(0)
        store.write_batch(late_table(table), late, str(epoch), by=EPOCH)
        store.merge(table, current_state.delta(rows, store.read(table), keyed, days=None), keyed.key)

    return _started(staged, merge, checkpoint)


def late_rows(store: TableStore, table: str) -> DataFrame:
    """(epoch, n_late) of each micro-batch that had late rows."""
    return store.read(late_table(table)).groupBy(EPOCH).agg(F.count("*").alias("n_late"))


# records


def first_records(records: DataFrame, horizon: str, at: str, key: str = "record_hash", id: str = "ingestion_record_id") -> DataFrame:
    """The stream without records whose key came before within the horizon. Null keys never repeat.

    The state has a key for each record of the horizon, by the executors that the key's hash falls to, and forgets it after;
    `at` is the time of arrival, which never falls behind by more than the horizon: what does is dropped by the state.
    """
    own = F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("r"), id))
    return records.withColumn("_key", own).withWatermark(at, horizon).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def load_stream(records: DataFrame, store: TableStore, table: str, checkpoint: str, horizon: str = "3 days", at: str | None = None) -> StreamingQuery:
    """Appends the records of a stream to a raw table, each hash once, as duplicate marks of batches would have it.

    What repeats within the horizon is left out by keyed state; what repeats later is found by the table's hash index.
    at: a column with the time of arrival; without it a record arrives when its micro-batch is read, so none is ever late.
    """
    arrived = at or "_arrived"
    rows = records if at else records.withColumn(arrived, F.current_timestamp())
    rows = first_records(rows, horizon, arrived)
    rows = rows if at else rows.drop(arrived)

    def load(rows: DataFrame, epoch: int) -> None:
        batch, index = f"stream-{epoch}", HashIndex(store, table)
        rows.persist()
        try:
            index.catch_up(but=batch)
            new = validation.mark_known(rows, index.known(rows, but=batch)).where("processed_status = 'PENDING'").drop("processed_status")
            store.write_batch(table, new, batch)
            index.add(batch)
        finally:
            rows.unpersist()

    return _started(rows, load, checkpoint)


# files


def batch_of(checkpoint: str, entity: str, epoch: int) -> str:
    """The id of an epoch's batch: the same when the epoch is run again."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}/{entity}/{epoch}"))


def ingest_stream(job: Ingestion, entity: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Runs the ingestion, from discovery to reconciliation, over the files of an entity as they land, a batch an epoch.

    Spark's file source gives each file to one epoch. The batch's id follows from the epoch: an epoch that is run again finds
    its batch done and does nothing, or begins it anew, replacing whatever a crash between two steps left. A batch that fails
    ends the stream; its epoch is tried again when the stream is started again.
    """
    contract = job.contract(entity)
    reader = job.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True)
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
    found = reader.load(f"{job.landing.rstrip('/')}/{contract.stage_path}").select("path", "length", "modificationTime")

    def ingest(files: DataFrame, epoch: int) -> None:
        out = job.run(entity, batch_id=batch_of(checkpoint, entity, epoch), found_files=files)
        if out["status"] == "FAILED":
            raise RuntimeError(f"epoch {epoch} of {entity}: {out}")

    return _started(found, ingest, checkpoint)
