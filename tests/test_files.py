"""Checksums of files that are streamed, and VARIANT columns of which only the paths asked for are read."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lendloom.operators import staging
from lendloom.plans import contracts, raw_catalogue
from lendloom.session import settings
from lendloom.sources.files import WHOLE, list_files, streamed_checksums
from lendloom.sources.store import TableStore

MARK = b"\xef\xbb\xbf"


def test_streamed_checksums_are_those_of_the_content(spark, tmp_path):
    rng = random.Random(3)
    contents = {"a.csv": b"x,y\r\n1,2\r\n", "b.csv": b"x\ny", "c.bin": rng.randbytes(300_000), "d.csv": b"\n\n", "e.csv": MARK + b"x\n1\n", "f.csv": MARK + b"x", "g[1] +%20.csv": "é ß\x00\r".encode() * 40_000, "h.csv": b"no end" * 100_000, "i.csv": b"\n"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    listed = list_files(spark, str(tmp_path), whole=0).collect()
    assert {r.file_name: r.file_checksum for r in listed} == {n: hashlib.md5(c).hexdigest() for n, c in contents.items()}
    some = {r.file_name: r.file_checksum for r in list_files(spark, str(tmp_path), whole=100).collect()}
    assert some == {r.file_name: r.file_checksum for r in listed}
    (tmp_path / "z.csv.gz").write_bytes(__import__("gzip").compress(b"text\n" * 1000))
    with pytest.raises(Exception, match="compressed"):
        streamed_checksums(spark, [str(tmp_path / "z.csv.gz")])


def test_large_files_are_streamed_by_a_task_each(spark, tmp_path):
    """at 1 GB each slot held a file of 200 MB several times over, and files to stream all went to one task."""
    contents = {f"{k}.json": f"line {k}\n".encode() * 9000 for k in range(6)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    assert WHOLE <= 1 << 25
    tracker, before = spark.sparkContext.statusTracker(), set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    sums = dict(streamed_checksums(spark, [str(tmp_path / n) for n in contents], 63_000))
    tasks = sum(tracker.getStageInfo(s).numTasks for j in set(tracker.getJobIdsForGroup(None)) - before for s in tracker.getJobInfo(j).stageIds)
    assert {p.rsplit("/", 1)[-1]: m for p, m in sums.items()} == {n: hashlib.md5(c).hexdigest() for n, c in contents.items()} and tasks == 6
    compressed = tmp_path / "z.csv.gz"
    compressed.write_bytes(__import__("gzip").compress(random.Random(1).randbytes(WHOLE + 1)))
    listed = {r.file_name: r.file_checksum for r in list_files(spark, str(tmp_path)).collect()}
    assert listed["z.csv.gz"] == hashlib.md5(compressed.read_bytes()).hexdigest()


def test_landed_files_without_rows_are_good_files(spark, tmp_path):
    """of a table of one row group the first task has no row of it, and writes a file without rows."""
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}):
        got = raw_catalogue.landed_parquet_files(spark, str(tmp_path)).first()
    assert tuple(got) == (spark.read.parquet(str(tmp_path / "lineitem.parquet")).count(), 0)


def test_staging_reads_only_its_paths_of_the_records(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    fields = {f: F.concat(F.lit(f), F.col("id").cast("string")) for f in contracts.PAYMENTS.fields} | {"payment_amount": F.col("id").cast("string")}
    raw = spark.range(5000).select(F.to_variant_object(F.struct(*(v.alias(k) for k, v in fields.items()))).alias("raw_record"), F.lit("h").alias("record_hash"))
    store.write_batch("RAW.T", raw, "B")
    staged = staging.stg_payments(store.read("RAW.T")).select("payment_id", "payment_amount")
    plan = staged._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<raw_record:struct<0:string,1:string>>" in plan
    assert staged.where("payment_amount = 17").first().payment_id == "payment_id17"
