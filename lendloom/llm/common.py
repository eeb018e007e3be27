"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
A_TO_Z, A_TO_Z_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors see: spark.checkpoint.dir; where unset, a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="lendloom-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that lost executors don't bring its history back."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, by: str | None = None) -> Callable[[], DataFrame]:
    """Writes df as Parquet to a new folder of the shared one, in parts by a column's values if asked; each call of what it
    returns reads it anew, so that the parts can be joined with each other."""
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(folder)
    return lambda: df.sparkSession.read.schema(df.schema).parquet(folder)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until df has no column called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rows_of(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few at a time, so that long texts aren't all turned into Python objects at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def values_of(column: pa.Array, step: int = 256) -> Iterator:
    """Values of an Arrow column, a few at a time."""
    for i in range(0, len(column), step):
        yield from column.slice(i, step).to_pylist()


def comparable(df: DataFrame, name: str) -> Column:
    """A column that can be hashed and compared: maps and VARIANT, at any depth, as JSON text."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(name)) if "map<" in kind or "variant" in kind else F.col(name)


#: Repeated rows are numbered in pieces of this many, each dealt to a task by itself.
PIECE = 10_000


def repeated(rows: DataFrame, n: str, number: str) -> DataFrame:
    """Each row n times, numbered from 1 in the column `number`.

    A row that is repeated more than PIECE times is first divided into pieces, which are dealt out over the tasks, so that
    no task makes all copies of a row. rows should be kept, as they are read twice.
    """
    one, size = F.lit(1).cast("long"), F.lit(PIECE).cast("long")
    out = rows.where(F.col(n) <= PIECE).withColumn(number, F.explode(F.sequence(one, F.col(n))))
    often, piece = rows.where(F.col(n) > PIECE), free_name(rows, "_piece")
    if often.isEmpty():
        return out
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = often.withColumn(piece, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / size)))).repartition(tasks, piece)
    last = F.least(F.col(n), (F.col(piece) + 1) * size)
    return out.unionByName(pieces.withColumn(number, F.explode(F.sequence(F.col(piece) * size + 1, last))).drop(piece))


def literal_table(spark: SparkSession, rows_as_json: str, fields: str) -> DataFrame:
    """A small table from a JSON list of objects, made inside the JVM."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(rows_as_json), f"array<struct<{fields}>>")).alias("r")).select("r.*")
