"""Session settings that the library's results rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: UTC keeps timestamps comparable across engines; ANSI makes bad casts fail loudly (try_* is used where they may fail);
#: VARIANT columns are written with their fields as columns of their own, of which a scan reads what is asked for.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def get_session(app: str = "lendloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app).config(map=CONF | conf)
    return (builder.master(master) if master else builder).getOrCreate()


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings that hold for a while."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dropping_shuffles(spark: SparkSession):
    """Jobs begun in here leave no shuffle files; else these stay until the driver happens to collect its garbage."""
    return settings(spark, **{"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see, below spark.checkpoint.dir; a temporary one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="lendloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
