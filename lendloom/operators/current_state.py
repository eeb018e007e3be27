"""Current-state tables: the latest version of each business key, kept up to date by change-only merges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.session import dropping_shuffles

LOOK_BACK_DAYS = 3


@dataclass(frozen=True)
class Keyed:
    """A current-state table: its business key, and the event times of which the first that isn't null counts."""

    key: str
    event_times: tuple[str, ...]


CUSTOMERS = Keyed("customer_id", ("updated_at", "created_at", "load_timestamp"))
APPLICATIONS = Keyed("application_id", ("decision_date", "application_date", "load_timestamp"))
PAYMENTS = Keyed("payment_id", ("payment_date", "load_timestamp"))


def latest(rows: DataFrame, table: Keyed) -> DataFrame:
    """One row per key: the latest by event time, load, file and record id; an existing row wins a full tie. Null keys go.

    The order's helper column existing_version_priority is used if the rows have it.
    """
    order = [F.coalesce(*(F.col(c).cast("timestamp") for c in table.event_times)).desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in ("load_timestamp", "file_last_modified", "ingestion_record_id")]
    if "existing_version_priority" in rows.columns:
        order.append(F.col("existing_version_priority").desc())
    ranked = rows.where(F.col(table.key).isNotNull()).withColumn("version_rank", F.row_number().over(W.partitionBy(table.key).orderBy(*order)))
    return ranked.where("version_rank = 1").drop("version_rank", "existing_version_priority")


def look_back(staged: DataFrame, target: DataFrame, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Staged rows loaded since some days before the target's last load. The bound is a literal, so that scans prune by it."""
    with dropping_shuffles(target.sparkSession):
        last = target.agg(F.max("load_timestamp").cast("timestamp")).first()[0]
    if last is None:
        return staged
    return staged.where(F.col("load_timestamp") >= F.lit(last) - F.expr(f"interval {days} days"))


def _rank(rows: DataFrame, table: Keyed, like: DataFrame) -> Column:
    """What latest orders by, as a struct to compare by; nulls come first. Columns that the rows lack are null, of like's types."""
    kinds = dict(like.dtypes)
    own = {c: F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]) for c in (*table.event_times, "load_timestamp", "file_last_modified", "ingestion_record_id")}
    return F.struct(F.coalesce(*(own[c].cast("timestamp") for c in table.event_times)), own["load_timestamp"], own["file_last_modified"], own["ingestion_record_id"])


def _supersedes(rank: str, hash: str, held_rank: str, held_hash: str) -> Column:
    """An incoming version that comes later than the one held and differs by record_hash; the one held wins a full tie."""
    return (F.col(rank) > F.col(held_rank)) & (F.coalesce(hash, F.lit("")) != F.coalesce(held_hash, F.lit("")))


def newer(best: DataFrame, target: DataFrame, table: Keyed) -> DataFrame:
    """Rows of best, which has each key once, that are new or supersede what the target holds.

    Of the target only keys, order and hashes are moved.
    """
    held = target.select(F.col(table.key).alias("_key"), _rank(target, table, best).alias("_held"), F.col("record_hash").alias("_hash"))
    both = best.withColumn("_rank", _rank(best, table, best)).join(held, F.col(table.key) == F.col("_key"), "left")
    return both.where(F.col("_key").isNull() | _supersedes("_rank", "record_hash", "_held", "_hash")).select(*best.columns)


def delta(staged: DataFrame, target: DataFrame | None, table: Keyed, days: int | None = LOOK_BACK_DAYS) -> DataFrame:
    """Rows to merge: latest versions that are new or differ by record_hash from what the target holds.

    days: how far before the target's last load staged rows are looked at; None: all of them.

    Without a target these are the latest of all staged rows. With one, the target's rows of incoming keys compete, so an
    older record that arrives late never displaces a newer one, even outside the look-back.
    """
    if target is None:
        return latest(staged, table)
    return newer(latest(staged if days is None else look_back(staged, target, days), table), target, table)


def superseded(target: DataFrame, best: DataFrame, table: Keyed) -> DataFrame:
    """merge(target, newer(best, target)) in one join: neither side is worked out, or moved, a second time."""
    columns = [*target.columns, *(c for c in best.columns if c not in target.columns)]
    held = target.select(F.col(table.key).alias("_key"), _rank(target, table, best).alias("_held"), F.struct("*").alias("_old"))
    own = best.select(F.col(table.key).alias("_own"), _rank(best, table, best).alias("_rank"), F.struct("*").alias("_new"))
    both = held.join(own, F.col("_key") == F.col("_own"), "full").withColumn("_wins", F.col("_old").isNull() | F.coalesce(_supersedes("_rank", "_new.record_hash", "_held", "_old.record_hash"), F.lit(False)))
    side = lambda at, df, c: F.col(f"{at}.{c}") if c in df.columns else F.lit(None)
    return both.select(*(F.when(F.col("_wins"), side("_new", best, c)).otherwise(side("_old", target, c)).alias(c) for c in columns))


def merge(target: DataFrame | None, source: DataFrame, key: str | list[str]) -> DataFrame:
    """target with source's rows in place of those with the same key. New columns are added, old ones are never dropped."""
    if target is None:
        return source
    keys = [key] if isinstance(key, str) else key
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source, allowMissingColumns=True)
