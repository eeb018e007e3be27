"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.llm.common import cut_lineage, repeated, text_bytes

#: The ring has 2**16 cells, whatever the input's size; a cell is the unit that moves on when a shard is full.
CELL_BITS = 16
#: Cells of over a FINE-th of a shard's share are placed by classes of size, each up to CLASS times the one below.
FINE, CLASS = 64, 4
#: Hash seeds of documents and virtual nodes.
DOCUMENT, NODE = 101, 202


def virtual_nodes(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """(cell, shard): where the shards' virtual nodes stand on the ring."""
    at = F.shiftrightunsigned(F.xxhash64(F.lit(NODE), F.col("shard"), F.col("node")), 64 - CELL_BITS)
    grid = spark.range(shards * nodes).select((F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("node"))
    return grid.groupBy(at.cast("int").alias("cell")).agg(F.min("shard").alias("shard"))


def _clockwise(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """cells with the shard of the first virtual node at or after each; past the last one the ring starts again.

    The window sees the cells and nodes of one ring, at most 2**16 of each.
    """
    both = cells.select("cell", "size", "rows", F.lit(None).cast("int").alias("shard")).unionByName(nodes.select("cell", F.lit(None).cast("long").alias("size"), F.lit(None).cast("long").alias("rows"), "shard"))
    order = [F.col("cell").desc(), F.col("shard").asc_nulls_last()]
    after = F.last("shard", ignorenulls=True).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    start = F.last("shard", ignorenulls=True).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return both.withColumn("shard", F.coalesce(after, start)).where("size is not null")


def place_cells(cells: DataFrame, shards: int, nodes: int) -> DataFrame:
    """(cell, rows, shard) for cells (cell, size, rows).

    Each cell goes to the first open shard clockwise. A shard takes its largest cells first, as long as they fit its share
    of all bytes, and is full once one doesn't fit; what it can't take goes on clockwise, to the next shard that is still
    open. An empty shard takes a cell of any size. Cells that are large beside a share go before the smaller ones, a class of
    sizes at a time, and a shard that was full for a class is open again for the next, so that gaps are filled. What no shard
    had room for is given out at the end, again clockwise, to shards that haven't reached their share. Each round fills a
    shard or places the rest; with many documents all cells are in one class. Only the shards' loads come to the driver.
    """
    spark = cells.sparkSession
    share = (cells.agg(F.sum("size")).first()[0] or 0) / shards
    ring = cut_lineage(virtual_nodes(spark, shards, nodes))
    used, placed, left = dict.fromkeys(range(shards), 0), [], []
    there = W.partitionBy("shard").orderBy(F.col("size").desc(), "cell").rowsBetween(W.unboundedPreceding, -1)

    def tried(waiting: DataFrame, is_open: list[int], fitting: bool) -> tuple[DataFrame, list]:
        load = F.create_map(*(F.lit(x) for s in is_open for x in (s, float(used[s]))))
        before = load[F.col("shard")] + F.coalesce(F.sum("size").over(there), F.lit(0))
        fits = (before + F.col("size") <= share) | (before == 0) if fitting else (before < share) | F.lit(share == 0)
        out = cut_lineage(_clockwise(waiting, ring.where(F.col("shard").isin(is_open))).withColumn("fits", fits))
        placed.append(out.where("fits").select("cell", "rows", "shard"))
        loads = out.groupBy("shard", "fits").agg(F.sum("size").alias("size")).collect()
        for r in loads:
            used[r.shard] += r.size if r.fits else 0
        return out.where("not fits").select("cell", "size", "rows"), [r.shard for r in loads if not r.fits]

    least = max(share / FINE, 1.0)
    of_class = F.when(F.col("size") < least, 0).otherwise(1 + F.floor(F.log(F.col("size") / least) / F.log(F.lit(CLASS)) + 1e-9))
    classes = [r.c for r in cells.groupBy(of_class.cast("int").alias("c")).count().collect()]
    for own in sorted(classes, reverse=True):
        waiting, fitting = cells.where(of_class == own), set(range(shards))
        while fitting:
            waiting, full = tried(waiting, sorted(fitting), True)
            fitting -= set(full)
            if not full:
                break
        else:
            left.append(waiting)
    waiting = reduce(DataFrame.unionByName, left) if left else None
    while waiting is not None:
        waiting, full = tried(waiting, [s for s, n in used.items() if n < share] or sorted(used), False)
        waiting = waiting if full else None
    return reduce(DataFrame.unionByName, placed) if placed else cells.select("cell", "rows", F.lit(0).alias("shard"))


def shard_documents(docs: DataFrame, shards: int = 40, nodes: int = 128, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of each document; law is `bytes`: sizes near equal.

    A document's place on the ring is the hash of its id and checksum, so that equal texts of different ids spread out: to
    keep groups of equal texts together would break the law where one group holds a third of all rows. Rows equal in id,
    size and checksum are counted before anything else, and each is placed by its number, so these spread out too; they are
    numbered in pieces, over many tasks. Sizes are
    the text's UTF-8 bytes (a null or empty text has none) plus 16; a long text is one document. The ring's cells are summed
    up first, so that what is placed doesn't grow with the input; only ids, sizes and checksums are shuffled. slot counts
    from 0 within a shard, by cell and then id. grown_shard is null, as this law moves rows between old shards too. An empty
    table gives no rows; other columns are not carried.
    """
    body = text_bytes(text)
    cell = F.shiftrightunsigned(F.xxhash64(F.lit(DOCUMENT), F.col("id"), F.col("text_crc32"), F.col("number")), 64 - CELL_BITS).cast("int")
    equal = docs.select(F.col(id).alias("id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32")).groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n"))
    rows = cut_lineage(repeated(cut_lineage(equal), "n", "number").withColumn("cell", cell))
    cells = cut_lineage(rows.groupBy("cell").agg(F.sum("size").alias("size"), F.count("*").alias("rows")))
    before = F.coalesce(F.sum("rows").over(W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    at = place_cells(cells, shards, nodes).select("cell", "shard", before.alias("before"))
    within = F.row_number().over(W.partitionBy("cell").orderBy("id", "text_crc32", "size", "number"))
    joined = rows.join(F.broadcast(at), "cell")  # at most 2**16 rows of 16 bytes
    return joined.select(F.col("id").alias(id), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("before") + within - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
