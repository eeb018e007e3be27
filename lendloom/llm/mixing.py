"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendloom.llm.common import WORD, cut_lineage, free_name, repeated, text_bytes

#: Weights of the sources in order, again and again.
WEIGHTS = (3, 1, 2)
#: The mix holds this many times all sizes, and no source more often than this.
SHARE, MOST = 1.5, 2
#: Steps of the virtual clock while the cut is searched.
CLOCK = 4096
#: A table of sources up to this many rows is broadcast.
BROADCAST_SOURCES = 10_000
SEED = "mix-1"


def source_targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, target) for rows (source, size): each source's share by weight, at most MOST times its size.

    Sources that would get more stop there, and the excess is shared among the others by weight until none is above. In
    order of MOST * size / weight the sources that stop come first, so the level of the others follows from running sums
    over the table of sources.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST)
    everything, earlier = W.partitionBy(), W.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    stopped, stopped_weight = (F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("most", "weight"))
    level = (F.sum("source_size").over(everything) * SHARE - stopped) / (F.sum("weight").over(everything) - stopped_weight)
    fits = F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(W.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return sources.withColumn("level", level).withColumn("level", F.coalesce(first, F.lit(0.0))).select("source", "source_size", F.least(F.col("level") * F.col("weight"), F.col("most").cast("double")).alias("target"), "rank")


def _cut(copies: DataFrame, budget: float) -> float:
    """The latest finish time up to which the copies (finish, size) in order of it hold at most `budget` words.

    The time is found by dividing it into steps whose sums are added up, first of all times, then of the step in which the
    budget ends, until that has few copies; each is one aggregation, and no more than the steps' sums are ordered at once.
    """
    low, width, before, here = 0.0, 1 / CLOCK, 0, copies
    while True:
        step = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(2 * CLOCK)).alias("step")
        sums = here.groupBy(step).agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.max("finish").alias("last"))
        running = sums.select("step", "n", "last", (F.sum("size").over(W.orderBy("step")) + before).alias("until"), "size")
        over = running.where(F.col("until") > budget).orderBy("step").first()
        if over is None:
            return math.inf
        low, before = low + over.step * width, over.until - over.size
        here = here.where((F.col("finish") >= F.lit(low)) & (F.col("finish") < F.lit(low + width) if over.step < 2 * CLOCK else F.lit(True)))
        if over.n <= 100_000 or width < 1e-9:
            break
        width /= CLOCK
    times = here.groupBy("finish").agg(F.sum("size").alias("size")).select("finish", (F.sum("size").over(W.orderBy("finish")) + before).alias("until"))
    last = times.where(F.col("until") <= budget).agg(F.max("finish")).first()[0]
    return math.nextafter(low, -1) if last is None else last


def shuffle_key(id: str, text: str, seed: str) -> Column:
    """A hash of id and text, by which a source's documents are shuffled."""
    return F.md5(F.concat_ws("-", F.lit(seed), F.col(id).cast("string"), F.md5(text_bytes(text))).cast("binary"))


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """(id, size, source_size, target, taken) of each document: how many of its words the mix takes, whole copies only.

    A source's documents are shuffled by a hash of id and text. A copy's virtual finish time is its source's words up to it,
    in that order, divided by the source's target; a second round follows the first, so a document is taken twice at most.
    All copies are then cut at one finish time, the latest at which the mix holds no more than its budget, so each source is
    within about a document of its target. The cut is searched by adding up the copies in steps of the time, which gives the
    place that sorting all of them would. A source's words are added up in 4096 cells of the hash and then within each, so
    a source with most rows is dealt out like any other; rows equal in id, source and text are one row with a count until
    the end. Null and empty texts have size 0 and are never taken; a long text is one document; a null source is a source of
    its own, in the last place. An empty table gives no rows.
    """
    rows, cut = _mixed(docs, id, text, source, seed)
    out = repeated(rows, "n", "j")
    taken = sum((F.when(_finish(k, F.col("j")) <= F.lit(cut), F.col("size")).otherwise(F.lit(0)) for k in range(MOST)), F.lit(0))
    return out.select(F.col("id").alias(id), "size", "source_size", "target", taken.cast("long").alias("taken"))


def _broadcast_if_few(sources: DataFrame) -> DataFrame:
    """A table of a row a source: with up to BROADCAST_SOURCES rows it is broadcast, else Spark joins by source and splits a
    hot one. Both give the same rows."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def _finish(k: int, j: Column) -> Column:
    """Virtual finish time of a row's j-th equal document in round k; null for what is never taken."""
    words = F.col("before") + j * F.col("size") + k * F.col("source_size")
    return F.when((F.col("target") > 0) & (F.col("size") > 0), words / F.col("target"))


def _mixed(docs: DataFrame, id: str, text: str, source: str, seed: str) -> tuple[DataFrame, float]:
    """Rows (id, source, rank, h, size, n, source_size, target, before) of n equal documents each, and the time of the cut.

    before: the words of the source's documents that come earlier.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(source).alias("source"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"), shuffle_key(id, text, seed).alias("h"))
    rows = cut_lineage(rows.groupBy("id", "source", "size", "h").agg(F.count("*").alias("n")))
    targets = cut_lineage(source_targets(rows.select("source", (F.col("size") * F.col("n")).alias("size"))))
    targets = _broadcast_if_few(targets)
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).select("id", rows["source"], "size", "n", "source_size", "target", "rank", "h", F.substring("h", 1, 3).alias("cell"))
    words = F.sum(F.col("size") * F.col("n"))
    cells = rows.groupBy("rank", "cell").agg(words.alias("words"))
    cells = cells.select("rank", "cell", F.coalesce(F.sum("words").over(W.partitionBy("rank").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("cell_before"))
    earlier = words.over(W.partitionBy("rank", "cell").orderBy("h", "id", "size").rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(cells, ["rank", "cell"]).withColumn("before", F.col("earlier") + F.col("cell_before"))
    rows = cut_lineage(rows.select("id", "source", "rank", "h", "size", "n", "source_size", "target", "before"))
    each = repeated(rows, "n", "j")
    copies = each.select(F.explode(F.array(*(_finish(k, F.col("j")) for k in range(MOST)))).alias("finish"), "size").where("finish is not null")
    budget = (rows.agg(words).first()[0] or 0) * SHARE
    return rows, _cut(copies, budget)


def take_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs as the mix takes them: a document that it takes twice has two rows, one that it doesn't take has none.

    As a source's documents are taken in the order of their hash until the cut, one hash for each source and round says
    which rows are taken, and the texts stay where they are. Texts without words are never taken. Only where the cut falls
    between rows equal in id, source and text are these rows kept and counted by partition, so that the first ones of them
    are found without their meeting in a task. An empty table gives none.
    """
    h, bound, times, number, copy, limit = (free_name(docs, n) for n in ("_h", "_bound", "_times", "_number", "_copy", "_limit"))
    rows, cut = _mixed(docs, id, text, source, SEED)
    found = rows.select("source", "h", "n", *(_taken_of(k, cut).alias(f"t{k}") for k in range(MOST)))
    last = [F.max(F.when(F.col(f"t{k}") > 0, F.struct("h", "n", F.col(f"t{k}").alias("t")))).alias(f"last{k}") for k in range(MOST)]
    bounds = cut_lineage(found.groupBy("source").agg(*last).select(F.struct("source", *(f"last{k}" for k in range(MOST))).alias(bound)))
    own = docs.where(F.col(text).rlike(WORD)).withColumn(h, shuffle_key(id, text, SEED)).join(_broadcast_if_few(bounds), F.col(source).eqNullSafe(F.col(f"{bound}.source")))

    def in_rounds(condition: Callable[[Column], Column]) -> Column:
        """In how many rounds a row meets a condition on the round's last hash."""
        return sum((F.when(condition(F.col(f"{bound}.last{k}")), 1).otherwise(0) for k in range(MOST)), F.lit(0))

    at_cut = in_rounds(lambda last: (last["h"] == F.col(h)) & (last["t"] < last["n"])) > 0
    taken = own.where(~at_cut).withColumn(times, in_rounds(lambda last: F.col(h) <= last["h"]))
    if not bounds.where(" or ".join(f"{bound}.last{k}.t < {bound}.last{k}.n" for k in range(MOST))).isEmpty():
        equal = cut_lineage(own.where(at_cut)).withColumn(number, F.monotonically_increasing_id())
        wanted = [F.when(F.col(f"{bound}.last{k}.h") == F.col(h), F.col(f"{bound}.last{k}.t")).otherwise(F.when(F.col(h) < F.col(f"{bound}.last{k}.h"), F.lit(1 << 62)).otherwise(F.lit(0))) for k in range(MOST)]
        limits = _numbers_of_first(equal.select(F.col(source).alias("source"), F.col(h).alias("h"), F.col(number).alias("number"), F.array(*wanted).alias("wanted")))
        limits = _broadcast_if_few(limits.select(F.struct("source", "h", "limits").alias(limit)))
        met = equal.join(limits, F.col(source).eqNullSafe(F.col(f"{limit}.source")) & (F.col(h) == F.col(f"{limit}.h")))
        some = F.aggregate(f"{limit}.limits", F.lit(0), lambda n, last: n + F.when(F.col(number) <= last, 1).otherwise(0))
        taken = taken.unionByName(met.withColumn(times, some).select(*taken.columns))
    return taken.where(F.col(times) > 0).withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(*docs.columns)


def _numbers_of_first(places: DataFrame) -> DataFrame:
    """(source, h, limits) for rows (source, h, number, wanted): for each count in wanted the number up to which the source's
    rows of that hash are so many; all rows of a source and hash want the same.

    number is the row's partition and its place there. The rows of each partition are counted, and only those of the
    partition in which a count ends are put in order.
    """
    places = places.withColumn("part", F.shiftright("number", 33)).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("wanted")))).withColumn("want", F.col("wanted")[F.col("k") - 1])
    key = ["source", "h", "k"]
    held = places.groupBy(*key, "part").agg(F.count("*").alias("n"), F.first("want").alias("want"), F.max("number").alias("last"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    held = cut_lineage(held.withColumn("need", F.col("want") - before))
    whole = held.where("need >= n").groupBy(*key).agg(F.max("last").alias("limit"))
    partly = held.where("need > 0 and need < n").select(*(F.col(c).alias(f"_{c}") for c in (*key, "part")), "need")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("h") == F.col("_h")) & (F.col("k") == F.col("_k")) & (F.col("part") == F.col("_part"))
    there = places.join(partly, same).withColumn("at", F.row_number().over(W.partitionBy(*key).orderBy("number")))
    ends = whole.unionByName(there.where("at = need").select(*key, F.col("number").alias("limit")))
    none = held.select(*key).distinct().withColumn("limit", F.lit(-1).cast("long"))
    ends = ends.unionByName(none).groupBy(*key).agg(F.max("limit").alias("limit"))
    return cut_lineage(ends.groupBy("source", "h").agg(F.array_sort(F.collect_list(F.struct("k", "limit"))).alias("limits")).withColumn("limits", F.transform("limits", lambda x: x["limit"])))


def _taken_of(k: int, cut: float) -> Column:
    """How many of a row's n equal documents are taken in round k: those that finish by the cut, which are the first ones."""
    guess = F.floor((F.lit(cut) * F.col("target") - k * F.col("source_size") - F.col("before")) / F.col("size"))
    near = F.greatest(F.lit(0), F.least(F.col("n"), guess.cast("long")))
    more, less = F.least(F.col("n"), near + 1), F.greatest(F.lit(0), near - 1)
    first = F.when(_finish(k, more) <= F.lit(cut), more).when((near > 0) & (_finish(k, near) <= F.lit(cut)), near).when((less > 0) & (_finish(k, less) <= F.lit(cut)), less).otherwise(F.lit(0))
    return F.when(F.col("size") > 0, first).otherwise(F.lit(0)).cast("long")
