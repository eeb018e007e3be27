"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import cut_lineage
from lendloom.llm.components import connected_components, least_of, unite

#: Rows that are compared with a window before them in one go, and of the blocks in which groups are counted.
BLOCK = 1024
#: Passes of one job, and rows that one of its tasks sorts.
PASSES, SORTED = 4, 1 << 16
#: Vectors drawn as probes and for the thresholds of the hashes; so few that the driver holds them.
PROBES = 1024
HASHES = 63


def unit_rows(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors in double precision) for each dimension that occurs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        own = column.take(pa.array(at)) if len(at) < len(column) else column
        x = own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), int(dim))
        x /= np.abs(x).max(axis=1, keepdims=True)
        yield at, x / np.linalg.norm(x, axis=1, keepdims=True)


class Hashes:
    """Random hashes of a pass: the side of a random plane through a drawn vector.

    As the planes go through vectors of the data, a narrow region that holds a share of them is cut by such a share of the
    planes, while planes through the origin would miss it.
    """

    def __init__(self, drawn: dict[int, np.ndarray], seed: int):
        self.drawn, self.seed = drawn, seed

    def keys(self, x: np.ndarray, k: int) -> np.ndarray:
        """The concatenated hashes of each row of x in pass k, the first one highest."""
        dim = x.shape[1]
        rng = np.random.default_rng([self.seed, dim, k])
        planes, through = rng.standard_normal((dim, HASHES)), self.drawn.get(dim)
        at = 0.0 if through is None else (through[rng.integers(0, len(through), HASHES)] * planes.T).sum(axis=1)
        return (x @ planes > at) @ (np.int64(1) << np.arange(HASHES - 1, -1, -1))


def in_bytes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in a byte a component, and the greatest angle by which each is off its vector."""
    scale = 127 / np.abs(x).max(axis=1, keepdims=True)
    q = np.rint(x * scale)
    cosine = (q * x).sum(axis=1) / np.linalg.norm(q, axis=1)
    return q.astype(np.int8), np.arccos(np.clip(cosine, -1, 1)) + 1e-5


#: Columns of a pass's rows; the tasks below count on their order.
PASS_ROWS = "pass int, dim int, key long, cid long, q binary, off double"


def _pass_rows(classes: DataFrame, hashes: Hashes, passes: range) -> DataFrame:
    """(pass, dim, key, cid, q, off) of each vector and pass: q and off are the vector in bytes and the angle it is off."""
    schema = pa.schema([("pass", pa.int32()), ("dim", pa.int32()), ("key", pa.int64()), ("cid", pa.int64()), ("q", pa.binary()), ("off", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in unit_rows(batch.column(1)):
                q, off = in_bytes(x)
                q, dim = pa.array([v.tobytes() for v in q], pa.binary()), pa.array(np.full(len(at), x.shape[1], np.int32))
                for k in passes:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), dim, pa.array(hashes.keys(x, k)), pa.array(ids[at]), q, pa.array(off)], schema=schema)

    return classes.select("cid", "v").mapInArrow(rows, PASS_ROWS)


def _window_links(rows: DataFrame, threshold: float, window: int) -> DataFrame:
    """Links (a, b) that connect near vectors of the sorted rows: each is compared with the next `window` of its pass.

    Near means that the cosine may reach the threshold, as far as the bytes tell. Probes (negative cid) link with the first
    near vector that isn't one, and only so; of other vectors only links that connect them go on.
    """
    angle, schema = math.acos(threshold), pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def of_block(cid: np.ndarray, x: np.ndarray, off: np.ndarray, again: int) -> pa.RecordBatch:
        """Links of sorted rows of one pass; the first `again` of them have been compared with one another before."""
        cosine = x @ x.T
        a, b = np.nonzero(cosine >= math.cos(min(math.pi, angle + 2 * off.max())))
        ahead = (b > a) & (b - a <= window) & (b >= again)
        a, b = a[ahead], b[ahead]
        near = cosine[a, b] >= np.cos(np.minimum(np.pi, angle + off[a] + off[b]))
        a, b = a[near], b[near]
        probe, root = (cid[a] < 0) | (cid[b] < 0), np.arange(len(cid))
        unite(root, a[~probe], b[~probe])
        moved = np.flatnonzero(root != np.arange(len(root)))
        met = np.unique(np.minimum(cid[a], cid[b])[probe & (np.maximum(cid[a], cid[b]) >= 0)])
        return pa.RecordBatch.from_arrays([pa.array(np.r_[cid[moved], met]), pa.array(np.r_[cid[least_of(root, moved)], met])], schema=schema)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = None, None
        for batch in batches:
            of = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            cid, q, off = batch.column(3).to_numpy(), batch.column(4), batch.column(5).to_numpy()
            begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for begin, end in zip(begins, np.r_[begins[1:], len(of)], strict=True):
                dim = int(of[begin] & 0xFFFFFFFF)
                if of[begin] != run:
                    run, held = of[begin], (cid[:0], np.empty((0, dim), np.float32), off[:0])
                for i in range(begin, end, BLOCK):
                    part = slice(i, min(i + BLOCK, end))
                    x = np.frombuffer(b"".join(q[part].to_pylist()), np.int8).reshape(-1, dim).astype(np.float32)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    rows = tuple(np.concatenate(c) for c in zip(held, (cid[part], x, off[part]), strict=True))
                    yield of_block(*rows, len(held[0]))
                    held = tuple(c[-window:] for c in rows)

    return rows.mapInArrow(links, "a long, b long")


def _count_links(threshold: float):
    """(cid, linked, least) of the rows of groups, or of two blocks of a large one: how many vectors each is linked with,
    and the least row that it reaches here."""

    def count(group: pa.Table) -> pa.Table:
        ids, n = group.column("cid").to_numpy(), group.column("n").to_numpy()
        component, block = group.column("grp").to_numpy(), group.column("block").to_numpy()
        linked, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at, x in unit_rows(group.column("v")):
            order = np.argsort(component[at], kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(component[at][order])) + 1):
                rows = at[own]
                sides = np.unique(block[rows])
                for i in range(0, len(own), BLOCK):
                    link = (x[own[i : i + BLOCK]] @ x[own].T >= threshold) & (block[rows[i : i + BLOCK], None] != block[None, rows] if len(sides) > 1 else own[i : i + BLOCK, None] != own[None, :])
                    linked[rows[i : i + BLOCK]] += link @ n[rows]
                    a, b = np.nonzero(link)
                    unite(root, rows[a + i], rows[b])
        return pa.table({"cid": pa.array(ids), "linked": pa.array(linked), "least": pa.array(ids[least_of(root, np.arange(len(ids)))])})

    return count


def _probes(classes: DataFrame, threshold: float, seed: int) -> tuple[dict[int, np.ndarray], DataFrame, int]:
    """Up to PROBES vectors by dimension, a frame (cid, v) of a made partner for each, exactly at the threshold, and their number."""
    rows = classes.orderBy(F.xxhash64("v"), "cid").select("v").limit(PROBES).toArrow()
    drawn, made, rng = {}, [], np.random.default_rng(seed)
    for _, x in unit_rows(rows.column("v")):
        drawn[x.shape[1]] = x
        if x.shape[1] > 1:
            away = rng.standard_normal(x.shape)
            away -= (away * x).sum(axis=1, keepdims=True) * x
            made += (threshold * x + math.sqrt(1 - threshold**2) * away / np.linalg.norm(away, axis=1, keepdims=True)).tolist()
    frame = classes.sparkSession.createDataFrame([(-1 - i, v) for i, v in enumerate(made)], "cid long, v array<double>")
    return drawn, frame, len(made)


def near_groups(classes: DataFrame, threshold: float, window: int, recall: float, seed: int) -> DataFrame:
    """Links (a, b) of the classes (cid, v): what they connect holds all vectors that may be near, as far as passes found.

    Passes are made until the share `recall` of the probes has met a near vector. A probe is a made vector at exactly the
    threshold from a drawn one, so the number of passes follows from how densely the vectors lie where they are.
    """
    n = classes.count()
    drawn, made, n_probes = _probes(classes, threshold, seed)
    hashes, double = Hashes(drawn, seed), F.col("v").cast("array<double>")
    vectors = classes.select("cid", double.alias("v")).unionByName(made)
    parts = max(1, math.ceil(PASSES * n / SORTED))
    first, step, links, met = 0, PASSES if n > window else 1, [], set()
    while True:
        order = ["pass", "dim", "key", "cid"]
        rows = _pass_rows(vectors, hashes, range(first, first + step)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        found = cut_lineage(_window_links(rows, threshold, window).distinct())
        met |= {r.a for r in found.where("a < 0").select("a").collect()}  # at most PROBES
        links.append(found.where("a >= 0"))
        first += step
        if len(met) >= recall * n_probes or n <= 1:
            break
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.95, window: int = 256, recall: float = 0.99, seed: int = 7) -> DataFrame:
    """(id, n_links, component_id, kept) of each row: how many others are linked, and the least id reachable over links.

    Equal vectors are one class, whatever their number. Each pass orders the classes by the concatenated random hashes and
    compares each with the next `window` in order, in a byte a component; what passes find near is united into groups. Within
    a group every pair is then compared in double precision, so that no link is below the threshold and all links between
    vectors of one group are counted. Passes are made, a few a job, until the share `recall` of up to PROBES made pairs
    exactly at the threshold has been found, so their number grows with the number and the density of the vectors. A pass
    moves a byte a component, and only the links stay.

    A vector that is null, empty, all zeros or holds a null or non-finite component links with nothing. Vectors of different
    lengths don't link. Repeated rows count as links of each other. Null ids are rows of their own; a null is never a
    component's least unless all are null. Other columns are not carried; an empty table gives none. Counting within a group
    of g different vectors takes g * g / 2 comparisons, dealt out in pairs of blocks.
    """
    usable = "v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)"
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")).withColumn("ok", F.coalesce(F.expr(usable), F.lit(False)))
    good = rows.where("ok").select("id", "v")
    classes = cut_lineage(good.groupBy("v").agg(F.min("id").alias("least_id"), F.count("*").alias("n")).withColumn("cid", F.monotonically_increasing_id()))
    groups = connected_components(near_groups(classes, threshold, window, recall, seed))
    reached = cut_lineage(groups.select(F.col("node").alias("cid"), F.col("component").alias("grp")))

    sizes = reached.groupBy("grp").agg(F.count("*").alias("g"))
    linked_rows = reached.count()
    members = reached.join(sizes, "grp").join(classes, "cid").withColumn("blocks", F.ceil(F.col("g") / BLOCK))
    members = members.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    large = members.where("blocks > 1").withColumn("other", partner).select("cid", "grp", "v", "n", "block", F.col("grp").alias("k"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    small = members.where("blocks = 1").select("cid", "grp", "v", "n", "block", F.pmod(F.xxhash64("grp"), F.lit(max(1, linked_rows // 256))).alias("k"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"))
    counts = cut_lineage(large.unionByName(small).groupBy("k", "i", "j").applyInArrow(_count_links(threshold), "cid long, linked long, least long"))
    exact = connected_components(counts.where("cid <> least").select("cid", "least"))
    exact = cut_lineage(exact.select(F.col("node").alias("cid"), "component"))
    least = exact.join(classes.select("cid", "least_id"), "cid").groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = counts.groupBy("cid").agg(F.sum("linked").alias("linked"))
    found = linked.join(exact.join(least, "component"), "cid").select("cid", "linked", "component_id")
    of_class = classes.join(found, "cid", "left").select("v", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"))
    of_class = cut_lineage(of_class)  # so that the join below is one that Spark can split where a vector has many copies

    good = good.join(of_class, "v").select("id", "n_links", "component_id")
    alone = rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = good.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    return out.withColumnRenamed("id", id)


__all__ = ["near_groups", "near_vectors"]
