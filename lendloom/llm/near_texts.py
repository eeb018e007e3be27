"""Near copies by SimHash: texts whose sets of word shingles have at least a given Jaccard similarity.

The fingerprints are longer than those that differ in two bits only: several rings of 64 bits, each of 8 segments. As at a
similarity of 0.8 a bit differs with probability 0.15, no segment is sure to agree; the number of rings follows from the
chance that some chain keeps its budgets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import comparable, cut_lineage, free_name, text_bytes, values_of
from lendloom.llm.components import connected_components, least_of, unite
from lendloom.llm.simhash import TO_LOWER

#: Bits of a segment, and segments of a ring.
WIDTH, SEGMENTS = 8, 8
RING = WIDTH * SEGMENTS
#: Rows of a bucket, or of a block of a larger one, that are compared in one go.
BUCKET = 1024
#: Shingles whose bits are counted in one go, and rows of one call of the comparison.
STEP, ROWS = 1 << 16, 100_000
#: One in so many buckets links its rows first, and the others then only rows that this gave different labels.
FIRST = 16


def shingles(text: bytes, words: int = 5) -> np.ndarray:
    """XXH64 of a text's distinct word shingles, sorted. A text of fewer words is one shingle, also if it has none."""
    own = text.translate(TO_LOWER).split()
    joined = b" ".join(own)
    if len(own) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(own) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, ends, strict=True)), np.uint64, len(starts)))


def differing(similarity: float) -> float:
    """Probability that a fingerprint bit differs for sets of this Jaccard similarity: their angle over pi, at equal sizes."""
    return math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi


def ring_budget(similarity: float) -> int:
    """Bits in which two rings may differ: the expected number and a standard deviation."""
    p = differing(similarity)
    return math.floor(RING * p + math.sqrt(RING * p * (1 - p)))


def full_budget(similarity: float, rings: int) -> float:
    """Bits in which whole fingerprints may differ: four standard deviations above the expected number."""
    p, n = differing(similarity), RING * rings
    return n * p + 4 * math.sqrt(n * p * (1 - p))


def chain_budgets(budget: int, equal: int) -> list[tuple[int, int]]:
    """(segments, bits that the first so many segments of a chain may differ in) after the first `equal`, which agree."""
    return [(n, n * budget // SEGMENTS) for n in range(equal + 1, SEGMENTS + 1)]


def rings_needed(similarity: float, recall: float, equal: int) -> int:
    """Rings until a pair of this similarity has a chain within its budgets in one of them with this probability.

    The chance in one ring is that among 100,000 drawn rings (with a fixed seed).
    """
    drawn = np.random.default_rng(1).binomial(WIDTH, differing(similarity), (100_000, SEGMENTS))
    found = np.zeros(len(drawn), bool)
    for start in range(SEGMENTS):
        sums = np.cumsum(np.roll(drawn, -start, axis=1), axis=1)
        own = sums[:, equal - 1] == 0
        for n, most in chain_budgets(ring_budget(similarity), equal):
            own &= sums[:, n - 1] <= most
        found |= own
    return 1 if found.all() else max(1, math.ceil(math.log(1 - recall) / math.log(1 - found.mean())))


def equal_segments(classes: int) -> int:
    """Segments at the start of a chain that must agree: so many that a bucket holds 1,024 of the classes or fewer."""
    return min(SEGMENTS - 1, max(2, math.ceil((math.log2(max(1, classes)) - 10) / WIDTH)))


def ring_fingerprints(hashes: np.ndarray, rings: int) -> np.ndarray:
    """SimHash of a set of 64-bit hashes, in `rings` words of 64 bits: a bit is set if over half of the hashes have it.

    Each ring takes its own bits from a hash by mixing it with the ring's number. Bits are counted by adding three words
    at a time into a sum and a carry word, which stands for twice as much.
    """
    total = np.zeros(RING * rings, np.int64)
    salts = np.arange(1, rings + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(hashes), STEP):
        x = hashes[i : i + STEP, None] + salts
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        weight = 1
        while len(x):
            carries = []
            while len(x) > 24:
                m = len(x) // 3
                a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
                carries.append((a & b) | ((a ^ b) & c))
                x = np.concatenate([a ^ b ^ c, x[3 * m :]])
            total += weight * np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            x = np.concatenate(carries) if carries else x[:0]
            weight *= 2
    return np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")


def _with_rings(docs: DataFrame, text: str, name: str, words: int, rings: int) -> DataFrame:
    """docs with an array of the number of shingles of the whole text and the rings of its fingerprint."""

    @F.arrow_udf("array<long>")
    def fingerprints(column: pa.Array) -> pa.Array:
        flat = np.empty((len(column), rings + 1), np.int64)
        for i, t in enumerate(values_of(column)):
            own = shingles(t, words)
            flat[i, 0] = len(own)
            flat[i, 1:] = ring_fingerprints(own, rings).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, rings + 1), pa.int32()), pa.array(flat.ravel()))

    return docs.withColumn(name, fingerprints(text_bytes(text)))


CHAINS = "gid long, cid long, fp long"


def _chains(classes: DataFrame, rings: int, equal: int) -> DataFrame:
    """(gid, cid, fp) for each ring and start: gid is the first `equal` segments of the chain, fp the ring turned to its start."""
    schema = pa.schema([("gid", pa.int64()), ("cid", pa.int64()), ("fp", pa.int64())])

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cid = batch.column(0)
            own = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, rings + 1)[:, 1:].view(np.uint64)
            for ring in range(rings):
                for start in range(SEGMENTS):
                    at = np.uint64(WIDTH * start)
                    fp = own[:, ring] >> at | (own[:, ring] << (np.uint64(RING) - at) if start else np.uint64(0))
                    gid = fp & np.uint64((1 << WIDTH * equal) - 1)
                    if WIDTH * equal < 48:
                        gid |= np.uint64((ring * SEGMENTS + start) << WIDTH * equal)
                    yield pa.RecordBatch.from_arrays([pa.array(gid.view(np.int64)), cid, pa.array(fp.view(np.int64))], schema=schema)

    return classes.select("cid", "rings").mapInArrow(chains, CHAINS)


def _whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows sorted by gid, in which no gid goes on in the next table."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < ROWS:
            continue
        table = pa.Table.from_batches(held)
        gid = table.column("gid").to_numpy()
        cut = int(np.searchsorted(gid, gid[-1]))
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).combine_chunks().to_batches(), table.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def _within_budgets(gid: np.ndarray, fp: np.ndarray, budgets: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j), i < j, of rows of one gid whose chains keep the budgets. Rows are sorted by gid."""
    bits, first, apart = fp.view(np.uint64), np.arange(len(gid)), 1
    masks = [(np.uint64((1 << WIDTH * n) - 1), most) for n, most in budgets]
    while True:
        first = first[first + apart < len(gid)]
        first = first[gid[first] == gid[first + apart]]
        if not len(first):
            return
        near, x = first, bits[first] ^ bits[first + apart]
        for mask, most in masks:
            ok = np.bitwise_count(x & mask) <= most
            near, x = near[ok], x[ok]
        if len(near):
            yield near, near + apart
        apart += 1


def _near_rows(chains: DataFrame, budgets: list[tuple[int, int]]) -> DataFrame:
    """(gid, cid, near) of the rows that have near rows in their bucket, and how many."""
    schema = pa.schema([("gid", pa.int64()), ("cid", pa.int64()), ("near", pa.int64())])

    def near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches):
            gid, cid, fp = (table.column(c).to_numpy() for c in ("gid", "cid", "fp"))
            near = np.zeros(len(gid), np.int64)
            for i, j in _within_budgets(gid, fp, budgets):
                near += np.bincount(i, minlength=len(gid)) + np.bincount(j, minlength=len(gid))
            own = near > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[own]) for x in (gid, cid, near)], schema=schema)

    return chains.repartition("gid").sortWithinPartitions("gid").mapInArrow(near_rows, "gid long, cid long, near long")


def _label_links(root: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """Links (a, b), each once, of every label in a set with the least label in it; a label stands for rows known to be linked."""
    of, least = least_of(root, np.arange(len(root))), label.copy()
    np.minimum.at(least, of, label)
    pairs = np.stack([label, least[of]], axis=1)
    a, b = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _full_links(rows: DataFrame, most: float) -> DataFrame:
    """Links (a, b) between labels that connect the rows (gid, label, rings) of a bucket whose whole fingerprints are near."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches):
            gid = table.column("gid").to_numpy()
            rings = table.column("rings").combine_chunks().flatten().to_numpy().reshape(len(gid), -1)[:, 1:].view(np.uint64)
            root, first, apart = np.arange(len(gid)), np.arange(len(gid)), 1
            while True:
                first = first[first + apart < len(gid)]
                first = first[gid[first] == gid[first + apart]]
                if not len(first):
                    break
                near = first[np.bitwise_count(rings[first] ^ rings[first + apart]).sum(axis=1, dtype=np.int64) <= most]
                unite(root, near, near + apart)
                apart += 1
            yield _label_links(root, table.column("label").to_numpy())

    return rows.select("gid", "label", "rings").repartition("gid").sortWithinPartitions("gid").mapInArrow(links, "a long, b long")


def _in_blocks(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of groups of any size, dealt into groups of at most about two BUCKETs, a new gid each.

    Two blocks of a group share a new one, unless all rows of both are `main`, as these needn't be compared.
    """
    sizes = rows.groupBy(*by).agg(F.ceil(F.count_if("main") / BUCKET).alias("mains"), F.ceil(F.count_if(~F.col("main")) / BUCKET).alias("others"))
    own = F.when(F.col("main"), F.col("others") + F.pmod(F.xxhash64("cid"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("cid"), F.col("others")))
    last = F.when(F.col("main"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = rows.join(sizes, list(by)).where("others > 0").withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return dealt.withColumn("gid", F.xxhash64(*by, F.least("own", "with"), F.greatest("own", "with"))).drop("own", "with", "mains", "others", "main")


def _bits_apart(x: Column, y: Column) -> Column:
    """Differing bits of two fingerprints, each the number of shingles and then the rings."""
    pairs = F.arrays_zip(F.slice(x, 2, 1 << 20).alias("x"), F.slice(y, 2, 1 << 20).alias("y"))
    return F.aggregate(pairs, F.lit(0), lambda n, p: n + F.bit_count(p["x"].bitwiseXOR(p["y"])))


def candidate_groups(classes: DataFrame, rings: int, equal: int, similarity: float) -> DataFrame:
    """(cid, grp, near) of the classes (cid, rings) that are near others: grp is what is reachable over near fingerprints.

    Pigeonring filtering: classes meet in a bucket where the first `equal` segments of a chain agree. The differences of
    longer and longer chains must stay within their share of the ring's budget, then those of whole fingerprints within
    theirs. Of a bucket only links that connect its near rows go on. A bucket of over BUCKET rows is compared with one of
    them first; those that aren't linked to that one are compared with all, block by block.

    A row of a large group of near copies is in some bucket with others of it for most rings and starts. One in FIRST
    buckets, and the rows around the centres of large ones, are therefore linked first, and a row takes the least row it is
    linked to as its label; the other buckets, all of whose rows are compared as well, send links between different labels only.
    """
    budgets, most = chain_budgets(ring_budget(similarity), equal), full_budget(similarity, rings)
    chains, of = _chains(classes, rings, equal), classes.select("cid", "rings")
    large = cut_lineage(chains.groupBy("gid").agg(F.count("*").alias("m")).where(F.col("m") > BUCKET).select("gid"))
    any_large = not large.isEmpty()
    near = cut_lineage(_near_rows(chains.join(large, "gid", "left_anti") if any_large else chains, budgets))
    early = F.pmod(F.xxhash64("gid"), F.lit(FIRST)) == 0
    links = _full_links(near.where(early).join(of.withColumn("label", F.col("cid")), "cid"), most)
    weights = near.select("cid", "near")
    if any_large:
        hot = chains.join(large, "gid").select("gid", "cid").join(of, "cid")
        centre = hot.groupBy("gid").agg(F.min_by(F.struct("cid", "rings"), F.xxhash64("cid")).alias("x"))
        is_near = _bits_apart(F.col("rings"), F.col("x.rings")) <= F.lit(most)
        hot = cut_lineage(hot.join(centre, "gid").select("gid", "cid", "rings", F.col("x.cid").alias("centre"), is_near.alias("main")))
        starred = hot.where("main").select(F.col("cid").alias("a"), F.col("centre").alias("b"))
        links = links.unionByName(starred.where("a <> b"))
        weights = weights.unionByName(starred.select(F.col("a").alias("cid"), F.lit(1).cast("long").alias("near")))
    first = cut_lineage(links.distinct())
    least = first.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("b"))
    of = of.join(least, "cid", "left").select("cid", "rings", F.coalesce("b", "cid").alias("label"))
    links = first.unionByName(_full_links(near.where(~early).join(of, "cid"), most))
    if any_large:
        hot = hot.drop("rings").join(of, "cid")
        hot = hot.join(hot.where("cid = centre").select("gid", F.col("label").alias("central")), "gid")
        hot = cut_lineage(hot.withColumn("main", F.expr("main or label = centre or label = central")).drop("centre", "central"))
        links = links.unionByName(_full_links(_in_blocks(hot, "gid"), most))
    groups = cut_lineage(connected_components(links.distinct()).select(F.col("node").alias("cid"), F.col("component").alias("grp")))
    near_rows = weights.groupBy("cid").agg(F.sum("near").alias("near"))
    return groups.join(near_rows, "cid", "left").select("cid", "grp", F.coalesce("near", F.lit(0).cast("long")).alias("near"))


def similar_rows(sets: list[np.ndarray], similarity: float, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j), i < j, of sets (sorted arrays) with at least this Jaccard similarity, from exact counts."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        shared = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2)
    else:
        of_row = np.repeat(np.arange(len(sets)), sizes)
        _, what, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        column = np.cumsum(count > 1) - 1
        of_row, what = of_row[count[what] > 1], column[what[count[what] > 1]]
        order = np.argsort(what, kind="stable")
        of_row, what = of_row[order], what[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for first in range(0, int(what[-1]) + 1 if len(what) else 0, columns):
            part = slice(*np.searchsorted(what, [first, first + columns]))
            held = np.zeros((len(sets), columns), np.float32)
            held[of_row[part], what[part] - first] = 1
            shared += held @ held.T
    i, j = np.triu_indices(len(sets), 1)
    both = shared[i, j].astype(np.float64)
    near = both >= similarity * (sizes[i] + sizes[j] - both) - 1e-9
    return i[near], j[near]


def _exact_links(similarity: float):
    """Links (a, b) between labels that connect the similar rows (grp, label, s) of each grp."""

    def links(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("grp").combine_chunks()
        label, grp, sets = rows.column("label").to_numpy(), rows.column("grp").to_numpy(), rows.column("s").combine_chunks()
        flat, at = sets.values.to_numpy().view(np.uint64), sets.offsets.to_numpy()
        root, begins = np.arange(len(grp)), np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
        for begin, end in zip(begins, np.r_[begins[1:], len(grp)], strict=True):
            if end - begin > 1:
                i, j = similar_rows([flat[at[k] : at[k + 1]] for k in range(begin, end)], similarity)
                unite(root, i + begin, j + begin)
        return pa.Table.from_batches([_label_links(root, label)])

    return links


def _with_shingles(texts: DataFrame, words: int) -> DataFrame:
    @F.arrow_udf("array<long>")
    def sets(column: pa.Array) -> pa.Array:
        return pa.array([shingles(t, words).view(np.int64) for t in values_of(column)], pa.list_(pa.int64()))

    return texts.select("cid", sets("text").alias("s"))


def near_components(classes: DataFrame, texts: DataFrame, similarity: float, words: int, rings: int, equal: int) -> DataFrame:
    """(cid, component) of the classes (cid, class, rings) that are linked: what is reachable over pairs at least so similar.

    Within a group of near fingerprints the shingle sets of all pairs are compared, in one task where the group is small. Of
    a larger group those that are similar to one central text are linked to it, and only the others are compared with all,
    block by block; in a group that no text is close to as a whole this work grows with its square.
    """
    groups = cut_lineage(candidate_groups(classes, rings, equal, similarity))
    sizes = groups.groupBy("grp").agg(F.count("*").alias("g"), F.max_by("cid", F.struct("near", -F.col("cid"))).alias("centre"))
    needed = classes.join(groups.select("cid"), "cid", "left_semi").select("cid", "class")
    sets = _with_shingles(texts.join(needed, "class").groupBy("cid").agg(F.first("text").alias("text")), words)
    members = cut_lineage(sets.join(groups.select("cid", "grp"), "cid").join(sizes, "grp"))
    tasks = max(1, groups.count() // 256)
    small = members.where(F.col("g") <= BUCKET).withColumn("gid", F.pmod(F.xxhash64("grp"), F.lit(tasks)))
    links = small.select("gid", "grp", F.col("cid").alias("label"), "s").groupBy("gid").applyInArrow(_exact_links(similarity), "a long, b long")
    large = members.where(F.col("g") > BUCKET)
    if not large.isEmpty():
        central = large.where("cid = centre").select("grp", F.col("s").alias("sc"))
        both = F.size(F.array_intersect("s", "sc"))
        large = large.join(central, "grp").withColumn("main", both >= similarity * (F.size("s") + F.size("sc") - both) - 1e-9)
        large = cut_lineage(large.select("grp", "cid", "centre", "s", "main", F.when(F.col("main"), F.col("centre")).otherwise(F.col("cid")).alias("label")))
        starred = large.where("main and cid <> centre").select(F.col("cid").alias("a"), F.col("centre").alias("b"))
        rest = _in_blocks(large.drop("centre"), "grp").drop("cid").groupBy("gid").applyInArrow(_exact_links(similarity), "a long, b long")
        links = links.unionByName(starred).unionByName(rest)
    return connected_components(links).withColumnRenamed("node", "cid")


def drop_near_texts(docs: DataFrame, similarity: float = 0.8, words: int = 5, recall: float = 0.99, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each group of near copies, all columns kept: the row of least id, then of least text hash.

    Texts are linked if the Jaccard similarity of their sets of word shingles (in lower case, by single spaces) is at least
    `similarity`, and a group is all that links reach. Candidates are found by the SimHash of the same shingles; every link
    is checked on the whole sets, so none is false. `recall` is the chance that a pair exactly at the similarity becomes a
    candidate, and rises fast above it; the fingerprint's length follows from it and from the number of rows.

    Rows stand for themselves, so null and repeated ids are grouped by their texts like others; a null id comes last. Of
    rows equal in all columns one stays; columns of maps and VARIANT count by their JSON text. Null, empty and blank texts have the same single shingle and are one group; a long
    text is taken whole. An empty table gives none. Texts are shuffled twice: those that have a candidate, and all to meet
    the rows that stay.
    """
    key, row = free_name(docs, "_class"), free_name(docs, "_row")
    bare = [comparable(docs, c) for c in docs.columns if c != text]
    marked = docs.withColumns({key: F.md5(text_bytes(text)), row: F.xxhash64(*bare, *(c.isNull() for c in bare))})
    rows = marked.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(key).alias("class"), F.col(row).alias("row"))
    equal = equal_segments(docs.select(F.lit(1)).count())
    rings = rings_needed(similarity, recall, equal)
    keyed = cut_lineage(_with_rings(rows, "text", "rings", words, rings).drop("text"))
    best = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "class", "row")).alias("best")
    classes = cut_lineage(keyed.groupBy("class").agg(F.first("rings").alias("rings"), best).withColumn("cid", F.monotonically_increasing_id()))
    reached = near_components(classes, rows.select("class", text_bytes("text").alias("text")), similarity, words, rings, equal)
    grouped = classes.select("cid", "best").join(reached, "cid", "left").groupBy(F.coalesce("component", "cid").alias("c"))
    stay = cut_lineage(grouped.agg(F.min("best").alias("best")).select(F.col("best.class").alias(key), F.col("best.row").alias(row)))
    kept = marked.join(stay, [key, row], "left_semi")
    repeats = keyed.select(F.col("class").alias(key), F.col("row").alias(row)).join(stay, [key, row], "left_semi")
    if not repeats.groupBy(key, row).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([key, row])
    return kept.select(*docs.columns)


__all__ = ["drop_near_texts", "near_components", "ring_fingerprints", "rings_needed", "shingles"]
