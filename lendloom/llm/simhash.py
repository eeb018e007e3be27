"""SimHash fingerprints and the groups of documents whose fingerprints differ in few bits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import cut_lineage, text_bytes, values_of
from lendloom.llm.components import connected_components

TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Widths of the ring's segments. With 5 segments and 2 differing bits a chain's budgets are 0, 0, 1, 1, 2 bits.
WIDTHS = (13, 13, 13, 13, 12)
BITS = 2
#: A bucket with more distinct fingerprints is split by further segments before any of it is compared.
BUCKET = 2048


def fingerprint(text: bytes, words: int = 3, step: int = 1 << 16) -> int:
    """64-bit SimHash of a text's word shingles, in which each bit is set if over half the shingles' XXH64 have it set."""
    own = text.translate(TO_LOWER).split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) < words:
        return xxhash.xxh64_intdigest(joined, 42)
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: len(own) - words + 1].tolist(), ends[words - 1 :].tolist()
    digest, n, set_bits = xxhash.xxh64_intdigest, len(starts), np.zeros(64, np.int64)
    for i in range(0, n, step):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[i : i + step], ends[i : i + step], strict=True)], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", words: int = 3) -> DataFrame:
    """docs with the fingerprint of the whole text as a signed long; a null or empty text has 0."""

    @F.arrow_udf("long")
    def simhash(column: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint(t, words) for t in values_of(column)), np.uint64, len(column)).view(np.int64))

    return docs.withColumn(name, simhash(text_bytes(text)))


def _segments() -> list[tuple[int, int]]:
    """(shift, mask) of each segment."""
    shifts = [sum(WIDTHS[:i]) for i in range(len(WIDTHS))]
    return [(s, (1 << w) - 1) for s, w in zip(shifts, WIDTHS, strict=True)]


def _segment(i: int) -> Column:
    shift, mask = _segments()[i % len(WIDTHS)]
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(mask))


def _chain_masks(start: int) -> list[tuple[int, int]]:
    """(bits of the first segments of the chain from `start`, how many of them may differ), from the 3rd prefix to all."""
    out, mask = [], 0
    for length in range(1, len(WIDTHS) + 1):
        shift, own = _segments()[(start + length - 1) % len(WIDTHS)]
        mask |= own << shift
        if length >= 3:
            out.append((mask, length * BITS // len(WIDTHS)))
    return out


def links_in_bucket(fps: np.ndarray, start: int, block: int = 512) -> list[tuple[int, int]]:
    """Links (fingerprint, least of its component within the bucket), after the chain's tests and the full Hamming test.

    Only a spanning star of each component is returned, not its pairs.
    """
    fps = np.unique(fps)
    root, bits = np.arange(len(fps)), fps.view(np.uint64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    masks = [(np.uint64(m), most) for m, most in _chain_masks(start)]
    for i in range(0, len(fps), block):
        for j in range(i, len(fps), block):
            differ = bits[i : i + block, None] ^ bits[None, j : j + block]
            near = np.ones(differ.shape, bool)
            for mask, most in masks:
                near &= np.bitwise_count(differ & mask) <= most
                if not near.any():
                    break
            for a, b in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                ra, rb = find(a + i), find(b + j)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
    return [(int(fps[x]), int(fps[find(x)])) for x in range(len(fps)) if find(x) != x]


def _star_links(buckets: DataFrame) -> DataFrame:
    """Links of buckets (start, key, sub, fp) that are all small enough to be gathered."""

    @F.arrow_udf("array<struct<a: long, b: long>>")
    def star(start: pa.Array, fps: pa.Array) -> pa.Array:
        out = ([{"a": a, "b": b} for a, b in links_in_bucket(np.array(f, np.int64), s)] for s, f in zip(values_of(start), values_of(fps), strict=True))
        return pa.array(out, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    full = buckets.groupBy("start", "key", "sub").agg(F.collect_set("fp").alias("fps"))
    return full.select(F.inline(star("start", "fps")))


def near_fingerprints(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within 2 bits of each other.

    Pigeonring filtering: of 5 segments on a ring, two fingerprints within 2 bits have a start from which each chain of l
    segments differs in at most 2 l / 5 bits, so the first two agree. Fingerprints are joined on each two neighbouring
    segments, and a pair must keep the chain's budgets before its full distance is taken. A bucket with too many
    fingerprints is split: as the 3rd and 4th segment together differ in one bit at most, one of the two agrees too; and
    if that is still too large, the other one is matched with a bit flipped.
    """
    n = len(WIDTHS)
    keys = F.array(*(F.struct(F.lit(i).alias("start"), F.shiftleft(_segment(i).cast("long"), 13).bitwiseOR(_segment(i + 1)).alias("key")) for i in range(n)))
    rows = fps.select("fp", F.inline(keys)).withColumn("sub", F.lit(0).cast("long"))

    def of_start(which: int) -> Column:
        return F.element_at(F.array(*(_segment(i + which) for i in range(n))), F.col("start") + 1).cast("long")

    def sized(rows: DataFrame) -> DataFrame:
        held = rows.groupBy("start", "key", "sub").agg(F.count("*").alias("n")).where("n > 1")
        return rows.join(held, ["start", "key", "sub"])

    links = []
    for level in range(3):
        rows = cut_lineage(sized(rows))
        small, large = rows.where(F.col("n") <= bucket).drop("n"), rows.where(F.col("n") > bucket).drop("n")
        if level == 2:
            links.append(_star_links(rows.drop("n")))
            break
        links.append(_star_links(small))
        if large.isEmpty():
            break
        if level == 0:
            subs = F.array(*(of_start(2 + k).bitwiseOR(F.lit((k + 1) << 40)) for k in range(2)))
        else:
            other = F.when(F.shiftright("sub", 40) == 1, of_start(3)).otherwise(of_start(2))
            flips = F.array(*(F.lit(x).cast("long") for x in [0, *(1 << b for b in range(13))]))
            subs = F.transform(flips, lambda x: F.col("sub").bitwiseOR(F.shiftleft(other.bitwiseXOR(x), 16)))
        rows = large.select("fp", "start", "key", F.explode(subs).alias("sub"))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(id, fp, component_id) of each row: the least id reachable over fingerprints at most 2 bits apart, its own included.

    Equal fingerprints are one class, whatever their number, and only classes are compared. A null, empty or blank text
    has fingerprint 0 and is linked like any other; a null id is never a component's least unless all are null. Repeated
    rows stay, each with its component. A long text is taken whole. Other columns are not carried; an empty table gives none.
    near_texts.drop_near_texts keeps one row of each group of near copies, by the same method.
    """
    rows = cut_lineage(with_fingerprints(docs.select(F.col(id).alias(id), F.col(text).alias("text")), "text", words=words).select(id, "fp"))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min(id).alias("least")))
    reached = connected_components(near_fingerprints(classes.select("fp"))).withColumnRenamed("node", "fp")
    joined = classes.join(reached, "fp")
    groups = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    moved = joined.join(groups, "component").select("fp", "component_id")
    of_class = classes.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    of_class = cut_lineage(of_class)  # so that the join below is one that Spark can split where a fingerprint has many rows
    return cut_lineage(rows.join(of_class, "fp").select(id, "fp", "component_id"))


def hex_digits(fp: str = "fp") -> Column:
    """The fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


__all__ = ["fingerprint", "hex_digits", "links_in_bucket", "near_fingerprints", "simhash_groups", "with_fingerprints"]
