"""Filter interaction audit: what each order of filters removes, and each filter's Shapley share of all removals."""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import A_TO_Z, WORD, cut_lineage

#: Counts of a part's documents by which filters they fail; the rest are counts of some kind among them.
COUNTED = ("n", "good", "toxic")
ROW = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
#: Orders of more filters than these are too many to list: 7 have 5,040.
MOST_FILTERS = 7


class RemovalPolynomial:
    """The number of documents that a set of filters removes, extended to shares x of the filters (a multilinear polynomial).

    `counts` has the documents by their mask, whose bit i says that they fail filter i. One of mask m is removed unless no
    filter of m is there: sum over m of counts[m] * (1 - product over i in m of (1 - x_i)). `coefficients[s]` belongs to the
    product of the x_i in s; all are whole numbers.
    """

    def __init__(self, counts: Mapping[int, int], filters: int):
        self.filters = filters
        above = [counts.get(s, 0) for s in range(1 << filters)]
        for i in range(filters):  # above[s]: documents that fail all of s at least
            for s in range(1 << filters):
                if not s >> i & 1:
                    above[s] += above[s | 1 << i]
        self.coefficients = [0, *(n if s.bit_count() % 2 else -n for s, n in enumerate(above) if s)]

    def at(self, corner: int) -> int:
        """Documents that exactly these filters remove: the value where their x is 1 and the others' 0."""
        return sum(c for s, c in enumerate(self.coefficients) if s & ~corner == 0)

    def shapley(self, i: int) -> Fraction:
        """The integral over t from 0 to 1 of the partial derivative to x_i at x = (t, ..., t): each s with i in it gives
        its coefficient times t to the power of its other members, so 1 / |s| of it."""
        return sum((Fraction(c, s.bit_count()) for s, c in enumerate(self.coefficients) if s >> i & 1), Fraction(0))


def audit_rows(names: str, counts: dict[str, dict[int, int]]) -> list[tuple]:
    """A part's rows, all orders of the filters with all their steps; names has a letter a filter, counts the kinds' masks."""
    k, everything = len(names), (1 << len(names)) - 1
    total = sum(counts["n"].values())
    removal = {kind: RemovalPolynomial(counts[kind], k) for kind in COUNTED}
    gone = {kind: [p.at(corner) for corner in range(1 << k)] for kind, p in removal.items()}
    share = [int(removal["n"].shapley(i) * factorial(k)) for i in range(k)]
    rows = []
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed, good, toxic = (gone[kind][after] - gone[kind][before] for kind in COUNTED)
            fails, alone = gone["n"][1 << i], gone["n"][everything] - gone["n"][everything & ~(1 << i)]
            rows.append(("".join(names[j] for j in order), step, total - gone["n"][after], removed, fails - removed, alone, good, toxic, share[i]))
            before = after
    return rows


def text_filters(text: str = "text") -> dict[str, Column]:
    """The conditions A to D on a text, as columns; words are case-sensitive. Nulls count as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(t, F.lit(f"[{A_TO_Z[0]}-{A_TO_Z[-1]}]")) > 3 * F.length(t),
        "D": t.rlike("[#$%&*|]"),
    }


def mask_counts(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], repeats: bool, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail.

    Bit i of the mask is the i-th of `filters`; with `repeats` one bit more is set where a smaller id has the same text
    anywhere in the table. Groups of equal texts are only aggregated to their least id, and rows meet that id and their
    labels by their own id, so no group of copies, part or text comes together in a task.
    """
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(filters.values())), F.lit(0))
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("same"), mask.alias("mask"))
    rows = cut_lineage(rows)
    if repeats:
        first = rows.groupBy("same").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
        again = F.col("id").isNotNull() & F.col("first").isNull()
        rows = rows.join(first, ["id", "same"], "left").withColumn("mask", F.col("mask") + F.when(again, 1 << len(filters)).otherwise(0))
    marks = labels.groupBy(F.col(id).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(marks, "id", "left")
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")))


def audit_filters(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, repeats: str | None = "E", id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """A row for each part, order of the filters and step: documents kept and removed there, and what that costs.

    filters: conditions under which a document fails, each named by a letter (A to D of text_filters if not given); repeats:
    the letter of one more, which fails documents whose text a smaller id has too, removed or not. redundant: failing the
    step's filter but removed before; unique_fails: failing no other filter; good_lost and toxic_lost: removed here and
    labelled so; shapley: removed by the filter, summed over all orders.

    Documents are counted by mask in Spark, so a part comes to at most 2 ** filters rows, from whose removal polynomials all
    else follows. Null texts are empty, a null part is the empty string; a null id is never a copy, nor labelled, and doesn't
    make others copies. Rows equal in id and text are no copies of each other. Several labels of an id count as one that
    holds if one of them does; labels without a document don't count. Long texts are looked at whole, other columns are not
    carried, an empty table gives no parts.
    """
    filters = text_filters(text) if filters is None else filters
    names = "".join(filters) + (repeats or "")
    if len(set(names)) != len(filters) + bool(repeats) or len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters, each named by a letter of its own: {names}")

    def rows(counted: pa.Table) -> pa.Table:
        columns = counted.to_pydict()
        counts = {kind: dict(zip(columns["mask"], columns[kind], strict=True)) for kind in COUNTED}
        out = list(zip(*audit_rows(names, counts), strict=True))
        found = [[columns["part"][0]] * len(out[0]), *map(list, out)]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.table([pa.array(c, kind) for c, kind in zip(found, kinds, strict=True)], names=[c.split()[0] for c in ROW.split(", ")])

    return mask_counts(docs, labels, filters, repeats is not None, id, text, part).groupBy("part").applyInArrow(rows, ROW)
