"""Quality rules as a short-circuit cascade, cheapest and most selective rule first."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendloom.llm.common import text_bytes, values_of

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
LETTER = re.compile(rb"[A-Za-z\x80-\xff]").search


class Counts:
    """Counts of one whole text, each worked out when first asked for. bytes.split() cuts at ASCII white space only."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.text.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_stutter(self) -> int:
        """Words equal to the word before."""
        return sum(map(bytes.__eq__, self.words, self.words[1:]))

    @cached_property
    def n_top_word(self) -> int:
        """How often the most frequent word comes."""
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def n_letter_words(self) -> int:
        """Words with a letter: A to Z, or any character beyond ASCII."""
        return sum(map(bool, map(LETTER, self.words)))

    @cached_property
    def n_cut_lines(self) -> int:
        """Lines that end in an ellipsis."""
        return sum(x.rstrip(SPACE).endswith((b"...", "…".encode())) for x in self.lines)

    @cached_property
    def n_bullet_lines(self) -> int:
        """Lines that begin with a bullet."""
        return sum(x.lstrip(SPACE).startswith((b"- ", b"* ", "•".encode())) for x in self.lines)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in 5-word windows that are found twice or more."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:], strict=False))
        if len(set(windows)) == len(windows):
            return 0
        found = Counter(windows)
        edge = np.zeros(len(w) + 1, np.int64)
        starts = np.fromiter((i for i, x in enumerate(windows) if found[x] > 1), np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + 5, -1)
        return int((np.cumsum(edge) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Counts], bool]


#: The rules on top of the base ones; they compare whole numbers, so their verdict doesn't depend on rounding. Symbols,
#: dup_lines and word_length read base counts, which are there anyway; what the others read is worked out for them alone.
RULES = (
    Rule("symbols", lambda c: 10 * c.n_symbols > c.n_words),
    Rule("stutter", lambda c: 5 * c.n_stutter > c.n_words),
    Rule("dup_lines", lambda c: 2 * c.n_dup_lines > len(c.lines)),
    Rule("word_length", lambda c: not 2 * c.n_words <= c.word_chars <= 100 * c.n_words),
    Rule("top_word", lambda c: 10 * c.n_top_word > 4 * c.n_words),
    Rule("no_letters", lambda c: 2 * c.n_letter_words < c.n_words),
    Rule("cut_lines", lambda c: 10 * c.n_cut_lines > 3 * len(c.lines)),
    Rule("bullets", lambda c: len(c.lines) > 1 and 10 * c.n_bullet_lines > 9 * len(c.lines)),
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(c: Counts) -> bool:
    return c.n_words < 10 or 100 * c.n_repeat_words > 20 * c.n_words


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, text: str = "text") -> list[int]:
    """Numbers of the rules by falling rejections per cost, both estimated on about sample_rows rows of all of docs.

    The rows are those whose hash is 0 modulo a number that follows from the count of rows, so they come from every file and
    source; texts are measured where they lie, and only sums come to the driver. A rule's cost is the CPU time from the base
    counts, which every text needs, to its verdict. The order changes how long the cascade takes, never what it keeps.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected = [0] * len(rules), [0] * len(rules)
        for batch in batches:
            for t in values_of(batch.column(0)):
                base = Counts(t)
                if base_failed(base):
                    continue
                for name in BASE:
                    getattr(base, name)
                for k, rule in enumerate(rules):
                    own = copy(base)
                    began = time.thread_time_ns()
                    rejected[k] += bool(rule.fails(own))
                    spent[k] += time.thread_time_ns() - began
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rules)), pa.int32()), pa.array(spent, pa.int64()), pa.array(rejected, pa.int64())], ["rule", "spent", "rejected"])

    known = [F.col(c) for c, kind in docs.dtypes if c != text and "map<" not in kind and "variant" not in kind]
    every = max(1, docs.select(F.lit(1)).count() // sample_rows)
    drawn = docs.where(F.pmod(F.xxhash64(*known, F.octet_length(text)), F.lit(every)) == 0).select(text_bytes(text).alias("text"))
    sums = {r.rule: r for r in drawn.mapInArrow(measure, "rule int, spent long, rejected long").groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected")).collect()}
    gain = [(sums[k].rejected + 0.5) / max(1, sums[k].spent) if k in sums else 0.0 for k in range(len(rules))]
    return sorted(range(len(rules)), key=lambda k: (-gain[k], k))


def with_verdict(docs: DataFrame, rules: tuple[Rule, ...] = RULES, order: list[int] | None = None, sample_rows: int = 2000, text: str = "text", name: str = "quality") -> DataFrame:
    """docs with a struct of the base counts, base_failed, kept, and first_failed: the rule that ended the cascade.

    base_failed comes first: under 10 words, or over a fifth of the words in repeated 5-word windows. A text that passes
    runs through the rules in the order of rule_order until one rejects it, and what later rules need isn't worked out.
    Null and empty texts have no words and fail; a long text is looked at whole. first_failed depends on the order, all else
    doesn't. Repeated rows each get their verdict; an input column called `name` is replaced; other columns pass through.
    An empty table gives none.
    """
    order = rule_order(docs, rules, sample_rows, text) if order is None else order
    kind = "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, base_failed: boolean, kept: boolean, first_failed: string>"
    schema = pa.struct([*((n, pa.int64()) for n in BASE), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("first_failed", pa.string())])

    @F.arrow_udf(kind)
    def judge(column: pa.Array) -> pa.Array:
        out = []
        for t in values_of(column):
            c = Counts(t)
            base = base_failed(c)
            failed = "base" if base else next((rules[k].name for k in order if rules[k].fails(c)), None)
            out.append((*(getattr(c, n) for n in BASE), base, failed is None, failed))
        columns = list(zip(*out, strict=True)) or [[] for _ in schema]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], fields=list(schema))

    return docs.withColumn(name, judge(text_bytes(text)))
