"""Benchmark decontamination with a positional inverted index of the training documents."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lendloom.llm.common import stored, text_bytes
from lendloom.llm.words import BLOCK_BYTES, block_ids, in_blocks, words_of

WINDOW = 10
#: The term, none of a text, under which a block keeps where its documents begin.
STARTS = b""
TERM, DOCUMENT = "term", "document"


@dataclass(frozen=True)
class Index:
    """postings (term, block, n, gaps): the positions of a term in a block, as 32-bit differences of each to the one before.
    documents (block, place, id, n_words): the documents of a block in order; one position is free between two of them."""

    postings: DataFrame
    documents: DataFrame


def _gaps(positions: np.ndarray) -> bytes:
    return np.diff(positions, prepend=0).astype(np.int32).tobytes()


def _positions(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, np.int32), dtype=np.int64)


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Index:
    """The index of all words of docs, written to the shared folder. Blocks of documents are inverted one at a time."""
    kind = docs.schema[id].dataType
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("gaps", pa.binary()), ("place", pa.int32()), ("id", to_arrow_type(kind)), ("n_words", pa.int64())])

    def batch(kind: str, block: int, n: int, given: dict[str, pa.Array]) -> pa.RecordBatch:
        given |= {"kind": pa.array([kind] * n), "block": pa.array([block] * n, pa.int64())}
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_block = block_ids()
        for part in in_blocks(batches, block_bytes):
            block, texts = new_block(), part.num_rows
            words, counts = words_of(part.column("text"))
            starts = np.r_[0, np.cumsum(counts + 1)[:-1]]
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            positions = (np.arange(len(codes)) + np.repeat(np.arange(texts), counts))[order].astype(np.int32)
            of_term = np.bincount(codes, minlength=len(coded.dictionary))
            ends = np.cumsum(of_term)
            gaps = np.diff(positions, prepend=0)
            gaps[ends[:-1]] = positions[ends[:-1]]
            lists = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((4 * np.r_[0, ends]).astype(np.int32)), pa.py_buffer(gaps.astype(np.int32))])
            terms = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([STARTS], pa.binary())])
            lists = pa.concat_arrays([lists, pa.array([_gaps(starts)], pa.binary())])
            yield batch(TERM, block, len(terms), {"term": terms, "n": pa.array(np.r_[of_term, 0], pa.int64()), "gaps": lists})
            yield batch(DOCUMENT, block, texts, {"place": pa.array(range(texts), pa.int32()), "id": part.column("id").cast(schema.field("id").type), "n_words": pa.array(counts, pa.int64())})

    rows = docs.select(F.col(id).alias("id"), text_bytes(text).alias("text")).mapInArrow(invert, f"kind string, block long, term binary, n long, gaps binary, place int, id {kind.simpleString()}, n_words long")
    held = stored(rows, "index", "kind")
    return Index(held().where(F.col("kind") == TERM).select("term", "block", "n", "gaps"), held().where(F.col("kind") == DOCUMENT).select("block", "place", "id", "n_words"))


def items_of(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): the words of each item that has some, joined by spaces."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            words, counts = words_of(batch.column("text"))
            ends = np.r_[0, np.cumsum(counts)]
            all_words = words.to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array([b" ".join(all_words[a:b]) for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["item", "words"])

    kind = benchmark.schema[id].dataType.simpleString()
    return benchmark.select(F.col(id).alias("item"), text_bytes(text).alias("text")).mapInArrow(joined, f"item {kind}, words binary").where(F.length("words") > 0)


class Searcher:
    """Phrases in the postings of one block: {term: positions}, and where its documents begin."""

    def __init__(self, held: dict[bytes, np.ndarray]):
        self.held, self.starts = held, held[STARTS]

    def exact(self, phrase: list[bytes]) -> np.ndarray:
        """Positions where the phrase begins: each term's list, moved back by its offset, met from the rarest on."""
        lists = sorted(((self.held.get(t), k) for k, t in enumerate(phrase)), key=lambda x: 0 if x[0] is None else len(x[0]))
        if lists[0][0] is None:
            return np.zeros(0, np.int64)
        found = lists[0][0] - lists[0][1]
        for positions, offset in lists[1:]:
            if not len(found):
                break
            at = np.searchsorted(positions, found + offset)
            at[at == len(positions)] = 0
            found = found[positions[at] == found + offset]
        return found

    def near(self, phrase: list[bytes], slop: int) -> list[tuple[int, int]]:
        """(position, length) of the spans of at most `slop` words more that hold all the phrase's words in any order, one
        at most for each occurrence of the rarest word: the shortest, then the first. The phrase itself counts too."""
        need = Counter(phrase)
        if any(t not in self.held for t in need):
            return []
        rare, reach, out = min(need, key=lambda t: len(self.held[t])), len(phrase) + slop, set()
        for p in self.held[rare]:
            k = int(np.searchsorted(self.starts, p, side="right"))
            first = max(int(self.starts[k - 1]), int(p) - reach + 1)
            last = min(int(p) + reach, int(self.starts[k]) if k < len(self.starts) else 1 << 62)
            there = sorted((int(x), t) for t in need for x in self.held[t][np.searchsorted(self.held[t], first) : np.searchsorted(self.held[t], last)])
            best, missing, have, begin = None, len(phrase), Counter(), 0
            for x, t in there:  # the shortest run that holds p and the whole phrase
                have[t] += 1
                missing -= have[t] <= need[t]
                while missing == 0 and begin < len(there) and there[begin][0] <= p:
                    at, gone = there[begin]
                    if x >= p and x - at < reach and (best is None or x - at + 1 < best[1]):
                        best = (at, x - at + 1)
                    have[gone] -= 1
                    missing += have[gone] < need[gone]
                    begin += 1
            if best:
                out.add(best)
        return sorted(out)


def merged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs that spans, sorted by their starts, cover together; spans that only touch stay apart."""
    ends = np.maximum.accumulate(starts + lengths)
    new = np.r_[True, starts[1:] >= ends[:-1]]
    first = np.flatnonzero(new)
    return starts[first], np.maximum.reduceat(ends, first) - starts[first]


def windows_of(words: bytes, window: int) -> list[list[bytes]]:
    """All runs of `window` words; fewer words, but not none, are one."""
    w = words.split(b" ")
    return [w[k : k + window] for k in range(max(1, len(w) - window + 1))]


MATCH = "block long, place int, item long, position long, length long, exact boolean"


def _search(window: int, slop: int):
    def search(postings: pa.Table, items: pa.Table) -> pa.Table:
        """The matches of all items that may occur in the block."""
        columns, out = postings.to_pydict(), []
        searcher = Searcher({t: _positions(g) for t, g in zip(columns["term"], columns["gaps"], strict=True)})
        found: dict[tuple[bytes, ...], tuple[np.ndarray, list]] = {}
        for item, words in zip(items.column("item").to_pylist(), items.column("words").to_pylist(), strict=True):
            exact, near, size = [], [], 0
            for phrase in windows_of(words, window):
                key, size = tuple(phrase), len(phrase)
                if key not in found:
                    at = searcher.exact(phrase)
                    there = set(at.tolist())
                    found[key] = at, [x for x in searcher.near(phrase, slop) if x[0] not in there] if slop else []
                exact.append(found[key][0])
                near += found[key][1]
            spans = np.unique(np.concatenate(exact))
            for starts, lengths, kind in ((spans, np.full(len(spans), size), True), (np.array([x for x, _ in sorted(near)], np.int64), np.array([n for _, n in sorted(near)], np.int64), False)):
                if len(starts):
                    out += [(item, int(a), int(n), kind) for a, n in zip(*merged(starts, lengths), strict=True)]
        block = postings.column("block")[0].as_py() if postings.num_rows else 0
        at = np.array([x[1] for x in out], np.int64)
        place = np.searchsorted(searcher.starts, at, side="right") - 1
        return pa.table({"block": pa.array([block] * len(out), pa.int64()), "place": pa.array(place, pa.int32()), "item": pa.array([x[0] for x in out], pa.int64()), "position": pa.array(at - searcher.starts[place], pa.int64()), "length": pa.array([x[2] for x in out], pa.int64()), "exact": pa.array([x[3] for x in out], pa.bool_())})

    return search


def find_items(index: Index, texts: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(block, place, item, position, length, exact): where windows of the texts (item, words) occur in the documents.

    Windows are the runs of `window` words of a text, or the whole of a shorter one. An exact match is a window word for word;
    windows of an item that overlap in a document are one match. With slop, spans of up to that many words more that hold all
    words of a window in any order are matches too, not exact ones.

    A window can only be where its rarest word is: the words of the texts are counted over the whole index, and an item goes
    to the blocks that hold the rarest word of one of its windows, as the lists of all its words do. There the lists,
    moved by their offsets, are intersected from the block's rarest word on. Blocks have a bounded size, so a word that is
    everywhere has a bounded list in each; the texts a block gets are those that may occur there.
    """
    spark = texts.sparkSession
    texts = stored(texts, "items")()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(item, k, t) for item, words in zip(*(c.to_pylist() for c in batch.columns), strict=True) for k, w in enumerate(windows_of(words, window)) for t in set(w)]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["item", "k", "term"])

    terms = stored(texts.select("item", "words").mapInArrow(listed, "item long, k int, term binary"), "terms")()
    wanted = terms.select("term").distinct().unionByName(spark.range(1).select(F.lit(STARTS).alias("term")))
    wanted = stored(wanted, "wanted")()
    held = index.postings.join(wanted, "term", "left_semi")
    often = held.groupBy("term").agg(F.sum("n").alias("often"))
    rarest = terms.join(often, "term", "left").groupBy("item", "k").agg(F.min_by("term", F.struct(F.coalesce("often", F.lit(0)), "term")).alias("term"))
    rarest = stored(rarest.select("item", "term").distinct(), "rarest")()
    near = index.postings.select("term", "block").join(rarest, "term").select("block", "item").distinct()
    near = stored(near, "candidates")()
    lists = held.join(near.select("block").distinct(), "block", "left_semi").select("block", "term", "gaps")
    sent = near.join(texts, "item").select("block", "item", "words")
    return lists.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_search(window, slop), MATCH)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items, near_items, matches) of each document: words inside exact matches, the ids (as sorted
    text) of the items with exact matches and of those with other ones only, and the matches themselves.

    matches has (item, position, length, exact) in words of the document, where item is an id; items equal in their words
    are searched once. Null and empty texts have no words. A null item id marks words, but no list has it. Long texts are
    taken whole, one beyond a block's size being a block; repeated rows are documents each; an empty table gives none, an
    empty benchmark no matches. Other columns are not carried.
    """
    index = build_index(docs, id, text)
    items = items_of(benchmark, item_id, item_text)
    texts = items.select("words").distinct().select(F.monotonically_increasing_id().alias("text"), "words")
    texts = stored(texts, "texts")()
    found = find_items(index, texts.withColumnRenamed("text", "item"), window, slop)
    found = stored(found, "matches")().withColumnRenamed("item", "text")
    spans = F.array_sort(F.collect_list(F.when(F.col("exact"), F.struct("position", "length"))))
    # words so far, and where the spans so far end
    fold = F.aggregate("spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")), lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), s["position"] + s["length"] - F.greatest(a["end"], s["position"]))).alias("n"), F.greatest(a["end"], s["position"] + s["length"]).alias("end")), lambda a: a["n"])
    of_doc = found.groupBy("block", "place").agg(spans.alias("spans")).select("block", "place", fold.alias("n_hit"))
    named = items.join(texts, "words").select("text", F.col("item").cast("string").alias("item")).distinct()
    matched = found.join(named, "text").groupBy("block", "place")
    lists = matched.agg(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item")))).alias("items"), F.array_sort(F.collect_set("item")).alias("all"), F.array_sort(F.collect_list(F.struct("position", "length", "item", "exact"))).alias("matches"))
    none = F.array().cast("array<string>")
    rows = index.documents.join(of_doc, ["block", "place"], "left").join(lists, ["block", "place"], "left")
    matches = F.coalesce("matches", F.array().cast("array<struct<position: long, length: long, item: string, exact: boolean>>"))
    return rows.select(F.col("id").alias(id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce(F.array_except("all", "items"), none).alias("near_items"), matches.alias("matches"))
