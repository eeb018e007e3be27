"""Byte-level BPE: token counts by rank-synchronous array merging, and token ids.

Counting works on chunks: what lies between single spaces. In a byte-level BPE pattern a token never continues from a
non-space character into white space, so a text whose single spaces each stand between two non-space characters splits
there without changing its tokens. Other texts are cut into pre-tokens by the pattern as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendloom.llm.common import text_bytes, values_of

#: Fixed value: the pattern that cuts texts into pre-tokens, as the byte-level pre-tokenizer defines it.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters outside these blocks may be letters to one Unicode version only; the library itself cuts such texts.
UNSETTLED = regex.compile(r"[^\x00-ԯ -⁯℀-⯿　-鿿가-힣＀-￯\U0001F300-\U0001FAFF]")
#: Marks that most chunks end in, if in any.
MARKS = ".,;:!?"
#: Entries of a worker's cache of chunks; a full cache keeps those of the block at hand, which changes no result.
CACHE_SIZE = 500_000


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def slots_of(keys: np.ndarray, factor: int, bits: int = 18) -> np.ndarray:
    return (keys.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)


def hash_tables(keys: np.ndarray, bits: int = 18) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(factor, keys by slot, their positions by slot): each key is in the first table in which its slot was free."""
    tables, left, factor = [], np.arange(len(keys)), 0x9E3779B97F4A7C15
    while len(left):
        slot_key, slot_value = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_MERGE)
        slots, first = np.unique(slots_of(keys[left], factor), return_index=True)
        slot_key[slots], slot_value[slots] = keys[left[first]], left[first]
        tables.append((factor, slot_key, slot_value))
        left = np.delete(left, first)
        factor = factor * 6364136223846793005 % (1 << 64) | 1
    return tables


class Vocabulary:
    """Merges of a tokenizers file as arrays: the id of each rank's merged symbol, and hash tables from a pair to its rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x["content"] for x in spec.get("added_tokens", [])]
        self.special_ids = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.byte_id = np.zeros(256, np.int64)
        for character, byte in byte_characters().items():
            self.byte_id[byte] = ids[character]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([ids[a] for a, _ in pairs], np.int64)
        right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.tables = hash_tables(left << 32 | right)

    def ranks_within(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position in `at`; a huge value where it doesn't merge or ends its piece."""
        after = np.minimum(at + 1, len(symbols) - 1)
        key = symbols[at] << 32 | symbols[after]
        ranks = np.full(len(at), NO_MERGE)
        for factor, keys, values in self.tables:
            slot = slots_of(key, factor)
            np.copyto(ranks, values[slot], where=keys[slot] == key)
        ranks[(owner[at] != owner[after]) | (after == at)] = NO_MERGE
        return ranks

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of symbols of each piece, all final symbols in order), merging every piece's lowest-ranked pair at once.

        The pieces lie in one ragged array. Each round finds every piece's lowest rank, replaces all pairs of that rank
        (in a run of overlapping ones every second), and goes on with the pieces that changed.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        rank = self.ranks_within(symbols, owner, np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, begins)
            lowest = np.repeat(lowest, np.diff(np.r_[begins, len(symbols)]))
            goes_on = lowest < NO_MERGE
            if not goes_on.all():
                done.append((owner[~goes_on], symbols[~goes_on]))
                symbols, rank, owner, lowest = symbols[goes_on], rank[goes_on], owner[goes_on], lowest[goes_on]
            if not len(symbols):
                break
            at = np.flatnonzero(rank == lowest)
            # in a run of overlapping pairs (as in "aaaa") the first, third, ... merge
            first = np.r_[True, np.diff(at) != 1]
            run_start = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, rank, owner = symbols[keep], rank[keep], owner[keep]
            # only the pairs that a merged symbol is part of have a new rank
            at -= np.arange(len(at))
            changed = np.zeros(len(symbols), bool)
            changed[at] = changed[at[at > 0] - 1] = True
            changed = np.flatnonzero(changed)
            rank[changed] = self.ranks_within(symbols, owner, changed)
        counts = np.zeros(len(pieces), np.int64)
        if not done:
            return counts, np.zeros(0, np.int64)
        who, what = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        counts += np.bincount(who, minlength=len(pieces))
        return counts, what[np.argsort(who, kind="stable")]


NO_MERGE = np.iinfo(np.int64).max


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each worker."""
    return Vocabulary(path)


def pre_tokens(text: str, words: Vocabulary) -> list[str]:
    """Pre-tokens of a text without special strings."""
    if UNSETTLED.search(text):
        return [text[a:b] for _, (a, b) in words.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    return PATTERN.findall(text)


def around_special(text: str, words: Vocabulary) -> Iterator[tuple[str, bool]]:
    """(part, whether it is a special string): the library takes special strings out of a text first."""
    if not any(s in text for s in words.special):
        yield text, False
        return
    splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(words.special, key=len, reverse=True))) + ")")
    for part in splitter.split(text):
        if part:
            yield part, part in words.special_ids


class ChunkCache:
    """Values of chunks by the chunk's text; unseen ones are worked out together. A chunk that can't stand alone has None."""

    def __init__(self, work: Callable[[list[str]], list], add: Callable[[list], object], lead: str, size: int):
        self.work, self.add, self.lead, self.size, self.known = work, add, lead, size, {}
        self.marks = dict(zip(MARKS, work(list(MARKS)), strict=True))

    def learn(self, chunks: set[str]) -> None:
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > self.size:
            self.known = {c: self.known[c] for c in chunks.difference(new)}
        # single spaces around a chunk must stand next to characters that aren't white space; a text may begin with any
        clean = [c for c in new if c and c.strip() == c] if self.lead else [c for c in new if c.rstrip() == c]
        if len(clean) < len(new):
            self.known.update(dict.fromkeys(new.difference(clean)))
        # a mark after a letter at the end of a chunk is a pre-token of its own
        marked = [c for c in clean if c[-1:] in self.marks and c[-2:-1].isalpha()]
        own = list({c[:-1] for c in marked}.union(clean).difference(marked).difference(self.known))
        self.known.update(zip(own, self.work([self.lead + c for c in own]), strict=True))
        self.known.update((c, self.add((self.known[c[:-1]], self.marks[c[-1]]))) for c in marked)


class ChunkedEncoder:
    """Applies `work` (a list of texts to a list of values that add up) to whole texts, chunk by chunk.

    A line break between characters that aren't white space is a pre-token of its own, so each line is cut as a text of its
    own. special: the value of a special string. add: joins values. CACHE_SIZE bounds the entries kept besides those of one
    call.
    """

    def __init__(self, words: Vocabulary, work: Callable[[list[str]], list], special: Callable[[str], object], add: Callable[[Iterable], object], size: int = CACHE_SIZE):
        self.words, self.work, self.special, self.add = words, work, special, add
        self.first, self.rest = ChunkCache(work, add, "", size // 4), ChunkCache(work, add, " ", size)
        self.line_break = work(["\n"])[0]

    def __call__(self, texts: list[bytes]) -> list:
        parts = [list(around_special(t.decode("utf-8", "replace"), self.words)) for t in texts]
        split = [[None if special else cut_lines(part) for part, special in row] for row in parts]
        plain = [line for row in split for lines in row if lines for line in lines]
        self.first.learn({line[0] for line in plain})
        self.rest.learn(set().union(*(line[1:] for line in plain)))
        first, rest = self.first.known, self.rest.known
        out = []
        for row, cut in zip(parts, split, strict=True):
            values = []
            for (part, special), lines in zip(row, cut, strict=True):
                if special:
                    values.append(self.special(part))
                elif not lines:
                    values += self.work([part])
                else:
                    own = []
                    for line in lines:
                        own.append(self.line_break)
                        own.append(first[line[0]])
                        own += map(rest.__getitem__, line[1:])
                    values += self.work([part]) if None in own else own[1:]
            out.append(self.add(values))
        return out


def cut_lines(text: str) -> list[list[str]]:
    """Chunks of each line; no lines if one is empty or white space stands at its edge."""
    lines = text.split("\n")
    if len(lines) == 1:
        return [text.split(" ")]
    return [line.split(" ") for line in lines] if all(line and line.strip() == line for line in lines) else []


def cut_all(texts: list[str], words: Vocabulary) -> tuple[list[str], np.ndarray]:
    """(all pre-tokens of the texts in order, number of them in each text).

    Texts that are a space and a chunk without spaces are cut in one go: then each pre-token that begins with a space
    begins a text.
    """
    joined = "".join(texts)
    if len(texts) > 1 and joined.count(" ") == len(texts) and all(t[0] == " " for t in texts if t) and not UNSETTLED.search(joined):
        pieces = PATTERN.findall(joined)
        begins = np.fromiter((p[0] == " " for p in pieces), bool, len(pieces))
        if begins.sum() == len(texts):
            return pieces, np.diff(np.r_[np.flatnonzero(begins), len(pieces)])
    cut = [pre_tokens(t, words) for t in texts]
    return [p for pieces in cut for p in pieces], np.fromiter(map(len, cut), np.int64, len(cut))


def merged_counts(texts: list[str], words: Vocabulary) -> list[int]:
    """Number of tokens of each text, from all their distinct pre-tokens merged together."""
    pieces, held = cut_all(texts, words)
    distinct = dict.fromkeys(pieces)
    counts, _ = words.merge_all([p.encode() for p in distinct])
    size = dict(zip(distinct, counts.tolist(), strict=True))
    total = np.r_[0, np.cumsum(np.fromiter(map(size.__getitem__, pieces), np.int64, len(pieces)))]
    ends = np.cumsum(held)
    return (total[ends] - total[ends - held]).tolist()


@lru_cache(maxsize=4)
def token_counter(path: str) -> ChunkedEncoder:
    words = vocabulary(path)
    return ChunkedEncoder(words, lambda texts: merged_counts(texts, words), lambda _: 1, sum)


@lru_cache(maxsize=4)
def token_encoder(path: str) -> Callable[[bytes], np.ndarray]:
    """A text to its ids as the tokenizers library gives them for this file.

    tiktoken finds the same ids several times as fast where a symbol's id rises with its merge's rank, as in this kind of
    file; other files, and texts whose characters may be letters to one library only, go to the library itself.
    """
    words = vocabulary(path)
    ids, of_character = words.tokenizer.get_vocab(with_added_tokens=False), byte_characters()
    ranks = {bytes(map(of_character.__getitem__, token)): i for token, i in ids.items() if all(c in of_character for c in token) and i not in words.special_ids.values()}
    in_order = bool((np.diff(words.merged) > 0).all()) and words.byte_id.max() < words.merged.min()
    fast = tiktoken.Encoding("own", pat_str=PATTERN.pattern, mergeable_ranks=ranks, special_tokens={}) if in_order else None

    def encode(raw: bytes) -> np.ndarray:
        text, out = raw.decode("utf-8", "replace"), []
        for part, special in around_special(text, words):
            if special:
                out.append(words.special_ids[part])
            elif fast is None or not part.isascii() and UNSETTLED.search(part):
                out += words.tokenizer.encode(part, add_special_tokens=False).ids
            else:
                out += fast.encode_ordinary(part)
        return np.array(out, "<u4")

    return encode


def in_blocks(texts: Iterable[bytes], most: int = 4 << 20) -> Iterator[list[bytes]]:
    """Lists of texts of a few MB each, so that what a block needs is bounded."""
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t)
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_tokens(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each whole text, as the tokenizers library gives it by default, in column `name`.

    No begin, end or added tokens; special strings inside a text count as the special token they are. A null or empty
    text has 0, a long one is counted whole. Repeated rows each get their count; an input column called `name` is replaced;
    other columns pass through. An empty table gives none.
    path: a byte-level BPE file of that library which every worker can open.
    """

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        counter = token_counter(path)
        return pa.array([n for block in in_blocks(values_of(column)) for n in counter(block)], pa.int64())

    return docs.withColumn(name, count(text_bytes(text)))
