"""Packing of tokenised documents into fixed windows: online by sum of squares, and best fit decreasing in blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lendloom.llm.common import stored, text_bytes, values_of
from lendloom.llm.tokens import token_encoder

PIECE = "{id} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Bits of a sequence id below the partition's number, and the bit that those of the second streams have.
LOCAL_BITS, SECOND = 40, 1 << 62


class SumOfSquares:
    """Online packing: each item goes to the fill level that minimises the sum of squared counts of part-filled windows.

    `count[h]` is the number of open windows filled to h; the windows themselves lie in a stack per level.
    """

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """Fill level to place an item of this size on; 0 opens a window. Of equal levels the fullest wins."""
        if size == self.window:
            return 0
        count, top = self.count, self.window - size
        # growth of the sum, halved: N[h + s] gains one window, N[h] loses one; full windows and level 0 aren't counted
        change = count[size : size + top + 1] - count[: top + 1] + 1.0
        change[0] = count[size] + 0.5
        change[top] = 0.5 - count[top]
        change[1:][count[1 : top + 1] == 0] = np.inf
        return top - int(np.argmin(change[::-1]))

    def place(self, item: tuple, size: int) -> list | None:
        """Puts an item in; returns the window's items if that fills it."""
        level = self.level_for(size)
        if level:
            self._take_from(level)
            window = self.open[level].pop()
        else:
            window = []
        window.append(item)
        if level + size == self.window:
            return window
        self._put_on(level + size, window)
        return None

    def _take_from(self, level: int) -> None:
        self.count[level] -= 1
        self.n_open -= 1

    def _put_on(self, level: int, window: list) -> None:
        self.count[level] += 1
        self.n_open += 1
        self.open[level].append(window)

    def crowded(self) -> list[list]:
        """Takes the windows of the most crowded level out."""
        level = int(np.argmax(self.count))
        out, self.open[level] = self.open[level], []
        self.n_open -= len(out)
        self.count[level] = 0
        return out

    def rest(self) -> list[list]:
        """The windows that are still open, the fullest first."""
        return [w for level in reversed(self.open) for w in level]


def _cut(piece: tuple, length: int) -> tuple[tuple, tuple]:
    """A piece (id, start, ids, doc_tokens) as two, the first of this length."""
    id, start, ids, total = piece
    return (id, start, ids[:length], total), (id, start + length, ids[length:], total)


def close_windows(rest: list[list], window: int) -> Iterator[list]:
    """The pieces of part-filled windows in full ones: the emptiest are poured into the fullest, cut where they don't fit.

    What is left at the end, less than a window, goes into sequences whose lengths are falling powers of two.
    """
    rest = [w for w in rest if w]
    first, last = 0, len(rest) - 1
    while first < last:
        own, free = rest[first], window - sum(len(p[2]) for p in rest[first])
        while free and first < last:
            piece = rest[last].pop()
            if len(piece[2]) > free:
                piece, left = _cut(piece, free)
                rest[last].append(left)
            own.append(piece)
            free -= len(piece[2])
            if not rest[last]:
                last -= 1
        if not free:
            yield own
            first += 1
    for own in rest[first : last + 1]:
        size = sum(len(p[2]) for p in own)
        while size:
            part, free = [], min(window, 1 << (size.bit_length() - 1))
            size -= free
            while free:
                piece = own.pop(0)
                if len(piece[2]) > free:
                    piece, left = _cut(piece, free)
                    own.insert(0, left)
                part.append(piece)
                free -= len(piece[2])
            yield part


def documents_as_ids(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[object, np.ndarray]]:
    """(id, token ids with end_id after them) of each row (id, text as bytes)."""
    encode, end = token_encoder(path), np.array([end_id], "<u4")
    for batch in batches:
        for id, text in zip(values_of(batch.column(0)), values_of(batch.column(1)), strict=True):
            yield id, np.concatenate([encode(text), end])


def _pieces(windows: Iterator[list], first: int) -> Iterator[tuple]:
    """A row for each piece of each window; sequence ids count up from `first`."""
    for n, window in enumerate(windows):
        offset = 0
        for id, start, ids, total in window:
            yield id, start, len(ids), zlib.crc32(ids.tobytes()), total, first + n, offset
            offset += len(ids)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _packed(pieces: Iterator[tuple], window: int, most_open: int) -> Iterator[tuple[bool, list]]:
    """(full, items) for the windows that pieces (id, start, ids, doc_tokens) fill, and then for those left open.

    Whole windows of a piece stand alone, its remainder goes to the fill level that minimises the sum of squares. With more
    than most_open windows open those of the most crowded level are given up as they are.
    """
    packer = SumOfSquares(window)
    for id, start, ids, total in pieces:
        whole = len(ids) // window * window
        for at in range(0, whole, window):
            yield True, [(id, start + at, ids[at : at + window], total)]
        if len(ids) > whole and (full := packer.place((id, start + whole, ids[whole:].copy(), total), len(ids) - whole)):
            yield True, full
        if packer.n_open > most_open:
            yield from ((False, w) for w in packer.crowded())
    yield from ((False, w) for w in packer.rest())


def pack_online(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id: str = "doc_id", text: str = "text", most_open: int = 1 << 14, task_tokens: int = 1 << 24) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents, packed into windows.

    Each partition is a stream: a document's whole windows stand alone, its remainder goes to the fill level that minimises
    the sum of squares. The windows that a partition leaves open are taken apart, and their pieces are streams again, of some
    task_tokens tokens each and the longest first, packed by the same rule; only what these leave open is poured together,
    which cuts pieces. Less than a window a stream is then left, and goes into sequences of power-of-two lengths, which need
    no padding.

    A task keeps only its open windows, most_open at most: beyond that those of the most crowded level go to the second
    streams at once. Only pieces of open windows are shuffled, a few windows' worth for each level in use. A null or empty
    text is its end_id alone; a long text is cut into whole windows and a remainder. Repeated rows are packed each; an empty
    table gives none; other columns are not carried. A lost partition is packed again as a whole.
    """
    kind = docs.schema[id].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])
    piece, no_ids = PIECE.format(id="id", kind=kind.simpleString()) + ", ids binary", None

    def first_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            n = TaskContext.get().partitionId() << LOCAL_BITS
            pieces = ((doc, 0, ids, len(ids)) for doc, ids in documents_as_ids(batches, path, end_id))
            for full, items in _packed(pieces, window, most_open):
                if full:
                    yield from ((*row, no_ids) for row in _pieces(iter([items]), n))
                else:  # sequence_id and offset only say from where the piece comes
                    yield from ((doc, start, len(ids), None, total, n, k, ids.tobytes()) for k, (doc, start, ids, total) in enumerate(items))
                n += 1

        yield from _in_batches(rows(), schema)

    def second_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows() -> Iterator[list]:
            pieces = ((doc, start, np.frombuffer(ids, "<u4"), total) for batch in batches for doc, start, total, ids in zip(*(values_of(batch.column(c)) for c in ("id", "start", "doc_tokens", "ids")), strict=True))
            left = []
            for full, items in _packed(pieces, window, 1 << 62):
                if full:
                    yield items
                else:
                    left.append(items)
            yield from close_windows(left, window)

        first = SECOND | TaskContext.get().partitionId() << LOCAL_BITS
        yield from _in_batches(((*row, no_ids) for row in _pieces(windows(), first)), schema)

    packed = stored(docs.select(F.col(id).alias("id"), text_bytes(text).alias("text")).mapInArrow(first_streams, piece), "packed")
    open_pieces = packed().where(F.col("ids").isNotNull())
    tasks = 1 + (open_pieces.agg(F.sum("length")).first()[0] or 0) // task_tokens
    streams = open_pieces.repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("length"), "sequence_id", "offset")
    rows = packed().where(F.col("ids").isNull()).unionByName(streams.mapInArrow(second_streams, piece))
    return rows.drop("ids").withColumnRenamed("id", id)


class CapacityTree:
    """Segment tree over the free space of windows: finds the window with the least free space that still holds an item.

    Leaves stand for free sizes 0 to `window`; a node holds the number of windows below it, so the search for the least
    size at or above an item's goes up and down the tree once.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, free: int, n: int) -> None:
        at = self.leaves + free
        while at:
            self.count[at] += n
            at >>= 1

    def least_at_or_above(self, size: int) -> int:
        """That free size, or -1."""
        at = self.leaves + size
        if self.count[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], window: int) -> list[list[int]]:
    """Windows as lists of item numbers: items from the largest on, each into the fullest window that holds it."""
    tree, by_free, out = CapacityTree(window), [[] for _ in range(window + 1)], []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        free = tree.least_at_or_above(sizes[item])
        if free < 0:
            at, free = len(out), window
            out.append([])
        else:
            at = by_free[free].pop()
            tree.add(free, -1)
        out[at].append(item)
        if left := free - sizes[item]:
            by_free[left].append(at)
            tree.add(left, 1)
    return out


def pack_matrices(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, pad_id: int = 0, block_tokens: int = 1 << 21, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of packed id matrices (sequence_id, doc_ids, starts, ids, cu_seqlens, position_resets, n_tokens).

    Each row is one window: `ids` holds its little-endian unsigned 32-bit token ids padded with pad_id, `cu_seqlens` the
    cumulative segment lengths from 0, `position_resets` the offsets at which positions start again from 0 (one for each
    segment, and one for the padding), `doc_ids` and `starts` say which document's ids a segment holds and from where.

    A document longer than a window is split losslessly: whole windows and a remainder. Each task takes blocks of about
    block_tokens tokens in the order of its input and packs each by best fit decreasing, so memory is bounded and nothing
    is shuffled. A null or empty text is its end_id alone; repeated rows are packed each; an empty table gives none; other
    columns are not carried.
    """
    kind = docs.schema[id].dataType
    schema = pa.schema([("sequence_id", pa.int64()), ("doc_ids", pa.list_(to_arrow_type(kind))), ("starts", pa.list_(pa.int64())), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("n_tokens", pa.int64())])
    declared = f"sequence_id long, doc_ids array<{kind.simpleString()}>, starts array<long>, ids binary, cu_seqlens array<int>, position_resets array<int>, n_tokens long"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << LOCAL_BITS

        def blocks() -> Iterator[list[tuple]]:
            held, tokens = [], 0
            for doc, ids in documents_as_ids(batches, path, end_id):
                held += [(doc, at, ids[at : at + window]) for at in range(0, len(ids), window)]
                tokens += len(ids)
                if tokens >= block_tokens:
                    yield held
                    held, tokens = [], 0
            yield held

        def rows() -> Iterator[tuple]:
            n = first
            for block in blocks():
                for items in best_fit_decreasing([len(p[2]) for p in block], window):
                    own = [block[i] for i in items]
                    ends = np.cumsum([len(p[2]) for p in own])
                    filled = int(ends[-1])
                    ids = np.full(window, pad_id, "<u4")
                    ids[:filled] = np.concatenate([p[2] for p in own])
                    starts = [0, *ends.tolist()]
                    yield n, [p[0] for p in own], [p[1] for p in own], ids.tobytes(), starts, starts[: len(own)] + ([filled] if filled < window else []), filled
                    n += 1

        yield from _in_batches(rows(), schema, 256)

    return docs.select(F.col(id).alias("id"), text_bytes(text).alias("text")).mapInArrow(pack, declared)


def write_matrices(rows: DataFrame, folder: str) -> None:
    """Packed rows as Parquet in a folder that all executors share; `ids` has the same number of bytes in every row, so a
    file's rows are a matrix. Whole files are committed by Spark, so a lost executor leaves none behind."""
    rows.write.mode("overwrite").parquet(folder)


def read_matrix(spark: SparkSession, folder: str, window: int = 2048) -> Iterator[np.ndarray]:
    """The id rows of a folder that write_matrices wrote, in order of sequence_id, as arrays of `window` ids."""
    for row in spark.read.parquet(folder).orderBy("sequence_id").select("ids").toLocalIterator():
        yield np.frombuffer(row.ids, "<u4").reshape(window)
