"""Words of whole blocks of texts as Arrow arrays, and the blocks that inverted indexes are built from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bits of a block id below the partition's number.
LOCAL_BITS = 31

# A to Z in lower case; a word is a run of the digits, these letters and whatever is not ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[0x80:] = True


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all binary texts after each other, and how many each text has. A null text has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = _LOWER[np.frombuffer(data, np.uint8)[at[0] : at[-1]]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    inside = _IN_WORD[held]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = at[:-1][at[1:] > at[:-1]]  # a word ends where its text does
    begins[first] = inside[first]
    counts = np.diff(np.searchsorted(np.flatnonzero(begins), at))
    starts = np.flatnonzero(begins[inside])
    data = held[inside]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[starts, len(data)].astype(np.int64)), pa.py_buffer(data)])
    return words, counts


def in_blocks(batches: Iterator[pa.RecordBatch], step: int = BLOCK_BYTES, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of a task in runs with about `step` bytes of text; a row is never cut."""
    for batch in batches:
        sizes = np.cumsum([0, *(x or 0 for x in pc.binary_length(batch.column(column)).to_pylist())])
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + step, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


def block_ids() -> Callable[[], int]:
    """Gives ids that no other task gives: numbers that go on from the partition's."""
    own = iter(range(TaskContext.get().partitionId() << LOCAL_BITS, 1 << 62))
    return lambda: next(own)
