"""Words of many texts at once, found on their UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that one step takes; a longer text is a step of its own.
STEP_BYTES = 4 << 20

_CODES = np.arange(256)
# What ends a word `[^\x20\x09-\x0D]+`.
SPACES = (_CODES == 0x20) | ((_CODES >= 0x09) & (_CODES <= 0x0D))
# What ends a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing A-Z.
NOT_ALPHANUMERIC = ~(
    ((_CODES >= 0x30) & (_CODES <= 0x39)) | ((_CODES >= 0x61) & (_CODES <= 0x7A)) | (_CODES >= 0x80)
)
LOWER = np.where((_CODES >= 0x41) & (_CODES <= 0x5A), _CODES + 32, _CODES).astype("uint8")


@dataclass
class Words:
    """``data`` holds all words, each followed by one space.

    Word ``i`` is ``data[starts[i] : starts[i] + lengths[i]]``; text ``d`` has the
    words from ``bounds[d]`` to ``bounds[d + 1]``.
    """

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def encoded(self) -> pa.DictionaryArray:
        """Equal words get equal numbers; the dictionary's words end in a space."""
        offsets = np.append(self.starts, len(self.data)).astype("int64")
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data))]
        return pa.Array.from_buffers(pa.large_binary(), len(self), buffers).dictionary_encode()

    def joined(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last - 1`` with one space between them."""
        if first >= last:
            return b""
        end = self.starts[last - 1] + self.lengths[last - 1]
        return self.data[self.starts[first] : end].tobytes()

    def kept(self, first: int, last: int, keep: np.ndarray) -> bytes:
        """Like ``joined``, with those words alone that ``keep`` marks."""
        if not keep.any():
            return b""
        begin = self.starts[first]
        end = self.starts[last - 1] + self.lengths[last - 1] + 1
        mask = np.repeat(keep, self.lengths[first:last] + 1)
        return self.data[begin:end][mask].tobytes()[:-1]


def split_words(column: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    """The words of a string column; a null text has none."""
    texts = [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]
    # A line feed separates words in every class used here.
    data = np.frombuffer(b"\n".join([*texts, b""]), "uint8")
    ends_of_texts = np.cumsum(np.fromiter(map(len, texts), "int64", len(texts)) + 1)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = change[::2], change[1::2]
    bounds = np.concatenate([[0], np.searchsorted(starts, ends_of_texts)])
    lengths = ends - starts
    inside[ends] = True
    data = np.where(inside, data, 0)
    data[ends] = 0x20
    return Words(data[inside], np.cumsum(lengths + 1) - lengths - 1, lengths, bounds)


def steps(batch: pa.RecordBatch, text_col: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``limit`` bytes of text."""
    sizes = pc.binary_length(batch.column(text_col).cast(pa.large_binary()))
    total = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype("int64"))
    first = 0
    while first < batch.num_rows:
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + limit, "right")))
        yield batch.slice(first, last - first)
        first = last
