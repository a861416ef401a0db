"""Words of a column of texts as flat arrays, for operators that work on whole Arrow batches.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``; no byte of a longer UTF-8 character is one of
these, so words by bytes are words by characters. Everything is cut, numbered and joined by array operations; there is no
Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 8 << 20  # bytes of text that are worked on at once; a longer text is a chunk of its own

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@dataclass
class Words:
    """Words of ``len(first) - 1`` texts: word ``i`` is ``data[ends[i]:ends[i + 1]]``, and the words of text
    ``t`` are those from ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def array(self) -> pa.Array:
        """The words as an Arrow array that shares their bytes."""
        buffers = [None, pa.py_buffer(self.ends), pa.py_buffer(self.data)]
        return pa.Array.from_buffers(pa.large_binary(), len(self), buffers)

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number per word, equal for equal words, and the distinct words by number."""
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary

    def text_of(self) -> np.ndarray:
        """The number of the text that each word stands in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self, keep: np.ndarray | None = None) -> pa.Array:
        """Each text's words (only those marked in ``keep``) joined by one space."""
        words, first = self.array(), self.first
        if keep is not None:
            words = words.filter(pa.array(keep))
            first = np.concatenate([[0], np.cumsum(keep)])[first]
        lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), words)
        return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string())


def cut(texts: pa.Array) -> Words:
    """The words of each text; NULL has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return Words(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64))
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = ~_BLANK[raw]
    edge = np.zeros(size + 1, dtype=bool)  # places where a text begins or ends
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    lengths = np.concatenate([[0], np.cumsum(ends - begins + 1)]).astype(np.int64)
    return Words(raw[solid], lengths, np.searchsorted(begins, offsets).astype(np.int64))


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, at least one row."""
    lengths = pc.binary_length(batch.column(text).fill_null("")).to_numpy(zero_copy_only=False)
    if not len(lengths):
        return
    part = (np.cumsum(lengths) - lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)
