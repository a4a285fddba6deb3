"""Words of many texts at once: everything between blanks, tabs and line ends, found in the bytes of an Arrow column.

The separators are single bytes that are part of no other character, so texts need not be decoded to be split.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANKS = b" \t\n\x0b\x0c\r"
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True


class Words:
    """The words of some texts. ``data`` holds all texts, a line end after each; ``bounds`` says where each begins.

    ``first`` and ``past`` are the bytes of every word, ``owner`` is its text, and ``ids`` are numbers that are equal for equal
    words of these texts. ``begin`` is the number of the first word of each text."""

    def __init__(self, texts: pa.LargeStringArray, numbered: bool = True):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = np.insert(data, offsets[1:], 10)
        self.bounds = offsets + np.arange(len(offsets))
        blank = _IS_BLANK[self.data]
        turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            turns = np.concatenate([[0], turns])
        self.first, self.past = turns[::2], turns[1::2]
        self.owner = np.searchsorted(self.bounds, self.first, side="right") - 1
        self.begin = np.searchsorted(self.first, self.bounds)
        self.blank = blank
        self.ids = self._ids() if numbered else None

    def _ids(self) -> np.ndarray:
        places = np.concatenate([[0], np.cumsum(self.past - self.first)]).astype(np.int64)
        letters = self.data[~self.blank]
        words = pa.Array.from_buffers(pa.large_binary(), len(self.first), [None, pa.py_buffer(places), pa.py_buffer(letters)])
        return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def __len__(self) -> int:
        return len(self.first)

    def counts(self) -> np.ndarray:
        return np.diff(self.begin)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many bytes of each text are marked."""
        total = np.concatenate([[0], np.cumsum(marks)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def joined(self, kept: np.ndarray) -> pa.StringArray:
        """Each text made of its kept words alone, one blank between two."""
        edges = np.zeros(len(self.data) + 1, np.int8)
        edges[self.first[kept]] += 1
        edges[self.past[kept]] -= 1
        taken = np.cumsum(edges[:-1]).astype(bool)
        places = np.flatnonzero(kept)
        follows = np.flatnonzero(np.diff(self.owner[places]) == 0)  # a kept word with another one behind it
        between = self.past[places[follows]]
        out = self.data.copy()
        out[between] = 32
        taken[between] = True
        total = np.concatenate([[0], np.cumsum(taken)])
        return pa.LargeStringArray.from_buffers(len(self.bounds) - 1, pa.py_buffer(total[self.bounds].astype(np.int64)),
                                                pa.py_buffer(out[taken])).cast(pa.string())


def in_groups(texts: pa.Array, most: int = 1 << 22, rows: int = 512) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """(number of the first text, texts) in groups of at most ``rows`` texts and ``most`` bytes, or of one text if it is longer;
    nulls are empty. No more than a group is copied."""
    for first in range(0, len(texts), rows):
        some = texts.slice(first, rows).cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(some.buffers()[1], np.int64)[some.offset:some.offset + len(some) + 1]
        at = 0
        while at < len(some):
            past = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
            yield first + at, some.slice(at, past - at)
            at = past


def give_back() -> None:
    """Return memory that this process has freed but still holds, as workers live on between stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
