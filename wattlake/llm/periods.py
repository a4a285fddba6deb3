"""Periodic runs of words: a phrase that follows itself at least three times, found at all lengths by block convolution.

A run with period q and length of at least three periods holds a whole block of B <= q words, placed at a multiple of B, whose
next copy lies q words further. So for every power of two B the text is cut into blocks, and each block is compared with the
window behind it at all distances from B to 2 B - 1 at once: the sum of squared differences is a convolution, computed
exactly by a number-theoretic transform, and it is zero just where the block occurs again. The smallest block also takes the
distances below it. Words are numbers for this, reduced so that no sum can pass the modulus; a zero between different
words that this may cause does not survive the extension.

Blocks next to each other with the same distance are put together, and extended on both sides to where words a
distance apart differ. Extension compares fingerprints of prefixes by bisection, which can only be too long, and then the words.

Skipped, as no result can come of it: blocks with a word that does not occur again within the window, and
occurrences inside a run of a smaller period, which have a multiple of that period as distance.

Texts of a task are searched in groups, each followed by a word of its own, so that no run goes from one into the next.

Defined cases: a null or empty text, or one of blanks, has no words and no runs, and collapses to the empty text. Repeated rows
and ids are texts of their own, a null id stays null. Texts of any length are searched whole. No rows give no rows.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import let, texts_of
from wattlake.llm.words import Words, in_groups

PRIME, GENERATOR = 3 * 2**30 + 1, 5  # transforms of up to 2^30 numbers
_P = np.uint64(PRIME)
_HASH_PRIME, _HASH_BASE = np.uint64(2**32 - 5), 1_000_003_579
CHUNK = 1 << 18  # numbers transformed at once

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, end, period


# ---------------------------------------------------------------- transform

_roots: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: int, n: int, prime: np.uint64) -> np.ndarray:
    """base^0 ... base^(n-1)."""
    found = np.ones(1, np.uint64)
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), int(prime))) % prime])
    return found[:n]


def _roots_of(n: int, inverse: bool) -> np.ndarray:
    if (n, inverse) not in _roots:
        root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        _roots[n, inverse] = _powers(pow(root, -1, PRIME) if inverse else root, max(1, n // 2), _P)
    return _roots[n, inverse]


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of every row; their length is a power of two. Not scaled."""
    m, n = rows.shape
    roots, x, half, stride = _roots_of(n, inverse), rows, n // 2, 1
    while half:
        pairs = x.reshape(m, 2, half, stride)
        a, b = pairs[:, 0], pairs[:, 1]
        out = np.empty((m, half, 2, stride), np.uint64)
        total, less = a + b, a - b
        out[:, :, 0] = np.minimum(total, total - _P)  # unsigned: what falls below zero is large
        out[:, :, 1] = np.minimum(less, less + _P) * roots[::stride][:half, None] % _P
        x, half, stride = out, half // 2, stride * 2
    return x.reshape(m, n)


def correlations(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """sum over i of block[i] * window[i + s], for each row and every s that leaves the block in its window."""
    size, reach = blocks.shape[1], windows.shape[1]
    n = 1 << (reach - 1).bit_length()
    turned = np.zeros((len(blocks), n), np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, n - size + 1:] = blocks[:, :0:-1]
    padded = np.zeros((len(blocks), n), np.uint64)
    padded[:, :reach] = windows
    product = transform(transform(turned) * transform(padded) % _P, inverse=True)
    return (product * np.uint64(pow(n, -1, PRIME)) % _P)[:, :reach - size + 1]


def occurrences(words: np.ndarray, size: int, blocks: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) wherever a block of ``size`` words has zero mismatch, of reduced words, with the words ``low`` to
    ``high - 1`` further."""
    # squares of reduced words add up to less than the modulus: the convolution is exact
    reduced = (words % isqrt((PRIME - 1) // size)).astype(np.uint64)
    reach = high - low - 1 + size
    reduced = np.concatenate([reduced, np.zeros(high + size, np.uint64)])
    at_once = max(1, CHUNK // (2 * reach))
    found, distances = [], []
    for i in range(0, len(blocks), at_once):
        some = blocks[i:i + at_once]
        mine = reduced[(some * size)[:, None] + np.arange(size)]
        window = reduced[(some * size + low)[:, None] + np.arange(reach)]
        squares = np.zeros((len(some), reach + 1), np.uint64)
        np.cumsum(window * window, axis=1, out=squares[:, 1:])
        both = (mine * mine).sum(axis=1)[:, None] + squares[:, size:] - squares[:, :-size]
        row, shift = np.nonzero(both == 2 * correlations(mine, window))
        found.append(some[row])
        distances.append(shift + low)
    return np.concatenate(found), np.concatenate(distances)


# ---------------------------------------------------------------- extension

class _Prefixes:
    """Fingerprints of stretches, to bisect for the place where words a distance apart differ. Equal stretches have equal
    fingerprints, so what is found is never too short."""

    def __init__(self, words: np.ndarray):
        self.powers = _powers(_HASH_BASE, len(words) + 1, _HASH_PRIME)
        mixed = words.astype(np.uint64) * np.uint64(2_654_435_761) % _HASH_PRIME
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:-1] % _HASH_PRIME) % _HASH_PRIME])

    def equal(self, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Whether words a to b - 1 seem to be those ``distance`` further."""
        near = (self.sums[b] + _HASH_PRIME - self.sums[a]) % _HASH_PRIME
        far = (self.sums[b + distance] + _HASH_PRIME - self.sums[a + distance]) % _HASH_PRIME
        return near * self.powers[distance] % _HASH_PRIME == far

    def reach(self, at: np.ndarray, distance: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words after ``at`` (before it, if ``step`` is -1) seem equal to those ``distance`` further, up to ``most``."""
        good, bad = np.zeros_like(at), most + 1
        while True:
            open_ = bad - good > 1
            if not open_.any():
                return good
            middle = np.where(open_, (good + bad) // 2, good)
            a, b = (at, at + middle) if step > 0 else (at - middle, at)
            same = self.equal(a, b, distance)
            good, bad = np.where(open_ & same, middle, good), np.where(open_ & ~same, middle, bad)


def _inside(start: np.ndarray, end: np.ndarray, runs: Runs) -> np.ndarray:
    """Whether a single run holds all words from start to end - 1."""
    order = np.argsort(runs[0], kind="stable")
    firsts, furthest = runs[0][order], np.maximum.accumulate(runs[1][order])
    at = np.searchsorted(firsts, start, side="right") - 1
    return (at >= 0) & (furthest[np.maximum(at, 0)] >= end)


def _stretches(words: np.ndarray, start: int, end: int, distance: int):
    """Maximal parts of start to end - 1 in which words are those ``distance`` further."""
    same = words[start:end] == words[start + distance:end + distance]
    if same.all():
        return [(start, end)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    return [(start + int(a), start + int(b)) for a, b in zip(edges[::2], edges[1::2])]


def find_runs(words: np.ndarray, longest: int, least: int = 24) -> Runs:
    """All maximal runs of three periods or more, and of ``least`` words or more, with their smallest periods, by start and
    period. ``longest`` bounds their length."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    gap = np.full(n, n + 1)  # to the next place of the same word
    same = words[order[1:]] == words[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    size, low = 1, 1
    while 3 * (2 * size) - 2 <= least:
        size *= 2
    furthest = gap[:n // size * size].reshape(-1, size).max(axis=1)
    known: dict[tuple[int, int], int] = {}
    runs: Runs = tuple(np.zeros(0, np.int64) for _ in range(3))
    prefixes = None
    while len(furthest) and longest >= max(least, 3 * low):
        high = 2 * size
        blocks = np.flatnonzero(furthest < high)
        if len(blocks) and len(runs[0]):
            blocks = blocks[~_inside(blocks * size, blocks * size + size + high - 1, runs)]
        if len(blocks):
            prefixes = prefixes or _Prefixes(words)
            for start, end, period in _runs_at(words, prefixes, size, blocks, low, high, runs, least):
                known.setdefault((start, end), period)  # periods rise, so a multiple of a period comes too late
            keys = list(known)
            runs = (np.array([k[0] for k in keys], np.int64), np.array([k[1] for k in keys], np.int64),
                    np.array(list(known.values()), np.int64))
        low, size = high, high
        pairs = furthest[:len(furthest) // 2 * 2]
        furthest = np.maximum(pairs[::2], pairs[1::2])
    order = np.lexsort((runs[2], runs[0]))
    return tuple(part[order] for part in runs)


def _runs_at(words, prefixes, size, blocks, low, high, runs, least) -> list[tuple[int, int, int]]:
    """(start, end, distance), distances rising, of the runs that occurrences of these blocks belong to."""
    n = len(words)
    block, distance = occurrences(words, size, blocks, low, high)
    fits = block * size + size + distance <= n
    block, distance = block[fits], distance[fits]
    fits = prefixes.equal(block * size, block * size + size, distance)
    if len(runs[0]):
        fits &= ~_inside(block * size, block * size + size + distance, runs)
    block, distance = block[fits], distance[fits]
    if not len(block):
        return []
    order = np.lexsort((block, distance))
    block, distance = block[order], distance[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(block) != 1) | (np.diff(distance) != 0)]))
    last = np.concatenate([new[1:], [len(block)]]) - 1
    start, end, distance = block[new] * size, (block[last] + 1) * size, distance[new]
    # The block before and the one behind do not match, so less than a block is missing on each side.
    start = start - prefixes.reach(start, distance, np.minimum(size, start), -1)
    end = end + prefixes.reach(end, distance, np.minimum(size, n - distance - end), 1)
    long = end + distance - start >= np.maximum(least, 3 * distance)
    return [(a, b + d, d) for s, e, d in zip(start[long].tolist(), end[long].tolist(), distance[long].tolist())
            for a, b in _stretches(words, s, e, d) if b + d - a >= max(least, 3 * d)]


# ---------------------------------------------------------------- operator

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of every text, as (start, length, period) in words by start and
    period, and the text with one period of each run, its words joined by single blanks. Narrow, nothing is shuffled."""
    rows = texts_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, texts in in_groups(batch.column(1)):
                yield _collapsed(batch.column(0).slice(at, len(texts)), Words(texts), least)

    return rows.mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def _collapsed(doc_ids: pa.Array, words: Words, least: int) -> pa.RecordBatch:
    counts = words.counts()
    n, texts = len(words), len(counts)
    # a word of its own behind each text
    spaced = np.empty(n + texts, np.int64)
    place = np.arange(n) + words.owner
    ends = words.begin[1:] + np.arange(texts)
    spaced[place] = words.ids
    spaced[ends] = np.arange(texts) + n
    start, end, period = find_runs(spaced, int(counts.max(initial=0)), least)
    owner = np.searchsorted(ends, start)
    dropped = np.zeros(n + texts + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    kept = np.cumsum(dropped)[place] == 0
    found = pa.StructArray.from_arrays(
        [pa.array(start - owner - words.begin[owner]), pa.array(end - start), pa.array(period)], fields=list(RUN))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=texts))]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), found), words.joined(kept)],
        ["doc_id", "n_words", "runs", "collapsed"])


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, compared exactly; the first of equal ones. Null without runs."""
    better = lambda best, run: F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]),
                                      run).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def repeated_tail(text: Column, start, period) -> Column:
    """``text`` in which every word from ``start(n)`` on is taken from the ``period(n, start)`` words that begin there, n being
    its number of words; null if there are none."""
    def tail(words: Column, n: Column) -> Column:
        places = F.sequence(F.lit(0).cast("bigint"), n - 1)
        return let(start(n), lambda a: let(period(n, a), lambda p: F.transform(
            places, lambda i: F.element_at(words, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int")))))

    found = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    repeated = let(found, lambda words: let(F.size(words).cast("bigint"), lambda n: F.when(n > 0, tail(words, n))))
    return F.array_join(repeated, " ")
