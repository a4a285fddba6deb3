"""Packing documents into sequences of bounded length by a configuration linear program.

A document is its token ids and a closing id. One longer than a sequence is cut into full pieces, the first piece
taking the rest. Pieces are then only lengths, and their histogram, at most ``capacity`` numbers whatever the
input, is all that the driver sees.

The program: choose how often to use each configuration (a way to fill one sequence) so that every length is covered
and the fewest sequences are used. Multiplicative weights solve it. Each length has a price, its size times a weight that falls
exponentially with the part of its items covered. A knapsack dynamic program prices all configurations at once: its table
holds the dearest one, and for each length the dearest one with that length. In each round every length may be covered up to
the round's part of its items, by those configurations; what they hold falls in price. All rounds together
are the fractional solution, a mix of configurations that covers every length evenly, and wholly in the end. The prices also prove
a bound: no packing uses fewer sequences than all items' price by the price of the dearest configuration.

Its nearly full configurations are rounded down, and the fractions that are cut off are added up and spent on whole uses, one configuration after the
other. The same is done with what is left, as long as the program places much of it. The rest is filled greedily, each time with
the fullest configuration of the lengths that remain, taken as often as they last.

Placing is distributed. A piece's rank among those of its length comes from a rank within its task and the
counts of the tasks before it; the rank falls into one range of the plan, which names sequence and offset.
No length, however common, meets in one task.

Defined cases: a null or empty text is the closing id alone. Repeated rows and ids are documents of their own, a null
id stays null. Texts of any length are read whole. The name of a special token in a text is that token, as the tokenizer has it.
No rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import stored, texts_of
from wattlake.llm.wordcache import word_cache
from wattlake.llm.words import give_back, in_groups


# ---------------------------------------------------------------- pieces

def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0, id_col: str = "doc_id",
           text_col: str = "text", cache_bytes: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of every document; ``ids`` are little-endian 32-bit numbers.
    ``cache_bytes`` bounds what a worker keeps of words it has met; less takes more time."""
    rows = texts_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        cache = word_cache(tokenizer, cache_bytes)
        give_back()  # what other work of this process has left
        for batch in batches:
            for at, texts in in_groups(batch.column(1), 1 << 21):
                for row, ids, bounds in cache.encode(texts, closing):
                    yield _cut(batch.column(0), row + at, ids, bounds, capacity)
        if cache_bytes is not None and cache.size > cache_bytes:
            cache.forget()
        give_back()

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def _cut(doc_ids: pa.Array, rows: np.ndarray, ids: np.ndarray, bounds: np.ndarray, capacity: int) -> pa.RecordBatch:
    """The pieces of texts, whose ids lie one after the other: full ones, behind a first one that takes the rest."""
    sizes = np.diff(bounds)
    many = -(-sizes // capacity)
    owner = np.repeat(np.arange(len(sizes)), many)
    piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    first = sizes - (many - 1) * capacity
    start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
    places = np.concatenate([bounds[owner] + start, bounds[-1:]]) * 4
    if places[-1] >= 1 << 31:
        raise ValueError("a text of more than half a billion tokens")
    binary = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(ids)])
    return pa.RecordBatch.from_arrays(
        [doc_ids.take(pa.array(rows[owner])), pa.array(piece.astype(np.int32)), pa.array(start),
         pa.array(np.where(piece == 0, first[owner], capacity)), binary],
        ["doc_id", "piece", "start", "length", "ids"])


# ---------------------------------------------------------------- the linear program

FULL = 1 - 1 / 256  # of a sequence that a rounded configuration holds at least


@dataclass(frozen=True)
class Filling:
    """A configuration: lengths (largest first) that fill one sequence, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    times: int


@dataclass(frozen=True)
class Packing:
    """Fillings that hold all items, those the linear program gave before the others, and a proven least number of sequences."""

    fillings: list[Filling]
    by_program: int  # how many of the fillings the program gave
    bound: int

    def sequences(self) -> int:
        return sum(f.times for f in self.fillings)


def price_table(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(highest total price of lengths that fit into each room, one length of that choice or 0 for a place left empty): an
    unbounded knapsack by dynamic programming. ``prices[l]`` is the price of length l, 0 if there is none."""
    worth = np.where(prices > 0, prices, -1.0)
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(prices > 0)
    few = len(sizes) * 4 < capacity  # then only lengths that have a price are looked at
    priced, fitting = prices[sizes], np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        if few:
            n = fitting[room]
            if not n:
                continue
            total = best[room - sizes[:n]] + priced[:n]
        else:
            total = best[room - 1::-1] + worth[1:room + 1]
        pick = int(total.argmax())
        if total[pick] > best[room - 1]:
            best[room], taken[room] = total[pick], sizes[pick] if few else pick + 1
        else:
            best[room] = best[room - 1]
    return best, taken


def dearest(taken: np.ndarray, room: int) -> list[int]:
    """The lengths that a price table chose for a room."""
    found = []
    while room > 0:
        length = int(taken[room])
        if length:
            found.append(length)
        room -= length or 1
    return found


def dearest_of_all(taken: np.ndarray) -> list[list[int]]:
    """``dearest`` of every room, each made of that of a smaller one."""
    found: list[list[int]] = [[]]
    for room, length in enumerate(taken.tolist()[1:], 1):
        found.append([length, *found[room - length]] if length else found[room - 1])
    return found


_NONE = 1e-7  # of an item; less is rounding


def fractional(counts: np.ndarray, capacity: int, rounds: int = 48) -> tuple[dict[tuple[int, ...], float], float]:
    """(how often each configuration is used, lower bound) by multiplicative weights; no length is covered twice.

    Weights fall so slowly that all differences in one configuration are worth less than one token: the fullest ones
    are the dearest, and among these the ones whose lengths lag behind. After the last round, lengths wholly covered
    have no price any more, and rounds go on until all are; each of them completes at least one length."""
    sizes = np.flatnonzero(counts)
    pace = 0.5 / capacity
    covered = np.zeros(capacity + 1)
    used: dict[tuple[int, ...], float] = {}
    bound = 0.0
    round_ = 0
    while True:
        round_ += 1
        room = counts * min(1.0, round_ / rounds) - covered
        if round_ > rounds:
            sizes = np.flatnonzero(room > _NONE)
            if not len(sizes):
                return used, bound
        part = covered[sizes] / counts[sizes]
        prices = np.zeros(capacity + 1)
        prices[sizes] = sizes * np.exp(-pace * part)
        best, taken = price_table(prices, capacity)
        if round_ <= rounds:
            bound = max(bound, float((counts[sizes] * prices[sizes]).sum()) / best[capacity])
        fillings, room, covered = dearest_of_all(taken), room.tolist(), covered.tolist()  # read one by one from here
        for length in sizes[np.argsort(part, kind="stable")]:
            length = int(length)
            if room[length] <= _NONE:
                continue
            filling = [length, *fillings[capacity - length]]
            many: dict[int, int] = {}
            for x in filling:
                many[x] = many.get(x, 0) + 1
            times = min(room[x] / n for x, n in many.items())
            if times > 0:
                for x, n in many.items():
                    room[x] -= times * n
                    covered[x] += times * n
                key = tuple(sorted(filling, reverse=True))
                used[key] = used.get(key, 0.0) + times
        covered = np.array(covered)


def plan(counts: np.ndarray, capacity: int, rounds: int = 48) -> Packing:
    """Configurations that hold ``counts[l]`` items of each length l exactly. ``counts`` has capacity + 1 entries."""
    left = counts.astype(np.int64).copy()
    result: dict[tuple[int, ...], int] = {}

    def use(filling: tuple[int, ...], most: float) -> int:
        kinds, many = np.unique(filling, return_counts=True)
        times = int(min(most, (left[kinds] // many).min()))
        if times > 0:
            left[kinds] -= times * many
            result[filling] = result.get(filling, 0) + times
        return max(times, 0)

    full = int(left[capacity])
    use((capacity,), full)
    bound, worthwhile = 0.0, left.any()
    while worthwhile:
        solution, proven = fractional(left.astype(float), capacity, rounds)
        bound = bound or proven
        before, spare = int(left.sum()), 0.0
        # what leaves room is left to the next program and the greedy rest: single items may still fill it
        ordered = sorted(((f, x) for f, x in solution.items() if sum(f) >= capacity * FULL), key=lambda x: (-x[1], x[0]))
        for filling, times in ordered:
            use(filling, np.floor(times))
        for filling, times in ordered:  # the fractions add up to whole uses
            spare += times % 1
            if spare >= 1:
                spare -= use(filling, 1)
        worthwhile = 0.5 * before >= left.sum() > 0
    by_program = len(result)
    while left.any():
        use(tuple(_fullest(left, capacity)), np.inf)
    fillings = [Filling(lengths, times) for lengths, times in result.items()]
    return Packing(fillings, by_program, full + int(np.ceil(bound - 1e-6)))


def _fullest(left: np.ndarray, capacity: int) -> list[int]:
    """The largest length left, with lengths that fill the rest best; none more often than it is left."""
    sizes = np.flatnonzero(left)
    first = int(sizes[-1])
    rest = capacity - first
    # reach[r]: the last length of some choice of items that fills r exactly. Large lengths are tried first, so few
    # items are used and small ones stay for later gaps.
    reach = np.zeros(rest + 1, np.int64)
    filled = np.zeros(rest + 1, bool)
    filled[0] = True
    for size in sizes[::-1]:
        size = int(size)
        spare = int(left[size]) - (size == first)
        if size > rest or spare <= 0:
            continue
        for _ in range(min(spare, rest // size)):
            new = np.zeros(rest + 1, bool)
            new[size:] = filled[:-size]
            new &= ~filled
            if not new.any():
                break
            reach[new] = size
            filled |= new
        if filled[rest]:
            break
    room = int(np.flatnonzero(filled)[-1])
    found = [first]
    while room:
        found.append(int(reach[room]))
        room -= int(reach[room])
    return found


def ranges(fillings: list[Filling]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end of ranks, first sequence, offset): where the items of each length go."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for filling in fillings:
        offset = 0
        for length in filling.lengths:
            first = taken.get(length, 0)
            rows.append((length, first, first + filling.times, sequence, offset))
            taken[length] = first + filling.times
            offset += length
        sequence += filling.times
    return rows


# ---------------------------------------------------------------- operator

def pack(items: DataFrame, capacity: int = 2048, rounds: int = 48) -> DataFrame:
    """``items`` (any columns, among them ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Columns of these two names are replaced. The items are stored as they come and with their ranks: a task that made items and
    ranked them would hold two workers. Tasks get the plan, whose size is bounded by ``capacity`` and ``rounds`` alone; the counts
    of all tasks are joined by a shuffle, as they grow with the tasks.
    """
    kept = [c for c in items.columns if c not in ("sequence_id", "offset")]
    rows = stored(items.select(F.struct(*kept).alias("row"), F.col("length").cast("bigint").alias("length")), "items")
    rows = stored(_ranked(rows, capacity), "pieces")
    per_task = rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "ranks")
    counts = np.zeros(capacity + 1, np.int64)
    for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[r.length] = r.n
    ranked = (rows.join(starts.select("length", "task", "before").hint("shuffle_merge"), ["length", "task"])
              .select("row", "length", (F.col("before") + F.col("rank")).alias("rank")))
    return _placed(ranked, ranges(plan(counts, capacity, rounds).fillings)).select("row.*", "sequence_id", "offset")


def _placed(ranked: DataFrame, places: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Every row's rank among those of its length, looked up in the ranges of the plan."""
    table = np.array(sorted(places), np.int64).reshape(-1, 5)
    lengths, firsts, _, sequences, offsets = table.T
    edges = np.searchsorted(lengths, np.arange(lengths.max(initial=0) + 2))  # where the ranges of each length begin

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for some in np.split(order, cuts) if len(order) else []:
                a, b = edges[length[some[0]]], edges[length[some[0]] + 1]
                at = a + np.searchsorted(firsts[a:b], rank[some], side="right") - 1
                sequence[some] = sequences[at] + rank[some] - firsts[at]
                offset[some] = offsets[at]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)],
                                             ["row", "sequence_id", "offset"])

    row = ranked.schema["row"].dataType.simpleString()
    return ranked.mapInArrow(run, f"row {row}, sequence_id bigint, offset bigint")


def _ranked(rows: DataFrame, capacity: int) -> DataFrame:
    """Adds the task a row was read in and its rank among the rows of its length there."""
    def run(batches):
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            lengths = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(lengths) and not 1 <= lengths.min() <= lengths.max() <= capacity:
                raise ValueError(f"lengths must be 1 to {capacity}")
            order = np.argsort(lengths, kind="stable")
            ordered = lengths[order]
            rank = np.empty(len(lengths), np.int64)
            rank[order] = np.arange(len(lengths)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.full(len(lengths), task, np.int32)), pa.array(rank)],
                ["row", "length", "task", "rank"])

    row = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {row}, length bigint, task int, rank bigint")
