"""Encoding into the pieces of a given vocabulary, best segmentations first, and decoding.

Pieces and their scores come from a public SentencePiece model; nothing is trained. A blank becomes ``▁`` and one is put in
front of the text. Of all ways to cover the text by pieces, the n with the highest sums of scores are given.

The lattice of a word is searched in two passes: forward Viterbi gives the best score of every prefix, and a backward
A* search from the end takes that score as its heuristic. It is exact, so segmentations come out in order. The best way on from
a place costs nothing beyond its heuristic and is followed at once, down to the start; edges that leave it wait in
the queue, of which only as many are kept as segmentations are still wanted. Edges are found anew for each pass and never held
for a whole long word, so memory is a few bytes for each character.

No piece has a blank inside, and none holds a line end, so a text's lattice is a chain of its words' lattices. A text's n best
are merged from its words': besides the best, only the n - 1 words whose second choice costs least can change, and these
alone are searched for more. The words of many texts are found in their bytes and numbered at once; the best of a word is found
once and kept, up to a bound in bytes, in each worker.

A character without a piece, and ``▁`` itself, is written by the pieces of its UTF-8 bytes. Decoding is exact: it gives back any text.

Defined cases: a null text counts as empty; an empty text has one segmentation without pieces. A text with fewer than n
segmentations gives as many rows as it has. Every row of ``docs`` is encoded, repeats and null ids included. Texts and words of any
length are searched whole.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import texts_of
from wattlake.llm.words import in_groups

BLANK = "▁"
CACHED_BYTES = 160 << 20  # of words and their ids, with what Python adds; then the cache starts anew
_EACH = 200
HELD = 4096  # characters of a word whose edges are held in a list
UNUSABLE = -1e8  # scores at or below mark pieces that the model itself never gives
_FAR = -1 << 60
_NEVER = np.int64(1 << 60)

Edge = tuple[int, tuple[int, int, bytes]]  # last character, (length, score, ids)
Word = tuple[int, bytes, int | None]  # best score, its ids, and what the second segmentation costs beyond it


class _Edges:
    """All edges of a word's lattice by their ends, found anew each time. ``odd`` marks the places that only bytes can spell."""

    def __init__(self, vocabulary: Vocabulary, word: str, literal: frozenset[int]):
        self.vocabulary, self.word, self.literal = vocabulary, word, sorted(literal)
        self.odd = bytearray(c not in vocabulary.singles for c in word)
        for place in literal:
            self.odd[place] = 1

    def __iter__(self) -> Iterator[Edge]:
        word, odd, literal, done = self.word, self.odd, self.literal, 0
        for edge in self.vocabulary.automaton.iter(word):
            last, (length, _, _) = edge
            yield from self._spelled(done, last + 1)
            done = last + 1
            start = last + 1 - length
            if not odd[start]:
                at = bisect_left(literal, start)
                if at == len(literal) or literal[at] > last:
                    yield edge
        yield from self._spelled(done, len(word))

    def _spelled(self, start: int, end: int) -> Iterator[Edge]:
        place = self.odd.find(1, start, end)
        while place >= 0:
            yield place, (1, *self.vocabulary.spelled(self.word[place]))
            place = self.odd.find(1, place + 1, end)


class _Plain:
    """The same for a word in which every character is a piece."""

    def __init__(self, vocabulary: Vocabulary, word: str):
        self.vocabulary, self.word = vocabulary, word

    def __iter__(self) -> Iterator[Edge]:
        return iter(self.vocabulary.automaton.iter(self.word))


class Vocabulary:
    """Pieces, scores and word cache of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.edges: dict[str, tuple[int, bytes]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece, score = model.id_to_piece(i), model.get_score(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            else:
                self.bytes_of.append(piece.replace(BLANK, " ").encode())
                if not (model.is_control(i) or model.is_unknown(i)) and (score > UNUSABLE or piece == BLANK):
                    self.edges[piece] = round(score), array("I", [i]).tobytes()
        if any("\n" in p or BLANK in p[1:] for p in self.edges):
            raise ValueError("pieces must not hold line ends or inner blanks")
        self.unknown = min((s for s, _ in self.edges.values() if s > UNUSABLE), default=0) - 10
        if BLANK in self.edges:  # a blank on its own is a last resort, like a character without a piece
            self.edges[BLANK] = max(self.edges[BLANK][0], self.unknown), self.edges[BLANK][1]
        self.singles = frozenset(p for p in self.edges if len(p) == 1)
        self.automaton = ahocorasick.Automaton()
        for piece, (score, ids) in self.edges.items():
            self.automaton.add_word(piece, (len(piece), score, ids))
        self.automaton.make_automaton()
        self.letters = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.letter_ends = np.concatenate([[0], np.cumsum([len(b) for b in self.bytes_of])])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.scores, self.seconds = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.choices: dict[tuple[bytes, int], list[tuple[int, np.ndarray]]] = {}
        self.size = 0

    # ------------------------------------------------------------ words

    def spelled(self, character: str) -> tuple[int, bytes]:
        """A character by the pieces of its bytes."""
        return self.unknown, array("I", [self.byte_ids[b] for b in character.encode()]).tobytes()

    def _lattice(self, word: str, literal: frozenset[int]) -> Iterable[Edge]:
        """Edges by their ends. ``literal`` are places of ``▁`` that are no blanks."""
        plain = not literal and self.singles.issuperset(word)
        edges = _Plain(self, word) if plain else _Edges(self, word, literal)
        return edges if len(word) > HELD else list(edges)

    def _forward(self, size: int, edges: Iterable[Edge]) -> tuple[array, array]:
        """(best score of each prefix, length of the last piece of that best)."""
        if size <= HELD:
            ahead, via = [_FAR] * (size + 1), [0] * (size + 1)
        else:
            ahead, via = array("q", [_FAR]) * (size + 1), array("H", [0]) * (size + 1)
        ahead[0] = 0
        for last, (length, score, _) in edges:
            total = ahead[last + 1 - length] + score
            if total > ahead[last + 1]:
                ahead[last + 1], via[last + 1] = total, length
        return ahead, via

    @staticmethod
    def _on_path(size: int, at: int, via: array) -> bytearray:
        """The places where the pieces of the best way to ``at`` end."""
        on = bytearray(size + 1)
        while at:
            on[at] = 1
            at -= via[at]
        return on

    def best(self, word: str, literal: frozenset[int] = frozenset()) -> Word:
        """The best segmentation, and how much the second costs beyond it: the least loss of an edge that leaves the best
        way."""
        edges, size = self._lattice(word, literal), len(word)
        if size <= HELD:
            return self._best_of(size, edges)
        ahead, via = self._forward(size, edges)
        on, loss = self._on_path(size, size, via), 1 << 60
        for last, (length, score, _) in edges:
            end = last + 1
            if on[end] and length != via[end]:
                more = ahead[end] - ahead[end - length] - score
                if more < loss:
                    loss = more
        return ahead[size], self._ids(word, literal, via, size, 0), loss if loss < 1 << 50 else None

    @staticmethod
    def _best_of(size: int, edges: list[Edge]) -> Word:
        """The same from edges in a list: the best way is kept as edges."""
        ahead, via = [_FAR] * (size + 1), [None] * (size + 1)
        ahead[0] = 0
        for last, edge in edges:
            total = ahead[last + 1 - edge[0]] + edge[1]
            if total > ahead[last + 1]:
                ahead[last + 1], via[last + 1] = total, edge
        on, at, ids = [None] * (size + 1), size, []
        while at:
            on[at] = edge = via[at]
            ids.append(edge[2])
            at -= edge[0]
        loss = 1 << 60
        for last, edge in edges:
            mine = on[last + 1]
            if mine is not None and mine is not edge:
                more = ahead[last + 1] - ahead[last + 1 - edge[0]] - edge[1]
                if more < loss:
                    loss = more
        ids.reverse()
        return ahead[size], b"".join(ids), loss if loss < 1 << 50 else None

    def _ids(self, word: str, literal: frozenset[int], via: array, end: int, start: int) -> bytes:
        """The ids of the best way from one of its places, ``start``, to another, ``end``."""
        ends, found = array("I"), bytearray()
        while end > start:
            ends.append(end)
            end -= via[end]
        for end in reversed(ends):
            found += self._piece(word, literal, end - via[end], end)
        return bytes(found)

    def _piece(self, word: str, literal: frozenset[int], start: int, end: int) -> bytes:
        edge = self.edges.get(word[start:end]) if start not in literal else None
        return edge[1] if edge else self.spelled(word[start])[1]

    def search(self, word: str, n: int, literal: frozenset[int] = frozenset()) -> list[tuple[int, bytes]]:
        """The n best segmentations as (cost beyond the best, ids), by A* from the end."""
        edges, size = self._lattice(word, literal), len(word)
        ahead, via = self._forward(size, edges)
        found: list[tuple[int, bytes]] = []
        # cost, the place reached, and the ids from there to the end
        queue: list[tuple[int, int, bytes]] = [(0, size, b"")]
        while queue and len(found) < n:
            cost, at, behind = queue.pop(0)
            found.append((cost, self._ids(word, literal, via, at, 0) + behind))
            wanted = n - len(found) - len([1 for q in queue if q[0] <= cost])
            if wanted <= 0:
                continue
            on = self._on_path(size, at, via)
            leaving = heapq.nsmallest(wanted, (
                (cost + ahead[last + 1] - ahead[last + 1 - length] - score, last + 1, length, ids)
                for last, (length, score, ids) in edges
                if on[last + 1] and length != via[last + 1] and ahead[last + 1 - length] > _FAR // 2))
            queue += [(total, end - length, ids + self._ids(word, literal, via, at, end) + behind)
                      for total, end, length, ids in leaving]
            queue = heapq.nsmallest(n - len(found), queue)
        return found

    def _numbers(self, units: list[bytes]) -> np.ndarray:
        """The numbers of units; the best segmentations of new ones are found."""
        known = self.known
        new = [u for u in units if u not in known]
        if new:
            found = [self.best(*_marked(u)) if u != b"\n" else (*self.spelled("\n"), None) for u in new]
            known.update(zip(new, range(len(known), len(known) + len(new))))
            ids = b"".join([f[1] for f in found])
            self.scores = np.concatenate([self.scores, np.array([f[0] for f in found], np.int64)])
            self.seconds = np.concatenate([self.seconds, np.array([_NEVER if f[2] is None else f[2] for f in found], np.int64)])
            self.pool = np.concatenate([self.pool, np.frombuffer(ids, np.uint32)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(f[1]) // 4 for f in found])])
            self.size += len(ids) + sum(map(len, new)) + _EACH * len(new)
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _choices(self, unit: bytes, n: int) -> list[tuple[int, np.ndarray]]:
        key = (unit, n)
        if key not in self.choices:
            self.choices[key] = [(cost, np.frombuffer(ids, np.uint32)) for cost, ids in self.search(*_with_n(unit, n))]
            self.size += sum(4 * len(ids) + _EACH for _, ids in self.choices[key])
        return self.choices[key]

    # ------------------------------------------------------------ texts

    def encode(self, texts: pa.LargeStringArray, n: int) -> Iterator[tuple[int, int, int, np.ndarray, bytes]]:
        """(number of the text, rank, score, ids, the bytes they spell) of the n best segmentations of each text."""
        if self.size > CACHED_BYTES:
            self.forget()
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], 32)  # a blank in front of each text
        bounds = offsets + np.concatenate([[0], np.cumsum(filled)])
        # a unit begins at a blank, at a line end, and behind a line end
        begins = (data == 32) | (data == 10)
        begins[1:] |= data[:-1] == 10
        places = np.append(np.flatnonzero(begins), len(data))
        spelled = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [
            None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        words = spelled.dictionary.to_pylist()
        numbers = self._numbers(words)
        kinds = spelled.indices.to_numpy(zero_copy_only=False)
        units = numbers[kinds]
        ids, ends = _gathered(self.pool, self.ends, units)
        letters, letter_ends = _gathered(self.letters, self.letter_ends, ids)
        ends, letter_ends = np.concatenate([[0], ends]), np.concatenate([[0], letter_ends])
        scores, seconds = self.scores[units], self.seconds[units]
        edges = np.searchsorted(places[:-1], bounds)
        totals = np.concatenate([[0], np.cumsum(scores)])
        for text in range(len(texts)):
            a, b = edges[text], edges[text + 1]
            score = int(totals[b] - totals[a])
            mine, whole = ids[ends[a]:ends[b]], letters[letter_ends[ends[a]]:letter_ends[ends[b]]]
            yield text, 1, score, mine, whole.tobytes()
            if n < 2:
                continue
            # Every second choice of one word alone is among the candidates, so no cheaper mix is missed.
            mixes: list[tuple[int, tuple[tuple[int, int], ...]]] = [(0, ())]
            for unit in _loosest(seconds[a:b], n - 1):
                choices = self._choices(words[kinds[a + unit]], n)
                mixes = heapq.nsmallest(n, [(cost + more, changes + ((unit, c),) * (c > 0)) for cost, changes in mixes
                                            for c, (more, _) in enumerate(choices)])
            for rank, (cost, changes) in enumerate(mixes[1:], 2):
                parts, spelling, at = [], [], a
                for unit, c in sorted(changes):
                    other = self._choices(words[kinds[a + unit]], n)[c][1]
                    parts += [ids[ends[at]:ends[a + unit]], other]
                    spelling += [letters[letter_ends[ends[at]]:letter_ends[ends[a + unit]]], self._spelling(other)]
                    at = a + unit + 1
                parts.append(ids[ends[at]:ends[b]])
                spelling.append(letters[letter_ends[ends[at]]:letter_ends[ends[b]]])
                yield text, rank, score - cost, np.concatenate(parts), b"".join(spelling)

    def nbest(self, text: str, n: int) -> list[tuple[int, int, bytes]]:
        """(score, number of pieces, ids) of the n best segmentations of a text."""
        found = self.encode(pa.array([text], pa.large_string()), n)
        return [(score, len(ids), ids.tobytes()) for _, _, score, ids, _ in found]

    def _spelling(self, ids: np.ndarray) -> np.ndarray:
        return _gathered(self.letters, self.letter_ends, ids)[0]

    def decode(self, ids: bytes) -> str:
        return _without_blank(self._spelling(np.frombuffer(ids, np.uint32)).tobytes()).decode("utf-8", "replace")


def _gathered(pool: np.ndarray, ends: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretches of a pool one after the other, where each one ends); stretch i is from ends[i] to ends[i + 1]."""
    past = np.cumsum(ends[items.astype(np.int64) + 1] - ends[items])
    out = np.empty(past[-1] if len(past) else 0, pool.dtype)
    for at in range(0, len(items), 1 << 15):  # in parts, as places take more memory than what is gathered
        some = items[at:at + (1 << 15)].astype(np.int64)
        first = ends[some]
        sizes, begin = ends[some + 1] - first, past[at - 1] if at else 0
        stop = past[at + len(some) - 1]
        places = np.arange(begin, stop) + np.repeat(first - past[at:at + len(some)] + sizes, sizes)
        out[begin:stop] = pool[places]
    return out, past


def _loosest(seconds: np.ndarray, most: int) -> list[int]:
    """The words whose second choice costs least, the first of equal ones."""
    if len(seconds) > most:
        bar = np.partition(seconds, most - 1)[most - 1]
        below = np.flatnonzero(seconds < bar)
        chosen = np.concatenate([below, np.flatnonzero(seconds == bar)[:most - len(below)]])
    else:
        chosen = np.arange(len(seconds))
    return [int(i) for i in chosen if seconds[i] < _NEVER]


def _marked(unit: bytes) -> tuple[str, frozenset[int]]:
    """A unit with ``▁`` for the blank in front, and the places of ``▁`` that stand in the text."""
    word = unit.decode()
    literal = frozenset(i for i, c in enumerate(word) if c == BLANK) if BLANK in word else frozenset()
    return (BLANK + word[1:] if word[0] == " " else word), literal


def _with_n(unit: bytes, n: int) -> tuple[str, int, frozenset[int]]:
    word, literal = _marked(unit)
    return word, n, literal


def _without_blank(spelled: bytes) -> bytes:
    return spelled[1:] if spelled.startswith(b" ") else spelled


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encode(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(doc_id, rank, score, n_pieces, ids): the n best segmentations of every text; ``ids`` are little-endian 32-bit
    numbers. Narrow, nothing is shuffled. ``decoded`` adds the text that the ids spell, in the same pass."""
    rows = texts_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(model)
        for batch in batches:
            for first, texts in in_groups(batch.column(1), 1 << 21):
                at, rank, score, ids, spelled = zip(*vocabulary.encode(texts, n))
                columns = [batch.column(0).take(pa.array(np.array(at) + first)), pa.array(rank, pa.int32()),
                           pa.array(score, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                           pa.array([x.tobytes() for x in ids], pa.binary())]
                names = ["doc_id", "rank", "score", "n_pieces", "ids"]
                if decoded:
                    columns.append(pa.array([_without_blank(x) for x in spelled], pa.binary()).cast(pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names)

    columns = f"doc_id {kind}, rank int, score bigint, n_pieces bigint, ids binary"
    return rows.mapInArrow(run, columns + (", text string" if decoded else ""))


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text that ``ids_col`` spells (null for null) in ``text_col``."""
    kept = [c for c in encoded.columns if c != text_col]
    rows = encoded.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{ids_col}`").alias("ids"))
    shape = rows.schema["row"].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(model)
        for batch in batches:
            texts = [None if not i.is_valid else vocabulary.decode(i.as_py()) for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, f"row {shape}, text string").select("row.*", F.col("text").alias(text_col))
