"""Token ids of whole texts, with every word tokenized once.

The tokenizer's own words never go across a blank, or a line end, between two characters that are not white space. So most texts
fall into units, words with the blank in front of them, whose ids alone are their ids in the text. The units of
many texts are found in their bytes and numbered at once; a unit not seen before is tokenized, and a text is put
together from the ids of its units. Texts with other white space are cut at such places only.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from wattlake.llm.words import Words

CACHED_BYTES = 128 << 20  # of units and their ids, with what Python adds; then the cache starts anew
_EACH = 150
# White space other than blanks and line ends.
_OTHER = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Letters below are letters in every version of Unicode.
_STABLE = "\u0370"
_PARTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")


class WordCache:
    """Units already tokenized: ``known`` gives a unit's number, and its ids are a stretch of ``pool``."""

    def __init__(self, path: str, limit: int | None = None):
        self.limit = limit
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core is one task's share
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        line_end, *marks = self._ids(["\n", *".,;:!?"])
        if len(line_end) != 4:
            raise ValueError("a line end must be one token")
        self.line_end = int(np.frombuffer(line_end, np.uint32)[0])
        self.marks = dict(zip(b".,;:!?", marks))
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet
        others = (b for b in range(256) if b not in set(printed))
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.blank = self.letters[32]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool = np.zeros(0, np.uint32)
        self.ends = np.zeros(1, np.int64)
        self.size = 0

    def _ids(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]  # 32 bits, little-endian on all supported machines

    def _letters(self, unit: bytes, word: bytes) -> bytes:
        """Ids of a blank or none and letters: one word to the tokenizer, so its model alone is asked."""
        spelled = word.decode() if word.isascii() else word.decode("latin-1").translate(self.letters)
        if unit is not word:
            spelled = self.blank + spelled
        return array("I", [t.id for t in self.tokenize(spelled)]).tobytes()

    def _cached(self, unit: bytes) -> bytes:
        number = self.known.get(unit)
        return b"" if number is None else self.pool[self.ends[number]:self.ends[number + 1]].tobytes()

    def _numbers(self, units: list[bytes]) -> np.ndarray:
        """The numbers of units; new ones are tokenized."""
        known = self.known
        numbers = np.fromiter(map(known.get, units, repeat(-1)), np.int64, len(units))
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            missing = [units[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(missing))
            ids: dict[bytes, bytes] = {}
            others, marks = [], self.marks
            for unit in new:
                head = unit[:-1] if unit[-1] in marks else unit
                word = head[1:] if head[:1] == b" " else head
                if not (word.isalpha() or _only_letters(word)):  # of bytes: plain letters
                    others.append(unit)
                elif head is unit:
                    ids[unit] = self._letters(unit, word)
                else:
                    ids[unit] = (ids.get(head) or self._cached(head) or self._letters(head, word)) + marks[unit[-1]]
            for start in range(0, len(others), 4096):
                some = others[start:start + 4096]
                ids.update(zip(some, self._ids([u.decode() for u in some])))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            found = b"".join([ids[u] for u in new])
            sizes = np.fromiter((len(ids[u]) // 4 for u in new), np.int64, len(new))
            self.pool = np.concatenate([self.pool, np.frombuffer(found, np.uint32)])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.size += sum(map(len, new)) + len(found) + _EACH * len(new)
            first = len(known) - len(new)
            numbers[unknown] = (np.arange(first, len(known)) if len(new) == len(missing) else
                                np.fromiter(map(known.__getitem__, missing), np.int64, len(missing)))
        return numbers

    def _joined(self, units: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, where each one's end); an id of ``behind`` that is not -1 follows its unit."""
        first = self.ends[units]
        sizes = self.ends[units + 1] - first + (behind >= 0)
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)
        ids = np.append(self.pool, np.uint32(0))[places]  # a place behind the last unit's ids is overwritten
        told = behind >= 0
        ids[ends[told] - 1] = behind[told]
        return ids, ends

    def encode(self, texts: pa.LargeStringArray, closing: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(numbers of texts, their ids one after the other and each with ``closing`` behind, where each text begins and the
        end). The texts come in at most two parts."""
        if self.size > (CACHED_BYTES if self.limit is None else self.limit):
            self.forget()
        strings = texts.to_pylist()
        plain = np.fromiter(map(_plain, strings), bool, len(strings))
        if plain.any():
            words = Words(texts.filter(pa.array(plain)), numbered=False)
            led = words.data[words.first - 1] == 32
            led[words.begin[:-1]] = False  # before the first word of a text is another text
            first = words.first - led
            taken = ~words.blank
            taken[first[led]] = True
            places = np.concatenate([[0], np.cumsum(words.past - first)])
            spelled = pa.Array.from_buffers(pa.large_binary(), len(first), [
                None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(words.data[taken])]).dictionary_encode()
            numbers = self._numbers(spelled.dictionary.to_pylist())[spelled.indices.to_numpy(zero_copy_only=False)]
            behind = np.where(words.data[words.past] == 10, self.line_end, -1)
            behind[words.begin[1:] - 1] = closing
            ids, ends = self._joined(numbers, behind)
            yield np.flatnonzero(plain), ids, np.concatenate([[0], ends[words.begin[1:] - 1]])
        rest = np.flatnonzero(~plain)
        if len(rest):
            parts = [_PARTS.split(strings[i]) if strings[i] else [] for i in rest]
            numbers = self._numbers([p.encode() for split in parts for p in split])
            last = np.cumsum([len(split) for split in parts])
            ids, ends = self._joined(numbers, np.full(len(numbers), -1))
            ends = np.concatenate([[0], ends])[last]
            yield rest, np.insert(ids, ends, closing), np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])


def _only_letters(word: bytes) -> bool:
    text = word.decode()
    return text.isalpha() and max(text) < _STABLE


def _plain(text: str) -> bool:
    """Whether a text's white space is single blanks and line ends between words."""
    return bool(text) and not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text
                               or text[0] in " \n" or text[-1] in " \n" or _OTHER.search(text))


_caches: dict[str, WordCache] = {}


def word_cache(path: str, limit: int | None = None) -> WordCache:
    """The cache of this worker, of at most about ``limit`` bytes."""
    if path not in _caches:
        _caches[path] = WordCache(path)
    _caches[path].limit = limit
    return _caches[path]
