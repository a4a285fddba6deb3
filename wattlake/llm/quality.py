"""Quality rules: statistics of whole texts, and an ordered list of threshold rules learned from labels.

``statistics`` counts words, symbols, repeated lines and repeated windows of words in one narrow pass. ``learn`` covers the
documents labelled bad one rule at a time: a rule is grown, condition by condition, on two thirds of the
examples by the gain in information, and pruned on the other third, from its last condition on, to where it is
purest there. A rule that is pure enough takes the examples it covers out; the first that is not ends the list. The list
is a Spark expression of nested conditions over the counts, first match first, and everything else is kept.

Only the examples, at most ``sample_rows`` of the labelled rows, are gathered; statistics cover all rows.

Defined cases: a null or empty text has zero of everything. A share of nothing is zero. A label that is null is
none; a document with several labels counts once for each; a label without a document is ignored. Without examples of both kinds the
list is empty and everything is kept. Repeated rows and null ids are rows of their own. No rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import all_of, texts_of
from wattlake.llm.words import BLANKS, Words, in_groups

WINDOW = 8

# Kinds of bytes that are counted; letters beyond the first 128 are counted by their leading bytes.
_KINDS = {
    "n_symbols": b"#*$%&|<>",
    "n_marks": b"!?.,;:",
    "n_digits": b"0123456789",
    "n_upper": bytes(range(65, 91)),
}
COUNTS = ["n_words", "word_chars", *_KINDS, "n_distinct", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_next"]

# The numbers rules speak about: a count by a power of another, so that they mean the same in short and long texts. New words
# come ever more rarely in a long text, about as the root of its length.
SHARES = {
    "chars_per_word": ("word_chars", "n_words", 1.0),
    "symbol_share": ("n_symbols", "word_chars", 1.0),
    "mark_share": ("n_marks", "word_chars", 1.0),
    "digit_share": ("n_digits", "word_chars", 1.0),
    "upper_share": ("n_upper", "word_chars", 1.0),
    "distinct_by_root": ("n_distinct", "n_words", 0.5),
    "dup_line_share": ("n_dup_lines", "n_lines", 1.0),
    "repeat_share": ("n_repeat_words", "n_words", 1.0),
    "same_next_share": ("n_same_next", "n_words", 1.0),
}


# ---------------------------------------------------------------- statistics

def _repeated(words: Words) -> np.ndarray:
    """Which words lie in a window of ``WINDOW`` words that occurs twice or more in the same text."""
    n = len(words)
    inside = np.zeros(n + 1, np.int64)
    firsts = np.flatnonzero(words.owner[:n - WINDOW + 1] == words.owner[WINDOW - 1:]) if n >= WINDOW else np.zeros(0, np.int64)
    if len(firsts):
        mixed = (words.ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        key = words.owner[firsts].astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        for i in range(WINDOW):
            key = (key ^ mixed[firsts + i]) * np.uint64(0x94D049BB133111EB)
            key ^= key >> np.uint64(31)
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        a, b = firsts[order[:-1][same]], firsts[order[1:][same]]
        whole = lambda at: (words.ids[at[:, None] + np.arange(WINDOW)], words.owner[at])
        equal = (whole(a)[0] == whole(b)[0]).all(axis=1) & (words.owner[a] == words.owner[b])
        if equal.all():
            twice = np.unique(np.concatenate([a, b]))
        else:  # two windows with one key: compare all the windows concerned
            some = np.unique(np.concatenate([a, b]))
            rows = np.column_stack([whole(some)[1], whole(some)[0]])
            _, group, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            twice = some[count[group.ravel()] > 1]
        inside[twice] += 1
        np.add.at(inside, twice + WINDOW, -1)
    return np.cumsum(inside)[:n] > 0


def _sums(words: Words, marks: np.ndarray) -> np.ndarray:
    """How many words of each text are marked."""
    total = np.concatenate([[0], np.cumsum(marks)])
    return total[words.begin[1:]] - total[words.begin[:-1]]


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS.decode())]
    return len(lines), len(lines) - len(set(lines))


def _counted(texts: pa.LargeStringArray) -> list[np.ndarray]:
    words = Words(texts)
    n, lead = len(words), (words.data & 0xC0) != 0x80
    of_kind = []
    for members in _KINDS.values():
        table = np.zeros(256, bool)
        table[list(members)] = True
        of_kind.append(words.per_text(table[words.data]))
    # equal words of a text stand together once ordered by text and word
    key = words.owner * (int(words.ids.max(initial=0)) + 1) + words.ids
    key.sort()
    new = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    distinct = np.bincount(key[new] // (int(words.ids.max(initial=0)) + 1), minlength=len(texts))
    next_same = np.zeros(n, bool)
    next_same[:-1] = (words.ids[1:] == words.ids[:-1]) & (words.owner[1:] == words.owner[:-1])
    lines = np.array([_lines(t.as_py()) for t in texts], np.int64).reshape(-1, 2)
    return [words.counts(), words.per_text(lead & ~words.blank), *of_kind, distinct, lines[:, 0], lines[:, 1],
            _sums(words, _repeated(words)), _sums(words, next_same)]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of every whole text. Narrow, nothing is shuffled."""
    rows = texts_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, texts in in_groups(batch.column(1)):
                counts = [pa.array(c.astype(np.int64)) for c in _counted(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *counts], ["doc_id", *COUNTS])

    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def share(name: str) -> Column:
    """One of the ``SHARES`` as a column over the counts."""
    part, whole, power = SHARES[name]
    by = F.col(whole) if power == 1 else F.pow(F.col(whole), F.lit(power))
    return F.when(F.col(whole) > 0, F.col(part) / by).otherwise(0.0)


# ---------------------------------------------------------------- rules

@dataclass(frozen=True)
class Condition:
    share: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = share(self.share)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.share] > self.threshold if self.above else values[self.share] <= self.threshold

    def __str__(self) -> str:
        return f"{self.share} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """Conditions that all must hold for a document to be dropped."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return all_of([c.column() for c in self.conditions])

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(values) for c in self.conditions])

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions))


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def first_match(self) -> Column:
        """The number of the first rule that holds, from 1; null if none does: an ordered conditional expression."""
        found = F.lit(None).cast("int")
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            found = F.when(rule.column(), F.lit(number)).otherwise(found)
        return found

    def keeps(self) -> Column:
        return self.first_match().isNull()


def _gains(values: np.ndarray, bad: np.ndarray) -> tuple[float, float, bool]:
    """(gain, threshold, above) of the best condition on one number: the bad examples it keeps, times the information
    each gains about being bad."""
    order = np.argsort(values, kind="stable")
    v, b = values[order], bad[order]
    cut = np.flatnonzero(v[1:] > v[:-1])  # between two different numbers
    if not len(cut):
        return 0.0, 0.0, True
    below_bad, below = np.cumsum(b)[cut], cut + 1
    all_bad, n = int(b.sum()), len(b)
    before = np.log2(all_bad / n)
    best = (0.0, 0.0, True)
    for p, total, above in ((all_bad - below_bad, n - below, True), (below_bad, below, False)):
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(p > 0, p * (np.log2(p / total) - before), 0.0)
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (float(gain[i]), float((v[cut[i]] + v[cut[i] + 1]) / 2), above)
    return best


def grow(values: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    """Conditions added while they gain and good examples are left inside, ``most`` at most."""
    inside, conditions = np.ones(len(bad), bool), []
    while len(conditions) < most and bad[inside].any() and not bad[inside].all():
        gains = {name: _gains(v[inside], bad[inside]) for name, v in values.items()}
        name = max(gains, key=lambda x: gains[x][0])  # the first of equal ones
        gain, threshold, above = gains[name]
        if gain <= 0:
            break
        conditions.append(Condition(name, above, threshold))
        inside &= conditions[-1].holds(values)
    return Rule(tuple(conditions))


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, float, int]:
    """(share of bad among what the rule covers, as if one of each kind came on top; that share itself; how many it covers)."""
    covered = bad[rule.holds(values)]
    return (covered.sum() + 1) / (len(covered) + 2), covered.sum() / max(1, len(covered)), len(covered)


def prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The beginning of the rule that is worth most on examples it was not grown on; the shortest of equal ones."""
    starts = [Rule(rule.conditions[:i]) for i in range(1, len(rule.conditions) + 1)]
    best = max(starts, key=lambda r: _worth(r, values, bad)[0])
    tightest = {(c.share, c.above): c for c in best.conditions}  # a later condition on the same side is the tighter one
    return Rule(tuple(tightest.values()))


def cover(values: dict[str, np.ndarray], bad: np.ndarray, pruning: np.ndarray, purity: float = 0.9, least: int = 3,
          most_conditions: int = 6, most_rules: int = 32) -> DecisionList:
    """Sequential covering. ``pruning`` marks the examples rules are pruned and judged on; ``purity`` and ``least`` are what a
    rule must show on them: the share of bad ones it covers and how many examples."""
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules and (bad & left & ~pruning).any():
        part = lambda mask: ({k: v[mask] for k, v in values.items()}, bad[mask])
        rule = grow(*part(left & ~pruning), most_conditions)
        if not rule.conditions:
            break
        rule = prune(rule, *part(left & pruning))
        _, pure, covered = _worth(rule, *part(left & pruning))
        if pure < purity or covered < least:
            break
        rules.append(rule)
        left &= ~rule.holds(values)
    return DecisionList(tuple(rules))


def learn(counts: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = 16_384, seed: int = 7,
          **rules) -> DecisionList:
    """The decision list for ``counts`` (``doc_id`` and ``COUNTS``) learned from ``labels`` (``doc_id``, and 0 for bad in the
    column ``label``). Examples are at most ``sample_rows`` rows in an order of hashed ids; ids alone are thinned to about twice
    as many before they meet in a task. The order also says which third prunes, so the list repeats."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", (F.col(label) == 0).alias("bad"), F.xxhash64(F.lit(seed), "doc_id").alias("h"))
    n = known.count()
    if n > 2 * sample_rows:
        steps = 1 << 20
        known = known.where(F.pmod("h", F.lit(steps)) < int(2 * sample_rows / n * steps) + 1)
    sample = known.orderBy("h", "bad").limit(sample_rows)
    rows = counts.join(sample, "doc_id").select("bad", "h", *[share(s).alias(s) for s in SHARES]).toPandas()
    rows = rows.sort_values(["h", "bad", *SHARES], kind="stable")
    bad = rows["bad"].to_numpy(bool)
    values = {s: rows[s].to_numpy(float) for s in SHARES}
    return cover(values, bad, (rows["h"].to_numpy(np.int64) >> 20) % 3 == 0, **rules)
