"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust their scores.

Everything is column expressions over one row, so nothing is shuffled and no Python runs on executors. Matches and
the text between them come from the same pattern (``regexp_extract_all`` and ``split``); running totals of their
lengths give the places, in code points. Running totals are made in blocks, so long lists stay near linear.

A pattern that begins within a run of its own characters would be tried at every character of the run. Where a
match can only begin at the start of a run or right after the match before it, the pattern says so
(``\\G`` and look-behind) and repeats possessively: a long run is read once, with the same matches.

Spans of the base kinds (email, ip, card, phone) stand once they are confirmed. The other kinds are kept when their
score, raised or lowered by words within ``CONTEXT`` characters (up to the neighbouring match of the same kind), is at
least ``threshold``.

Defined cases: a null text counts as empty and has no spans; ``redact`` leaves it null. Every row gives one row,
whatever its id. Spans of different kinds may overlap, spans of one kind never do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import let, texts_of

CONTEXT = 40
_START, _END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"


# ---------------------------------------------------------------- validators

def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substring(number, place, F.lit(1))) - 48
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when((F.length(number) - place) % 2 == 1, doubled).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an international account number, without spaces, passes its check."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.left(account, F.lit(4)))

    def add(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(turned, place, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), add) == 1


def _any(match: Column) -> Column:
    return F.lit(True)


def _ip(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _card(least: int) -> Callable[[Column], Column]:
    return lambda match: let(digits(match), lambda d: F.when(F.length(d).between(least, 19), luhn(d)).otherwise(F.lit(False)))


def _phone(match: Column) -> Column:
    return F.length(digits(match)).between(10, 15)


def _iban(match: Column) -> Column:
    return let(F.regexp_replace(match, " ", ""),
               lambda a: F.when(F.length(a).between(15, 34), mod97(a)).otherwise(F.lit(False)))


def _mixed(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]")


@dataclass(frozen=True)
class Kind:
    """``needs`` is a cheap pattern without which a text cannot match; ``plain`` tells the same spans to engines
    without look-behind. ``near`` and ``against`` are the words that raise and lower the score."""

    name: str
    pattern: str
    plain: str
    needs: str
    valid: Callable[[Column], Column]
    score: float
    near: str
    against: str = "version|isbn|serial"
    base: bool = False


def _word(pattern: str) -> tuple[str, str]:
    return _START + pattern + _END, rf"\b{pattern}\b"


# Spans are listed by start, then in this order.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "@", _any, 0.9, "mail|contact|write to", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", r"[0-9]\.[0-9]", _ip, 0.6,
         "address|host|login|server|ip", base=True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9])+", "[0-9]", _card(14), 0.8,
         "card|visa|credit|payment", base=True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _phone, 0.7,
         "phone|call|tel|mobile", base=True),
    Kind("iban", *_word("[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"), "[A-Z]{2}[0-9]{2}", _iban, 0.9,
         "iban|account|bank|konto"),
    Kind("lone_card", *_word("[0-9]{13,19}"), "[0-9]{13}", _card(13), 0.6, "card|visa|credit|payment"),
    Kind("national_id", *_word("[0-9]{3}-[0-9]{2}-[0-9]{4}"), "[0-9]{3}-[0-9]{2}-", _any, 0.3, "ssn|social|security|tax|id"),
    Kind("local_phone", *_word("[0-9]{2,5}[ -][0-9]{3,4}[ -][0-9]{3,4}"), "[0-9][ -][0-9]{3}", _any, 0.2,
         "phone|call|tel|mobile|fax"),
    Kind("access_key", *_word("AKIA[A-Z0-9]{16}"), "AKIA", _any, 0.8, "key|secret|access"),
    Kind("secret", *_word("[A-Za-z0-9]{16,64}"), "[0-9]", _mixed, 0.2, "password|passwd|token|secret|api.?key"),
)
BASE = tuple(k.name for k in KINDS if k.base)
RAISE, LOWER = 0.4, 0.3


# ---------------------------------------------------------------- spans

def running_totals(values: Column, block: int = 256) -> Column:
    """Running totals of an array of numbers. Totals run within blocks first, then over the blocks."""
    def totals(part: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("sums"))

        def add(state: Column, x: Column) -> Column:
            return F.struct((state["sum"] + x).alias("sum"),
                            F.concat(state["sums"], F.array(state["sum"] + x)).alias("sums"))
        return F.aggregate(part, start, add, lambda state: state["sums"])

    starts = F.sequence(F.lit(1), F.size(values), F.lit(block))
    blocks = F.transform(starts, lambda i: totals(F.slice(values, i, block)))

    def join(parts: Column) -> Column:
        over = totals(F.transform(parts, lambda p: F.element_at(p, -1)))
        return let(over, lambda ends: F.flatten(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
            F.transform(p, lambda x: x + F.get(ends, i - 1))))))
    return F.when(F.size(values) > 0, let(blocks, join)).otherwise(F.array().cast("array<bigint>"))


def _score(kind: Kind, before: Column, after: Column) -> Column:
    around = F.concat_ws(" ", F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT)))
    return let(around, lambda words: F.lit(kind.score)
               + F.when(words.rlike(word_pattern(kind.near)), F.lit(RAISE)).otherwise(F.lit(0.0))
               - F.when(words.rlike(word_pattern(kind.against)), F.lit(LOWER)).otherwise(F.lit(0.0)))


def word_pattern(words: str) -> str:
    return f"(?i)(?:^|[^a-z])(?:{words})"


def _kept(kind: Kind, match: Column, before: Column, after: Column, threshold: float) -> Column:
    return kind.valid(match) if kind.base else kind.valid(match) & (_score(kind, before, after) >= threshold)


def kind_spans(text: Column, kind: Kind, threshold: float = 0.5) -> Column:
    """Confirmed spans of one kind: array of (start, rank, kind, end, score); ``end`` is exclusive."""
    rank = KINDS.index(kind)

    def places(pieces: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("bigint"))
        return let(let(steps, lambda s: running_totals(s)), lambda ends: F.transform(found, lambda m, i: F.when(
            _kept(kind, m, F.get(pieces, i), F.get(pieces, i + 1), threshold),
            F.struct((F.get(ends, i) - F.length(m)).alias("start"), F.lit(rank).alias("rank"),
                     F.lit(kind.name).alias("kind"), F.get(ends, i).alias("end"),
                     _score(kind, F.get(pieces, i), F.get(pieces, i + 1)).alias("score")))))

    spans = let(F.split(text, kind.pattern, -1), lambda pieces: let(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda found: F.filter(
            places(pieces, found), lambda s: s.isNotNull())))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,score:double>>")
    return F.when(text.rlike(kind.needs), spans).otherwise(none)


def spans_of(text: Column, threshold: float = 0.5) -> Column:
    """The spans of a text by start, then kind."""
    by_kind = [kind_spans(text, k, threshold) for k in KINDS]
    lone = [k.name for k in KINDS].index("lone_card")
    card = BASE.index("card")
    # A number that is a confirmed card already is not listed twice.
    by_kind[lone] = let(by_kind[card], lambda cards: F.filter(by_kind[lone], lambda s: ~F.exists(
        cards, lambda c: (c["start"] <= s["start"]) & (c["end"] >= s["end"]))))
    return F.array_sort(F.concat(*by_kind))


def find_spans(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): the spans of every text by start, then kind."""
    text = F.coalesce("text", F.lit(""))
    return texts_of(docs, id_col, text_col).withColumn("text", text).select("doc_id", spans_of(F.col("text"), threshold).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["rank"] < len(BASE))


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


# ---------------------------------------------------------------- redaction

def redact(text: Column, threshold: float = 0.5) -> Column:
    """``text`` with each confirmed span replaced by its kind in brackets. All spans are found in the text as it is, so no mark
    raises or lowers what stands beside it. Of spans that overlap, the first names the whole stretch. A null stays null."""
    empty = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("bigint").alias("at"))

    def after(done: Column, span: Column) -> Column:
        between = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.when(span["start"] >= done["at"],
                      F.struct(F.concat(done["parts"], F.array(between, mark)).alias("parts"), span["end"].alias("at"))
                      ).otherwise(F.struct(done["parts"].alias("parts"), F.greatest(done["at"], span["end"]).alias("at")))

    def joined(done: Column) -> Column:
        return F.concat(F.array_join(done["parts"], ""), F.substr(text, (done["at"] + 1).cast("int")))

    return let(spans_of(text, threshold), lambda spans: F.when(
        F.size(spans) > 0, F.aggregate(spans, empty, after, joined)).otherwise(text))
