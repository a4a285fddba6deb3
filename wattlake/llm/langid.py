"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased, everything but letters becomes a word boundary, and the subwords of 2 to 4 characters
(word boundaries included) are hashed into buckets. Each bucket has an embedding; a text is the mean of its
subwords' embeddings, and a linear softmax over it gives the languages. Embeddings and softmax are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled texts.

A quarter of the sample does not train; it calibrates. It fits the temperature that makes scores probabilities, and the
share of unknown subwords (those that training did not meet) above which a text is rejected as being in no learned
language. A text's share counts by its lower bound, so a few unknown subwords do not reject a short text. A text that
mixes learned languages is undecided, which its score says, but it knows its subwords and is not rejected; so the score
takes no part in rejection.

Mean and softmax are linear, so prediction needs only one row of summed weights per bucket. These rows are kept as
integers, which makes a score the same in whatever batch or piece a text is read.

Defined cases: a null text and one without any letter get ``und`` with score 0 and are rejected. Null languages
are not learned. Languages with one sum are ordered by name, the first is given. Without any labelled row every text is
``und``. Only the named columns are read, whatever the others are called. A row with null id is predicted, never learned
from. Every row of ``docs`` gives one row, repeats included; texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import texts_of
from wattlake.llm.words import give_back

UNKNOWN = "und"
SIZES = (2, 3, 4)
PIECE_CHARS = 1 << 18
SCALE = 1 << 16

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter; made once in a process."""
    global _letters
    if _letters is None:
        _letters = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters


def subwords(text: str, buckets: int):
    """Bucket numbers of all subwords of a text, in arrays of bounded size. ``buckets`` is a power of two."""
    is_letter, longest = letters(), max(SIZES)
    padded = f" {text.lower()} "
    for start in range(0, len(padded) - 1, PIECE_CHARS):
        codes = np.frombuffer(padded[start:start + PIECE_CHARS + longest - 1].encode("utf-32-le", "replace"), "<u4")
        letter = is_letter[codes]
        codes = np.where(letter, codes, 32).astype(np.uint32)
        hashed, inner = codes, np.ones(len(codes), bool)
        found = []
        for size in range(2, longest + 1):
            # All but the outer characters are letters: a subword lies within one word and its boundaries.
            if size > 2:
                inner = inner[:-1] & letter[size - 2:len(letter) - 1]
            hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint32(15))) * np.uint32(0x9E3779B1) + codes[size - 1:]
            if size in SIZES:
                valid = inner if size > 2 else letter[:-1] | letter[1:]
                valid = valid[:len(hashed)][:PIECE_CHARS]
                mixed = hashed[:PIECE_CHARS][valid] * np.uint32(0x85EBCA6B)
                mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35)
                found.append(mixed >> np.uint32(33 - buckets.bit_length()))
            if size == 2:
                inner = np.ones(len(codes) - 1, bool)
        yield np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """Integer weights of each bucket by language (a last column says whether training met the bucket), the
    temperature, and the bound on the share of unknown subwords above which texts are rejected."""

    languages: tuple[str, ...]
    weights: np.ndarray
    temperature: float
    unknown_share: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        total, n = np.zeros(len(self.languages) + 1, np.int64), 0
        if text and self.languages:
            for found in subwords(text, len(self.weights)):
                total += self.weights[found].sum(axis=0, dtype=np.int64)
                n += len(found)
        if not n:
            return UNKNOWN, 0.0, True
        p = _softmax(total[:-1] / (n * SCALE) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(least_unknown(n - total[-1], n) > self.unknown_share)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def least_unknown(unknown, n):
    """Lower bound, by three standard errors, of the share of unknown subwords in texts of ``n``."""
    return (unknown - 3 * np.sqrt(unknown * (1 - unknown / n))) / n


def crc_of_id(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))


# ---------------------------------------------------------------- training

def sample(docs: DataFrame, rows: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """At most ``rows`` labelled rows, as many of each language as there are, in an order that depends on ids only."""
    labelled = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"),
                            F.col(f"`{text_col}`").alias("text"))
                .where("doc_id IS NOT NULL AND lang IS NOT NULL"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Twice the rows wanted of each language by a threshold on the hash, so that no language gathers more in one task. The
    # thresholds are broadcast: as many as there are languages, of which the ``rows`` most frequent ones count.
    share = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows)
             .select("lang", F.least(F.lit(1.0), 2.0 * rows / F.col("n")).alias("share")))
    thinned = (labelled.select("doc_id", "lang").join(F.broadcast(share), "lang")
               .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)))
    within = Window.partitionBy("lang").orderBy(*order)
    chosen = (thinned.withColumn("rn", F.row_number().over(within))
              .where(F.col("rn") <= rows).orderBy("rn", *order).limit(rows))
    return labelled.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi")


def _counted(rows: DataFrame, buckets: int) -> DataFrame:
    """(lang, at, n): the buckets a text falls into and how often, as packed 32-bit numbers."""
    def run(batches):
        for batch in batches:
            ids, langs, at, n = batch.column(0), [], [], []
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2)):
                counts = np.zeros(buckets, np.int64)
                for found in subwords(text.as_py() or "", buckets):
                    counts += np.bincount(found, minlength=buckets)
                seen = np.flatnonzero(counts)
                langs.append(lang)
                at.append(seen.astype("<i4").tobytes())
                n.append(counts[seen].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([ids, pa.array(langs, pa.string()), pa.array(at, pa.binary()),
                                              pa.array(n, pa.binary())], ["doc_id", "lang", "at", "n"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "lang", "text").mapInArrow(run, f"doc_id {kind}, lang string, at binary, n binary")


def _within_bytes(rows: DataFrame, most: int, buckets: int, bound: int) -> int:
    """How many of the first ``most`` rows take no more than ``bound`` bytes as bucket counts; one at least. A text of n
    characters has at most three subwords for each, and eight bytes are sent for each bucket met."""
    size = 8 * F.least(F.lit(buckets), 3 * F.length(F.coalesce("text", F.lit("")))).cast("bigint")
    sizes = [r.size for r in rows.select(F.xxhash64("doc_id").alias("h"), "doc_id", size.alias("size"))
             .orderBy("h", "doc_id", "size").limit(most).collect()]
    return max(1, int(np.searchsorted(np.cumsum(sizes), bound, side="right")))


def train(docs: DataFrame, sample_rows: int = 4096, buckets: int = 1 << 17, dim: int = 16, steps: int = 4000,
          rate: float = 1.0, reject_share: float = 0.001, seed: int = 7, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang", sample_bytes: int = 1 << 29) -> Model:
    """Fit on at most ``sample_rows`` rows. Only these reach the driver, as bucket counts (at most ``buckets`` each), and of
    them only the first, in the order of hashed ids, that surely fit ``sample_bytes``; each is taken whole.

    About ``reject_share`` of new texts in learned languages would be rejected, judged by those held back for calibration."""
    sampled = sample(docs, sample_rows, id_col, text_col, lang_col)
    sample_rows = _within_bytes(sampled, sample_rows, buckets, sample_bytes)
    rows = _counted(sampled, buckets)
    got = (rows.where(F.length("at") > 0).orderBy(F.xxhash64("doc_id"), "doc_id", "lang", F.xxhash64("at", "n"))
           .limit(sample_rows).select("lang", "at", "n").collect())
    languages = tuple(sorted({r.lang for r in got}))
    if not languages:
        return Model((), np.zeros((buckets, 1), np.int32), 1.0, 0.0)
    texts = [(np.frombuffer(r.at, "<i4"), np.frombuffer(r.n, "<f4")) for r in got]
    counts = texts
    texts = [(at, n / n.sum()) for at, n in counts]
    truth = np.array([languages.index(r.lang) for r in got])
    trains = np.arange(len(got)) % 4 != 3
    met = np.unique(np.concatenate([at for (at, _), t in zip(texts, trains) if t]))
    learned = _descend([(np.searchsorted(met, at), n) for (at, n), t in zip(texts, trains) if t], truth[trains],
                       len(languages), len(met), dim, steps, rate, seed)
    weights = np.zeros((buckets, len(languages) + 1), np.int32)
    weights[met, :-1], weights[met, -1] = np.round(learned * SCALE), 1
    judged = np.flatnonzero(~trains) if len(got) > 3 else np.arange(len(got))
    sums = np.array([n.astype(np.float64) @ weights[at] for at, n in (texts[i] for i in judged)])
    temperature = _temperature(sums[:, :-1] / SCALE, truth[judged])
    held = [(n[weights[at, -1] == 0].sum(dtype=np.float64), n.sum(dtype=np.float64)) for (at, n), t in zip(counts, trains) if not t]
    shares = np.array([max(0.0, least_unknown(unknown, n)) for unknown, n in held])
    return Model(languages, weights, temperature, _rejection(shares, reject_share))


def _rejection(held: np.ndarray, reject_share: float) -> float:
    """The bound that ``reject_share`` of learned texts exceed. Few held-back texts do not show so rare a case, so their
    upper tenth is continued exponentially; one more text, half unknown, is counted in. Without any it is a half."""
    bound = 0.0
    if len(held):
        tenth = np.quantile(held, 0.9)
        over = held[held > tenth] - tenth
        tail = tenth + (over.mean() * np.log(0.1 / reject_share) if len(over) else 0.0)
        bound = max(float(np.quantile(held, 1 - reject_share)), float(tail))
    return bound + 0.5 / (len(held) + 1)


def _descend(texts: list, truth: np.ndarray, kinds: int, buckets: int, dim: int, steps: int, rate: float,
             seed: int, batch: int = 8) -> np.ndarray:
    """Weights per bucket and language after stochastic gradient descent on embeddings and softmax."""
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (buckets, dim)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (dim, kinds)).astype(np.float32)
    order = np.concatenate([rng.permutation(len(texts)) for _ in range(-(-steps * batch // len(texts)))])
    for step in range(steps):
        rows = order[step * batch:(step + 1) * batch]
        hidden = np.array([texts[r][1] @ embedding[texts[r][0]] for r in rows])
        gradient = _softmax(hidden @ softmax)
        gradient[np.arange(len(rows)), truth[rows]] -= 1
        pace = np.float32(rate * (1 - step / steps))
        back = gradient @ softmax.T
        softmax -= pace / len(rows) * (hidden.T @ gradient)
        # Each bucket holds a small share of a text, so embeddings move by the sum, not the mean.
        for r, move in zip(rows, back):
            at, share = texts[r]
            embedding[at] -= pace * share[:, None] * move
    return embedding @ softmax


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits under which the true languages are likeliest."""
    def loss(t: float) -> float:
        return -float(np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean())
    return float(min(np.geomspace(0.25, 20, 90), key=loss))


# ---------------------------------------------------------------- operator

def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row per row of ``docs``; narrow, nothing is shuffled."""
    rows = texts_of(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            langs, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns. Narrow."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            kept = [not model.predict(t.as_py())[2] for t in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)

