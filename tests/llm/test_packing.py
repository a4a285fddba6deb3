import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import LONG, ODD, docs
from tokenizers import Tokenizer

from wattlake.llm import packing, queries, wordcache

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute_pieces(text, capacity=2048):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]
    rest = len(ids) % capacity or capacity
    cuts = [0, *range(rest, len(ids), capacity), len(ids)]
    return [(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def encoded(cache, texts):
    found = {}
    for rows, ids, bounds in cache.encode(pa.array(texts, pa.large_string()), 0):
        for row, a, b in zip(rows.tolist(), bounds, bounds[1:]):
            found[row] = ids[a:b].tolist()
    return [found[i] for i in range(len(texts))]


def test_cached_words_give_the_tokenizer_s_ids():
    rng, tokenizer = random.Random(3), Tokenizer.from_file(PATH)
    cache = wordcache.WordCache(PATH)
    texts = ["", "a  b\n\n c \t d", "x　y  z", " lead", "trail \n", "it's  don't 12 34 $$ <|endoftext|> é\n\n\nq",
             "a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|>\nb <|endoftext|>c, <|endoftext|>.", "<|endoftext|>  x",
             "a\x0bb \x0b c", "1\n2\n 3\r\n4 5", "\x1c a\x1cb c", "​ a", "\x85 b", "a", "a b", "é", "straße, über!"]
    some = ["ab", " ", "\n", "\t", "1", "!", "é", "'s", " ", "Word", "<|endoftext|>", ",", "ß"]
    texts += ["".join(rng.choices(some, k=rng.randint(1, 40))) for _ in range(2000)]
    for _ in range(2):
        assert encoded(cache, texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_a_full_cache_changes_nothing_and_is_bounded_in_bytes(monkeypatch):
    texts = [f"word{i} other{i % 7} x{i}\nline{i} " + "y" * (i % 50) for i in range(200)]
    want = encoded(wordcache.WordCache(PATH), texts)
    monkeypatch.setattr(wordcache, "CACHED_BYTES", 5000)
    cache, sizes, got = wordcache.WordCache(PATH), [], []
    for i in range(0, 200, 5):
        got += encoded(cache, texts[i:i + 5])
        sizes.append(cache.size)
    assert got == want and max(sizes) < 5000 + 5 * 6 * 250 and min(sizes[5:]) < 5000


def brute_dearest(prices, capacity):
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - 1]] + [best[room - s] + prices[s] for s in range(1, room + 1) if prices[s]])
    return best


def test_pricing_is_an_exact_knapsack():
    rng = random.Random(5)
    for _ in range(50):
        prices = np.array([0.0] + [rng.choice([0.0, rng.random() * i]) for i in range(1, 31)])
        best, taken = packing.price_table(prices, 30)
        assert best == pytest.approx(brute_dearest(prices, 30))
        for room in range(31):
            found = packing.dearest(taken, room)
            assert sum(found) <= room and sum(prices[found]) == pytest.approx(best[room])


def test_fractional_solution_covers_evenly_and_its_bound_holds():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 256, 3000), minlength=257).astype(float)
    solution, bound = packing.fractional(counts, 256)
    covered = np.zeros(257)
    for filling, times in solution.items():
        assert sum(filling) <= 256 and times > 0
        np.add.at(covered, list(filling), times)
    assert covered == pytest.approx(counts, abs=1e-5)
    volume = (counts * np.arange(257)).sum() / 256
    assert 0.999 * volume <= bound <= sum(solution.values()) <= 1.1 * volume


def random_counts(seed):
    rng = random.Random(seed)
    counts = np.zeros(257, np.int64)
    for _ in range(rng.choice([1, 50, 5000])):
        counts[min(256, int(rng.expovariate(1 / rng.choice([20, 90]))) + 1)] += rng.choice([1, 1, 40])
    return counts


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_item_once_and_is_tight(seed):
    counts = random_counts(seed)
    found = packing.plan(counts, 256)
    held = np.zeros(257, np.int64)
    for f in found.fillings:
        assert sum(f.lengths) <= 256
        np.add.at(held, list(f.lengths), f.times)
    assert (held == counts).all()
    least = -(-int((counts * np.arange(257)).sum()) // 256)
    assert found.bound <= found.sequences() <= least * 1.02 + 2


def test_halves_cannot_be_beaten():
    counts = np.zeros(257, np.int64)
    counts[129] = 100  # two never fit together
    counts[127] = 100
    assert packing.plan(counts, 256).sequences() == 100


@pytest.mark.parametrize("seed", range(3))
def test_small_plans_against_all_packings(seed):
    rng = random.Random(seed)
    for _ in range(15):
        items = sorted((rng.randint(2, 12) for _ in range(rng.randint(1, 8))), reverse=True)
        counts = np.bincount(items, minlength=13)
        found = packing.plan(counts, 12)
        assert found.bound <= fewest(items, 12) <= found.sequences() <= fewest(items, 12) + 1


def fewest(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j, b in enumerate(bins):
            if b + items[i] <= capacity:
                place(i + 1, bins[:j] + [b + items[i]] + bins[j + 1:])
        place(i + 1, bins + [items[i]])

    place(0, [])
    return best


def test_the_program_places_most_tokens_and_reaches_its_bound(spark):
    lengths = packing.pieces(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), PATH).select("length")
    counts = np.zeros(2049, np.int64)
    for r in lengths.groupBy("length").count().collect():
        counts[r.length] = r["count"]
    found = packing.plan(counts, 2048)
    tokens = [sum(f.lengths) * f.times for f in found.fillings]
    full = counts[2048] * 2048
    assert sum(tokens[:found.by_program]) - full > 0.5 * (sum(tokens) - full)
    assert found.sequences() == found.bound


def test_query_equals_brute_force(spark, sf_dir):
    got = queries.op3_best_fit_packing(spark, sf_dir).toPandas()
    by_id = {i: list(g.sort_values("piece")[["piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
             for i, g in got.groupby("doc_id")}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert by_id == {r.doc_id: brute_pieces(r.text) for r in rows}
    check_places(got, 2048)


def check_places(got, capacity):
    ordered = got.sort_values(["sequence_id", "offset"])
    filled = ordered.groupby("sequence_id").length
    assert (ordered.offset == filled.cumsum() - ordered.length).all() and filled.sum().max() <= capacity


def test_odd_rows(spark):
    rows = docs(spark, ODD)
    cut = packing.pieces(rows, PATH, 64)
    got = packing.pack(cut, 64).toPandas()
    check_places(got, 64)
    assert (got[got.doc_id.isin([1, 2])].length == 1).all()
    long = got[got.doc_id == 6].sort_values("piece")
    assert long.length.sum() == sum(p[2] for p in brute_pieces(LONG)) and (long.length[1:] == 64).all()
    whole = Tokenizer.from_file(PATH).encode(LONG, add_special_tokens=False).ids + [0]
    assert b"".join(map(bytes, long.ids)) == np.array(whole, "<u4").tobytes()
    assert packing.pack(packing.pieces(docs(spark, []), PATH), 2048).count() == 0


def test_common_length_and_clashing_columns(spark):
    rows = [(i, 7, "a", 5, 5) for i in range(1000)] + [(i, 9, "b", 5, 5) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, length int, task string, rank long, offset long").repartition(5)
    got = packing.pack(df, 16)
    assert got.columns == ["id", "length", "task", "rank", "sequence_id", "offset"]
    check_places(got.toPandas(), 16)
    assert got.count() == 1010


def test_no_task_holds_two_workers(spark, monkeypatch):
    plans, write = [], packing.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(packing, "stored", stored)
    packed = queries.packed(docs(spark, ODD))
    plans.append(packed._jdf.queryExecution().executedPlan().toString())
    assert packed.count() >= len(ODD)
    workers = [plan.count("MapInArrow") for plan in plans]
    assert max(workers) == 1 and sum(workers) == 3
