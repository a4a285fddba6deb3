import random
import re

import numpy as np
import pytest
import xxhash
from helpers import ODD, docs

from wattlake.llm import queries, simhash
from wattlake.llm.common import components


def brute_fingerprint(text: str, words: int = 3) -> int:
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i:i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def brute_components(prints: list[tuple], radius: int = 3) -> dict:
    """Smallest id reachable from each (id, fingerprint)."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                parent[find(i)] = find(j)
    groups: dict = {}
    for i, (key, _) in enumerate(prints):
        groups.setdefault(find(i), []).append(key)
    return {key: min(group) for group in groups.values() for key in group}


@pytest.mark.parametrize("text", ["", "one", "two words", "A b C d É É", "x\x0by\x1cz w", "a " * 50, None])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_fingerprint_of_a_text_read_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choices(["Ab", "cde", "f", "ghijk\n", "é"], k=3000))
    monkeypatch.setattr(simhash, "PIECE_BYTES", 7)
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64)]
    for _ in range(300):  # neighbours differ in a few bits
        v = values[-1]
        for _ in range(rng.randrange(8)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    array = np.array(values, np.uint64)
    planes = simhash.bit_planes(array)
    for lag in (1, 2, 63, 64, 65, 130):
        lanes = np.arange(len(values)) < len(values) - lag
        want = [i for i in range(len(values) - lag) if (values[i] ^ values[i + lag]).bit_count() <= radius]
        assert sorted(simhash.near_lanes(planes, lanes, lag, radius).tolist()) == want


def test_every_close_pair_shares_a_bucket():
    rng, masks = random.Random(2), simhash.masks()
    for _ in range(2000):
        flipped = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not flipped & m for m in masks)


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    got = queries.op6_simhash_near_dedup(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = [(i, brute_fingerprint(t)) for i, t in texts.items()]
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(prints)
    assert {r.doc_id: r.component_id for r in got} == brute_components(prints)


def test_large_buckets_are_split_without_losing_links(spark):
    rng = random.Random(4)
    values = {0}
    while len(values) < 400:  # one ball: all share most buckets
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(12)))
    values |= {rng.getrandbits(64) for _ in range(200)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = brute_components([(v, v) for v in values])
    for rows in (16, 1024):
        links = simhash.links(df, block_rows=rows, chunk_rows=64).collect()
        linked = brute_components([(v, v) for v in values], -1) | {}
        parent = dict(linked)

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for r in links:
            a, b = find(r.a % (1 << 64)), find(r.b % (1 << 64))
            parent[max(a, b)] = min(a, b)
        assert {v: find(v) for v in values} == want
        assert len(links) < 20 * len(values)  # spanning links, not all pairs


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1101)]
    found = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert len(found) == 202 and len({r.root for r in found}) == 2
    assert len({r.root for r in found if r.node <= 100}) == 1
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    rows = simhash.near_duplicates(docs(spark, ODD)).collect()
    assert len(rows) == len(ODD)
    groups = {(r.doc_id, r.component_id) for r in rows}
    assert {(1, 1), (2, 1), (7, 1), (None, 1)} <= groups  # no words: fingerprint zero
    assert {(4, 4), (5, 4)} <= groups
    kept = simhash.keep_first(docs(spark, ODD))
    assert kept.columns == docs(spark, ODD).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "6", "None"]
    assert simhash.keep_first(docs(spark, [])).count() == 0
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
