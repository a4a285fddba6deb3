"""Manifests against a tree built in plain Python."""

import hashlib

import pytest
from helpers import LONG
from pyspark.sql import functions as F

from wattlake.llm import manifest, queries
from wattlake.llm.common import read


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def proofs(leaves, width):
    """(root, proof of each leaf) of one tree."""
    found, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, at in enumerate(place):
            first = at // width * width
            run = level[first:first + width]
            found[i].append((at - first, run[:at - first] + run[at - first + 1:]))
            place[i] = at // width
        level = [sha("".join(level[i:i + width])) for i in range(0, len(level), width)]
    return level[0], found


def brute(rows, width=16):
    """Rows of (group, key, leaf) to (group, key, leaf, subroot, root, proof), in order."""
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
    groups = {}
    for g, k, leaf in sorted(rows, key=lambda r: (order(r[0]), order(r[1]), r[2])):
        groups.setdefault(g, []).append((k, leaf))
    inside = {g: proofs([leaf for _, leaf in members], width) for g, members in groups.items()}
    root, over = proofs([inside[g][0] for g in groups], width)
    return [(g, k, leaf, inside[g][0], root, inside[g][1][i] + above) for (g, members), above in zip(groups.items(), over)
            for i, (k, leaf) in enumerate(members)]


def told(df):
    return sorted(((r.grp, r.key, r.leaf, r.subroot, r.root, [(s.pos, s.siblings) for s in r.proof]) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(g, k, leaf, "x", 1, "y") for g, k, leaf in rows],
                                 "grp string, key long, leaf string, subroot string, tree int, row string")


CASES = {
    "one row": [("a", 1, sha("1"))],
    "one group of one family": [("a", i, sha(str(i))) for i in range(3)],
    "lone leaves": [(f"s{i:02d}", i, sha(str(i))) for i in range(20)],
    "a hot group": [("hot", i, sha(str(i))) for i in range(700)] + [(f"s{i % 7}", i, sha(f"x{i}")) for i in range(300)],
    "ties, nulls and copies": [(None, None, sha("n")), (None, 1, sha("n")), ("", 5, sha("e")), ("ü", 5, sha("e")), ("z", 5, sha("e"))]
                              + [("a", 7, sha("same"))] * 40 + [("a", 7, sha(str(i))) for i in range(9)],
}


@pytest.mark.parametrize("width", [2, 3, 16])
@pytest.mark.parametrize("name", CASES)
def test_manifest_equals_brute_force(spark, name, width):
    rows = CASES[name] if width == 16 else CASES[name][:90]
    df = frame(spark, rows).repartition(5)
    got = manifest.manifest(df, "grp", "key", "leaf", width)
    assert got.columns == ["grp", "key", "leaf", "tree", "row", "subroot", "root", "proof"]
    assert told(got) == sorted(brute(rows, width), key=repr)
    assert got.where(manifest.folded(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()


def test_no_rows(spark):
    got = manifest.manifest(frame(spark, []), "grp", "key", "leaf")
    assert got.count() == 0 and got.columns[-3:] == ["subroot", "root", "proof"]


def test_deep_trees_and_salted_joins(spark):
    rows = [("hot", i, sha(str(i))) for i in range(1500)] + [("cold", i, sha(f"c{i}")) for i in range(3)]
    got = manifest.manifest(frame(spark, rows), "grp", "key", "leaf", 2)  # eleven levels and more: salted from the third round on
    assert told(got) == sorted(brute(rows, 2), key=repr)


def test_fields_cannot_imitate_each_other(spark):
    rows = [(1, "ab", None), (1, "a", "b"), (None, "-", ""), (None, None, "-"), (12, "ü", LONG)]
    df = spark.createDataFrame(rows, "a long, b string, c string")
    got = {(r.a, r.b, r.c): r.d for r in df.withColumn("d", manifest.row_digest(*[F.col(c) for c in "abc"])).collect()}
    assert got == {r: leaf_of(*r) for r in rows} and len(set(got.values())) == len(rows)


def test_a_changed_leaf_or_proof_is_seen(spark):
    df = manifest.manifest(frame(spark, CASES["a hot group"]), "grp", "key", "leaf")
    changed = df.select(manifest.folded(F.lit(sha("other")), F.col("proof")).alias("f"), "root",
                        manifest.folded(F.col("leaf"), F.slice("proof", 1, 1)).alias("short"))
    assert changed.where("f = root OR short = root").isEmpty()


def test_query_equals_brute_force(spark, sf_dir):
    import zlib
    docs = read(spark, sf_dir, "documents").collect()
    leaves = {d.doc_id: leaf_of(d.doc_id, d.source, d.lang, d.n_chars, d.text) for d in docs}
    wanted = {r[1]: r for r in brute([(d.source, d.doc_id, leaves[d.doc_id]) for d in docs])}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = {d.doc_id: d for d in docs}
    rows = queries.op12_dataset_manifest(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        _, _, leaf, subroot, root, proof = wanted[r.doc_id]
        d, node = texts[r.doc_id], leaf
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and d.text is not None:
            node = leaf_of(d.doc_id, d.source, d.lang, d.n_chars, d.text.translate(lower))
        for pos, siblings in proof:
            node = sha("".join(siblings[:pos] + [node] + siblings[pos:]))
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (leaf, subroot, root, sha("".join("".join(s) for _, s in proof)))
        assert (r.folded_root, r.verified) == (node, node == root)
    assert 0 < sum(not r.verified for r in rows) < len(rows)
