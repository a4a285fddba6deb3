"""A Merkle manifest of a whole dataset: one tree for each group of rows, a tree over their roots, and a proof for every row.

Rows are ordered by group and key over the whole cluster, and numbered within their group from places inside the tasks and counts of
the tasks before. A level of all trees is then one aggregation: every ``width`` consecutive nodes are a family, whose
digest is the node above. A hot group is dealt by family, so no task holds it.

Proofs come by pointer jumping. Every inner node starts with a segment of one step, its siblings on the way to its parent, and a
pointer to that parent. A self-join gives each node the segment its pointer's end has, put behind its own, and that node's
pointer, so the distance doubles; after a round for each power of two below the height, all point beyond the root. Leaves,
most of all nodes, have their first step by their parent's family and take the parent's whole segment in the last join, so that no
row is moved more than once for its proof. Where thousands of nodes may point to one ancestor, the join is salted.

Defined cases: a null group is a group, ordered first. Rows with the same key and digest are leaves of their own, next to each other;
equal keys are ordered by digest; a null key comes first. No rows give no rows. Texts are digested before anything moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stored

TOP = -1  # the tree over the roots of the groups
SALTS = 4096
_STEP = "struct<pos: int, siblings: array<string>>"


# ---------------------------------------------------------------- digests

def digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes as lowercase hex."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value that no other list of values can imitate: its number of bytes, ``:`` and itself; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def _others(family: Column, pos: Column) -> Column:
    """The members of a family without the one at ``pos``."""
    return F.concat(F.slice(family, F.lit(1), pos), F.slice(family, pos + 2, F.size(family)))


def _step(family: Column, pos: Column) -> Column:
    return F.struct(pos.alias("pos"), _others(family, pos).alias("siblings")).cast(_STEP)


def siblings_of(proof: Column) -> Column:
    """All siblings of a proof, level by level and left to right, as one text."""
    return F.array_join(F.flatten(F.transform(proof, lambda s: s["siblings"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    def up(node, step):
        left = F.slice(step["siblings"], F.lit(1), step["pos"])
        right = F.slice(step["siblings"], step["pos"] + 1, F.size(step["siblings"]))
        return digest(F.concat(F.array_join(left, ""), node, F.array_join(right, "")))

    return F.aggregate(proof, leaf, up)


# ---------------------------------------------------------------- order

def _ordered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` in order over all partitions; ``part`` and ``at`` are a row's partition and its place there. Stored, as
    another run could place equal rows differently."""
    in_order = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return stored(in_order.withColumn("part", F.spark_partition_id()).withColumn("at", place), "ordered")


def _numbered_groups(counts: DataFrame) -> DataFrame:
    """(grp, total, tree, trees): every group with its number of rows, its own number from 0 and the number of groups."""
    groups = _ordered(counts.groupBy("grp").agg(F.sum("n").alias("total")), ["grp"])
    # one number for each partition comes to the driver
    sizes = {r.part: r.n for r in groups.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, passed = [], 0
    for part in sorted(sizes):
        before.append((part, passed))
        passed += sizes[part]
    starts = groups.sparkSession.createDataFrame(before, "part int, passed bigint")
    return groups.join(starts, "part").select(
        "grp", "total", (F.col("passed") + F.col("at")).alias("tree"), F.lit(passed).cast("bigint").alias("trees"))


# ---------------------------------------------------------------- trees

def _climb(nodes: DataFrame, most: int, width: int) -> list[DataFrame]:
    """The families of every level above ``nodes`` (tree, idx, n, digest; n is how many its level of the tree has):
    (tree, level, idx, n, digest, family). ``most`` is the highest n."""
    levels = []
    while most > 1:
        most = -(-most // width)
        families = (
            nodes.where("n > 1")
            .groupBy("tree", F.expr(f"idx div {width}").alias("above"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("members"), F.first("n").alias("n"))
            .select("tree", F.lit(len(levels) + 1).alias("level"), F.col("above").alias("idx"),
                    F.ceil(F.col("n") / width).cast("bigint").alias("n"), F.col("members.digest").alias("family"))
            .withColumn("digest", digest(F.array_join("family", "")))
        )
        nodes = stored(families, "families")
        levels.append(nodes)
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _pointers(nodes: DataFrame, trees: int, width: int, level: Column) -> DataFrame:
    """Adds (p_tree, p_level, p_idx), the parent of a node, null for the root, ``pos``, its place in that family, and
    ``subroot`` for a node that is the root of its group's tree."""
    inside, top = F.col("n") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)
    number = lambda inner, outer: F.when(inside, inner).when(top, outer)
    return nodes.withColumns({
        "p_tree": number(F.col("tree"), F.lit(TOP).cast("bigint")),
        "p_level": number(level + 1, F.lit(1)),
        "p_idx": number(F.expr(f"idx div {width}"), F.expr(f"tree div {width}")),
        "pos": number(F.col("idx") % width, F.col("tree") % width).cast("int"),
        "subroot": F.when(~inside & (F.col("tree") != TOP), F.col("digest")),
    })


def _jumped(inner: DataFrame, trees: int, width: int) -> DataFrame:
    """(tree, level, idx, family, path, subroot): every inner node with its whole proof to the root."""
    parents = inner.select(F.col("tree").alias("p_tree"), F.col("level").alias("p_level"), F.col("idx").alias("p_idx"),
                           F.col("family").alias("p_family"))
    pointer = ["p_tree", "p_level", "p_idx"]
    nodes = stored(
        _pointers(inner.drop("family"), trees, width, F.col("level")).join(parents, pointer, "left")
        .select("tree", "level", "idx", *pointer, "subroot",
                F.when(F.col("p_tree").isNull(), F.array().cast(f"array<{_STEP}>"))
                .otherwise(F.array(_step(F.col("p_family"), F.col("pos")))).alias("path")), "jump")
    distance = 1
    while not nodes.where("p_tree IS NOT NULL").isEmpty():
        # At a distance d up to width^d nodes point to one ancestor.
        salts = 1 if distance < 4 else SALTS
        ends = nodes.where((F.col("level") > distance) | (F.col("tree") == TOP)).select(
            *[F.col(c).alias(f"p_{c}") for c in ("tree", "level", "idx")], *[F.col(p).alias(f"next_{p}") for p in pointer],
            F.col("path").alias("rest"), F.col("subroot").alias("its_subroot"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
        salted = nodes.withColumn("salt", (F.col("idx") % salts).cast("int"))
        doubled = salted.join(ends, [*pointer, "salt"], "left").select(
            "tree", "level", "idx", *[F.col(f"next_{p}").alias(p) for p in pointer],
            F.coalesce("subroot", "its_subroot").alias("subroot"),
            F.when(F.col("rest").isNull(), F.col("path")).otherwise(F.concat("path", "rest")).alias("path"))
        old, nodes = nodes, stored(doubled, "jump")
        forget(old)
        distance *= 2
    return inner.select("tree", "level", "idx", "family").join(
        nodes.select("tree", "level", "idx", "path", "subroot"), ["tree", "level", "idx"])


# ---------------------------------------------------------------- operator

def manifest(rows: DataFrame, group: str, key: str, leaf: str, width: int = 16) -> DataFrame:
    """``rows`` with ``subroot`` (the root of the row's group), ``root`` and ``proof``: from the leaf up, the row's place among its
    siblings and their digests. ``leaf`` is the column with the digest of a row; give narrow rows, as they are moved.

    Columns of these three names are replaced."""
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("subroot", "root", "proof")]
    packed = rows.select(F.struct(*kept).alias("row"), F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"),
                         F.col(f"`{leaf}`").alias("digest"), F.monotonically_increasing_id().alias("tie"))
    in_order = _ordered(packed, ["grp", "key", "digest", "tie"]).drop("key", "tie")
    counts = stored(in_order.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")), "counts")
    groups = stored(_numbered_groups(counts), "groups")
    found = groups.agg(F.max("total").alias("most"), F.max("trees").alias("trees")).first()
    if found.trees is None:
        return rows.select(*kept, *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")],
                           F.lit(None).cast(f"array<{_STEP}>").alias("proof"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    c, g = counts.withColumn("passed", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("c"), groups.alias("g")
    places = c.join(g, F.col("c.grp").eqNullSafe(F.col("g.grp"))).select(
        F.col("c.grp").alias("grp"), F.col("c.part").alias("part"), (F.col("passed") - F.col("first")).alias("shift"),
        "total", "tree").alias("p")
    o = in_order.alias("o")
    leaves = o.join(places, (F.col("o.part") == F.col("p.part")) & F.col("o.grp").eqNullSafe(F.col("p.grp"))).select(
        "row", "digest", "tree", (F.col("at") + F.col("shift")).alias("idx"), F.col("total").alias("n"))
    trees, nodes = found.trees, ["tree", "idx", "n", "digest"]
    levels = _climb(leaves.select(*nodes), found.most, width)
    subroots = _union([frame.select(*nodes) for frame in (leaves, *levels)]).where("n = 1")
    top = _climb(subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"),
                                 F.lit(trees).cast("bigint").alias("n"), "digest"), trees, width)
    root = F.lit((top[-1] if top else subroots).first().digest)
    own = _pointers(leaves, trees, width, F.lit(0))
    if not (levels or top):  # a single row
        return own.select("row.*", "subroot", root.alias("root"), F.array().cast(f"array<{_STEP}>").alias("proof"))
    above = _jumped(_union(levels + top), trees, width).select(
        *[F.col(x).alias(f"p_{x}") for x in ("tree", "level", "idx")], "family", "path", F.col("subroot").alias("its_subroot"))
    proof = F.concat(F.array(_step(F.col("family"), F.col("pos"))), F.col("path"))
    return own.join(above, ["p_tree", "p_level", "p_idx"]).select(
        "row.*", F.coalesce("subroot", "its_subroot").alias("subroot"), root.alias("root"), proof.alias("proof"))
