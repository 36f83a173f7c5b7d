"""Merkle manifest of a dataset, with inclusion proofs by pointer jumping.

A row is a leaf: the hash of its fields. The leaves of each group stand in order; every ``FANOUT`` consecutive
nodes of a level become their parent until one is left, the group's subroot; the subroots become the root the same
way. A row's proof is the list of siblings on its way up.

All levels are built bottom-up, one aggregate each. Then every inner node holds the siblings of one step and a
pointer to its parent, and in each round all nodes join the node they point to: they append its siblings and take
over its pointer, so that distances to the root double and ``log2`` of the height rounds are enough. The leaves,
``FANOUT`` times as many as all inner nodes, join their finished parents once, in the last round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, release

FANOUT = 8
#: Nodes that may be broadcast in a round: at most this many, each with the siblings of one way to the root.
FEW = 4096


def digest(texts: Column) -> Column:
    """SHA-256 of a text or binary, as 32 bytes."""
    return F.unhex(F.sha2(texts.cast("binary"), 256))


def joined_hex(digests: Column) -> Column:
    """Digests as lowercase hex, one after the other."""
    return F.array_join(F.transform(digests, lambda x: F.lower(F.hex(x))), "")


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value (integers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_hash(values: list[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``part`` and ``pos``: the row's place, from 0, in the order of the whole table.

    Laid out by ranges and sorted inside them, then written, so that places stay what they are when a task runs
    again. Only the sizes of the ranges (as many as partitions) meet in one task.
    """
    laid = df.withColumn("salt", F.monotonically_increasing_id())  # repeated rows can be parted too
    laid = laid.repartitionByRange(*order, F.col("salt")).sortWithinPartitions(*order, F.col("salt")).drop("salt")
    in_part = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = materialize(laid.withColumns({"part": F.spark_partition_id(), "at": in_part}), name)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return placed.join(F.broadcast(before), "part").withColumn("pos", F.col("before") + F.col("at")).drop("before", "at")


def width(n: Column, level: int) -> Column:
    """Nodes of ``level`` in a tree of ``n`` leaves."""
    return F.ceil(n / F.lit(FANOUT**level)) if level else n


def height(n: int) -> int:
    found = 0
    while FANOUT**found < n:
        found += 1
    return found


def forest(leaves: DataFrame, tallest: int, name: str) -> DataFrame:
    """The inner nodes of all trees, from leaves (tree, n, pos, hash), n being the tree's leaves.

    A row: tree, level, pos, hash, ``kids`` (its children's hashes) and ``way``, the siblings from it up to the
    root, bottom-up and left to right. ``tallest`` is the number of leaves of the largest tree.
    """
    top = height(tallest)
    below, made = leaves, []
    for level in range(1, top + 1):
        again = width(F.col("n"), level - 1) > 1
        kids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"])
        up = (below.where(again).groupBy("tree", "n", F.expr(f"pos div {FANOUT}").alias("up")).agg(kids.alias("kids"))
              .select("tree", "n", F.lit(level).alias("level"), F.col("up").alias("pos"), digest(joined_hex(F.col("kids"))).alias("hash"), "kids"))
        below = materialize(up, f"{name}-level")
        made.append(below)
    if not made:
        empty = "tree long, n long, level int, pos long, hash binary, kids array<binary>, way array<binary>"
        return leaves.sparkSession.createDataFrame([], empty)
    inner = reduce(DataFrame.unionByName, made)
    ways = climbed(inner, top, f"{name}-climb")
    found = materialize(ways.join(inner, ["tree", "level", "pos"]), name)
    release(ways, *made)
    return found


def climbed(inner: DataFrame, top: int, name: str) -> DataFrame:
    """tree, level, pos and ``way`` of every inner node, by pointer jumping."""
    no_way = F.array().cast("array<binary>")
    mine = F.posexplode(F.col("kids")).alias("i", "hash")
    steps = inner.where(F.col("level") > 1).select("tree", "level", "pos", "kids", mine).select(
        "tree", (F.col("level") - 1).alias("level"), (F.col("pos") * FANOUT + F.col("i")).alias("pos"),
        without("kids", F.col("i")).alias("way"), F.col("level").alias("to_level"), F.col("pos").alias("to_pos"))
    roots = inner.where(F.col("level") == tree_height(F.col("n"))).select(
        "tree", "level", "pos", no_way.alias("way"), F.lit(None).cast("int").alias("to_level"), F.lit(None).cast("long").alias("to_pos"))
    nodes = materialize(steps.unionByName(roots), name)
    counts = {r["level"]: r["n"] for r in inner.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a level
    few, room = top + 1, FEW
    while few > 1 and counts[few - 1] <= room:  # the upper levels that are few nodes together
        few -= 1
        room -= counts[few]
    distance = 1
    while distance < top:
        before, nodes = nodes, materialize(jump(nodes, few), name)
        release(before)
        distance *= 2
    return nodes.select("tree", "level", "pos", "way")


def without(kids: str, i: Column) -> Column:
    """``kids`` but for the one at ``i``."""
    return F.concat(F.slice(kids, F.lit(1), i), F.slice(kids, i + 2, F.lit(FANOUT)))


def jump(nodes: DataFrame, few: int) -> DataFrame:
    """One round: every node appends the way of the node it points to and points where that one does.

    Many nodes point to few upper ones: levels from ``few`` on, at most FEW nodes, are broadcast. Below them a node
    is pointed to by at most a share of 1 to FEW / FANOUT of the rows, and the join is dealt by key.
    """
    done = nodes.where(F.col("to_level").isNull())
    far = nodes.select("tree", F.col("level").alias("to_level"), F.col("pos").alias("to_pos"), F.col("way").alias("far"),
                       F.col("to_level").alias("next_level"), F.col("to_pos").alias("next_pos"))
    going = [nodes.where(F.col("to_level") >= few).join(F.broadcast(far.where(F.col("to_level") >= few)), ["tree", "to_level", "to_pos"])]
    if few > 2:
        going.append(nodes.where(F.col("to_level") < few).join(far.where(F.col("to_level") < few), ["tree", "to_level", "to_pos"]))
    moved = [x.select("tree", "level", "pos", F.concat("way", "far").alias("way"), F.col("next_level").alias("to_level"),
                      F.col("next_pos").alias("to_pos")) for x in going]
    return reduce(DataFrame.unionByName, moved, done)


def places(n: Column, pos: Column) -> Column:
    """Per level of a leaf's way up: how many siblings stand left of it (``i``) and how many nodes its run has."""
    powers = F.array(*[F.lit(FANOUT**k).cast("long") for k in range(21)])
    below = F.filter(powers, lambda p: p < n)
    return F.transform(below, lambda p: F.struct(
        F.pmod(F.floor(pos / p), F.lit(FANOUT)).cast("int").alias("i"),
        F.least(F.lit(FANOUT), F.ceil(n / p) - F.floor(pos / (p * FANOUT)) * FANOUT).cast("int").alias("run")))


def folded(leaf: Column, steps: Column, proof: Column) -> Column:
    """The root that follows from ``leaf`` and the siblings of its proof."""
    start = F.struct(leaf.alias("hash"), F.lit(0).alias("at"))

    def up(state: Column, step: Column) -> Column:
        left = F.slice(proof, state["at"] + 1, step["i"])
        right = F.slice(proof, state["at"] + step["i"] + 1, step["run"] - step["i"] - 1)
        return F.struct(digest(joined_hex(F.concat(left, F.array(state["hash"]), right))).alias("hash"),
                        (state["at"] + step["run"] - 1).alias("at"))

    return F.aggregate(steps, start, up, lambda state: state["hash"])


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
             order: str = "doc_id", probe: tuple[str, Column] | None = None) -> DataFrame:
    """Per row: ``order``, leaf, subroot, root, proof (all as bytes), folded_root and verified.

    Leaves stand by ``order`` in their group (null first), rows of equal ``order`` by hash; repeated rows are leaves
    of their own. Groups stand in bytewise order, rows without a group are one and come first. ``probe`` names a
    field and what to read in its place where that isn't null: the leaf of the row so changed is folded with the
    proof of the row as it is, and ``verified`` says whether the root comes out. No rows give no rows; extra
    columns are not looked at.
    """
    picked = docs.select(*dict.fromkeys([*fields, group, order]))
    leaf = record_hash([F.col(f) for f in fields])
    other = F.lit(None).cast("binary")
    if probe is not None:
        other = F.when(probe[1].isNotNull(), record_hash([probe[1] if f == probe[0] else F.col(f) for f in fields]))
    # Texts are read and hashed once; the sampling for the ranges reads the hashes.
    hashed = materialize(picked.select(F.col(group).cast("string").alias("g"), F.col(order).alias("o"), leaf.alias("hash"), other.alias("other")), "leaves")
    placed = numbered(hashed, [F.col("g"), F.col("o"), F.col("hash")], "places")
    release(hashed)
    per_part = materialize(placed.groupBy("part", "g").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")), "runs")
    per_group = per_part.groupBy("g").agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    groups = numbered(per_group, [F.col("g")], "groups").withColumnRenamed("pos", "tree").drop("part")
    sizes = groups.agg(F.count(F.lit(1)).alias("groups"), F.max("n").alias("n")).first()
    # By (part, group), so that the rows of a hot group lie on as many keys as parts.
    runs = per_part.select("part", F.col("g").alias("same")).join(groups, F.col("same").eqNullSafe(F.col("g"))).select("part", "same", "first", "n", "tree")

    def in_trees(by_run: DataFrame) -> DataFrame:
        at = placed.withColumnRenamed("part", "in_part")
        joined = at.join(by_run, (F.col("in_part") == F.col("part")) & F.col("g").eqNullSafe(F.col("same")))
        return joined.withColumn("pos", F.col("pos") - F.col("first"))

    lower = forest(in_trees(runs).select("tree", "n", "pos", "hash"), sizes["n"] or 0, "lower")
    lone = in_trees(runs).where("n = 1").select("tree", "hash")
    subroots = lower.where(F.col("level") == tree_height(F.col("n"))).select("tree", "hash").unionByName(lone)
    subroots = materialize(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(sizes["groups"]).cast("long").alias("n"),
                                           F.col("tree").alias("pos"), "hash"), "subroots")
    upper = forest(subroots, sizes["groups"], "upper")
    no_way = F.array().cast("array<binary>")
    if sizes["groups"] > 1:
        root = upper.where(F.col("level") == height(sizes["groups"])).select(F.col("hash").alias("root"))
        first = upper.where("level = 1").select(F.col("pos").alias("up"), "kids", "way")
        tops = subroots.withColumn("up", F.expr(f"pos div {FANOUT}")).join(first, "up").select(
            F.col("pos").alias("tree"), F.col("hash").alias("subroot"),
            F.concat(without("kids", F.pmod("pos", F.lit(FANOUT)).cast("int")), F.col("way")).alias("top"))
    else:
        root = subroots.select(F.col("hash").alias("root"))
        tops = subroots.select(F.col("pos").alias("tree"), F.col("hash").alias("subroot"), no_way.alias("top"))
    tops = materialize(tops.join(F.broadcast(root)), "tops")  # root is one row
    rows = in_trees(materialize(runs.join(tops, "tree"), "ends"))
    parents = lower.where("level = 1").select(F.col("tree").alias("of"), F.col("pos").alias("up"), "kids", "way")
    rows = rows.join(parents, (F.col("tree") == F.col("of")) & (F.expr(f"pos div {FANOUT}") == F.col("up")), "left")
    own = F.coalesce(F.concat(without("kids", F.pmod("pos", F.lit(FANOUT)).cast("int")), F.col("way")), no_way)
    rows = rows.select(F.col("o").alias(order), F.col("hash").alias("leaf"), "subroot", "root", F.concat(own, "top").alias("proof"),
                       F.coalesce("other", "hash").alias("tried"),
                       F.concat(places(F.col("n"), F.col("pos")), places(F.lit(sizes["groups"]), F.col("tree"))).alias("steps"))
    rows = rows.withColumn("folded_root", folded(F.col("tried"), F.col("steps"), F.col("proof")))
    return rows.select(order, "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tree_height(n: Column) -> Column:
    powers = F.array(*[F.lit(FANOUT**k).cast("long") for k in range(21)])
    return F.size(F.filter(powers, lambda p: p < n))
