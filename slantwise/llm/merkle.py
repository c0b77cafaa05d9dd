"""Hash tree over a dataset: one tree per group of rows, and one over the groups' roots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise.llm.ranks import ordered_index
from slantwise.session import BROADCAST_ROWS, materialize, small_side

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:binary,right:binary>"


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (binary) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _node_digest(*digests: Column) -> Column:
    """Digest (binary) of child digests, which are read as hex text."""
    return F.unhex(F.sha2(F.concat(*map(as_hex, digests)), 256))


def _joined(digests: Column) -> Column:
    """The binary digests of an array, one after another."""
    return F.unhex(F.array_join(F.transform(digests, F.hex), ""))


def sibling_places(place: Column, fanout: int) -> Column:
    """Places of the other nodes under the same parent, some perhaps past the last node."""
    if fanout == 2:
        return F.array(place.bitwiseXOR(F.lit(1)))
    slot = F.pmod(place, F.lit(fanout))
    offsets = F.sequence(F.lit(1), F.lit(fanout - 1))
    return F.transform(offsets, lambda offset: place - slot + F.pmod(slot + offset, F.lit(fanout)))


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes ``(tree, idx, n, hash, load)`` with the siblings on their ``left`` and ``right``.

    Every node names the places of its siblings and meets them in one equijoin; a
    node gathers ``fanout - 1`` rows at most. ``load`` rides along.
    """
    wanted = nodes.select("tree", F.col("idx").alias("me"), "n", F.explode(sibling_places(F.col("idx"), fanout)).alias("idx"))
    met = wanted.where("idx < n").join(nodes.select("tree", "idx", "hash"), ["tree", "idx"])
    none = F.lit(None).cast(nodes.schema["load"].dataType)
    rows = met.select("tree", "me", "n", F.struct("idx", "hash").alias("sibling"), none.alias("load"), F.lit(None).cast("binary").alias("own"))
    own = nodes.select("tree", F.col("idx").alias("me"), "n", F.lit(None).cast("struct<idx:bigint,hash:binary>"), "load", "hash")
    siblings = F.sort_array(F.collect_list("sibling"))
    run = rows.union(own).groupBy("tree", "me", "n").agg(siblings.alias("run"), F.first("load", True).alias("load"), F.first("own", True).alias("hash"))

    def side(before: bool) -> Column:
        kept = F.filter("run", lambda x: (x["idx"] < F.col("me")) if before else (x["idx"] > F.col("me")))
        return _joined(F.transform(kept, lambda x: x["hash"]))

    return run.select("tree", F.col("me").alias("idx"), "n", "hash", "load", side(True).alias("left"), side(False).alias("right"))


def climb(nodes: DataFrame, fanout: int, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the trees with their siblings, lowest first, and ``(tree, level, hash)`` of each root.

    ``most`` is the number of leaves of the largest tree. The row in slot zero of a
    run has all others on its right and emits the parent.
    """
    levels: list[DataFrame] = []
    roots = nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "hash")
    while most > 1:
        level = materialize(with_siblings(nodes.where("n > 1"), fanout), name)
        levels.append(level)
        parent = F.unhex(F.sha2(F.concat(as_hex(F.col("hash")), as_hex(F.col("right"))), 256))
        first = level.where(F.pmod(F.col("idx"), F.lit(fanout)) == 0)
        nodes = first.select(
            "tree",
            F.expr(f"idx div {fanout}").alias("idx"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            parent.alias("hash"),
            F.lit(None).cast(nodes.schema["load"].dataType).alias("load"),
        )
        most = -(-most // fanout)
        roots = roots.union(nodes.where("n = 1").select("tree", F.lit(len(levels)).alias("level"), "hash"))
    return levels, roots


def descend(levels: list[DataFrame], lone: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """``(tree, idx, hash, load, path)`` of all leaves; a path lists each level's siblings up to the top.

    ``above`` has ``(tree, level, path)`` of the roots, ``lone`` the leaves that are
    roots themselves. A node takes over the path of its parent, so each level joins
    with the one above it, an eighth of its size at the usual fan-out.
    """
    known = None
    for number in reversed(range(len(levels) + 1)):
        ended = above.where(F.col("level") == number).select("tree", F.lit(0).cast("long").alias("up"), F.col("path").alias("rest"))
        if number == 0:
            top = lone.join(ended, "tree").select("tree", "idx", "hash", "load", F.col("rest").alias("path"))
        else:
            top = ended.select("tree", F.col("up").alias("idx"), F.col("rest").alias("path"))
        if known is None:
            known = top
            continue
        level = levels[number].withColumn("up", F.expr(f"idx div {fanout}"))
        parents = known.select("tree", F.col("idx").alias("up"), F.col("path").alias("rest"))
        step = F.struct("left", "right").cast(STEP)
        met = level.join(parents, ["tree", "up"]).withColumn("path", F.concat(F.array(step), "rest"))
        known = met.select(*top.columns).unionByName(top)
    return known


def fold(leaf: Column, path: Column) -> Column:
    """Root (hex text) that a leaf (hex text) and its siblings give."""

    def up(below: Column, step: Column) -> Column:
        return F.sha2(F.concat(as_hex(step["left"]), below, as_hex(step["right"])), 256)

    return F.aggregate(path, leaf, up)


def path_digest(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf to the root, left to right."""
    parts = F.transform(path, lambda step: F.concat(as_hex(step["left"]), as_hex(step["right"])))
    return F.sha2(F.array_join(parts, ""), 256)


def _numbered_groups(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """``(g, tree)`` by order of ``g``, the rows of the largest group, and the number of groups."""
    groups = materialize(rows.groupBy("g").agg(F.count("*").alias("leaves")), "merkle-groups")
    most, trees = groups.agg(F.max("leaves"), F.count("*")).first()
    if trees <= BROADCAST_ROWS:
        place = F.row_number().over(Window.orderBy("g")).cast("long") - 1
        numbered = groups.select("g", place.alias("tree"))
    else:
        numbered = ordered_index(groups.withColumn("all", F.lit(0)), "all", [F.col("g")], "merkle-groups").select("g", F.col("idx").alias("tree"))
    return numbered, most or 0, trees


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = LEAF_FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fanout: int = 8,
    found: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Leaf, roots and proof of every row, and whether the row as ``found`` agrees with them.

    A leaf is the digest of ``fields``, each with its length; null reads as ``-``.
    Rows of one ``group_col`` value, by ``id_col``, nulls first, are the leaves of a
    tree with ``fanout`` children a node; the last node of a level may have fewer. The
    trees' roots, by group, null first, are the leaves of the tree on top.

    Returned are ``id_col``, ``group_col``, ``place`` in the group, ``leaf``, ``subroot``,
    ``root``, ``proof`` (siblings left and right on every level), ``proof_sha256``,
    ``folded_root`` and ``verified``. ``found`` gives for some fields what stands in
    them now; a row whose found leaf and siblings don't give the root has changed.

    Rows of one id are ordered by leaf; rows that agree in all fields have
    neighbouring places in any order. Null ids come first. Null, empty and very long
    texts are hashed like all others, inside the row. Other columns are not read, so
    their names don't matter. An empty table gives an empty result.
    """
    leaf = row_digest([F.col(f"`{name}`") for name in fields])
    changed = row_digest([(found or {}).get(name, F.col(f"`{name}`")) for name in fields])
    group = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(
        # A null group sorts before the empty one.
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("g"),
        F.col(f"`{id_col}`").alias("id"),
        leaf.alias("hash"),
        (F.when(changed != leaf, changed) if found else F.lit(None).cast("binary")).alias("changed"),
    )
    rows = materialize(rows, "merkle-rows")
    groups, most, trees = _numbered_groups(rows)
    numbered = rows.join(small_side(groups.select("g", "tree"), trees), "g")
    leaves = ordered_index(numbered, "tree", [F.col("id"), F.col("hash")], "merkle")
    leaves = leaves.select("tree", "idx", "n", "hash", F.struct("id", "g", "changed").alias("load"))
    levels, subroots = climb(leaves, fanout, most, "merkle-level")
    subroots = materialize(subroots, "merkle-subroots")
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("n"), "hash", F.col("level").alias("load"))
    top_levels, roots = climb(tops, fanout, trees, "merkle-top")
    done = roots.select("tree", "level", F.array().cast(f"array<{STEP}>").alias("path"))
    over = descend(top_levels, tops.where("n = 1"), done, fanout)
    above = materialize(over.select(F.col("idx").alias("tree"), F.col("load").alias("level"), F.col("hash").alias("subroot"), "path"), "merkle-over")
    known = descend(levels, leaves.where("n = 1"), above.drop("subroot"), fanout)
    known = known.join(small_side(above.select("tree", "subroot"), trees), "tree")
    root = roots.select(as_hex(F.col("hash")).alias("root")).first()  # one row, or none
    kept = known.select(
        F.col("load.id").alias(id_col),
        F.when(F.col("load.g") != "", F.expr("substring(load.g, 2)")).alias(group_col),
        F.col("idx").alias("place"),
        as_hex(F.col("hash")).alias("leaf"),
        as_hex(F.col("subroot")).alias("subroot"),
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        F.col("path").alias("proof"),
        path_digest(F.col("path")).alias("proof_sha256"),
        fold(as_hex(F.coalesce("load.changed", "hash")), F.col("path")).alias("folded_root"),
    )
    return kept.withColumn("verified", F.col("folded_root") == F.col("root"))
