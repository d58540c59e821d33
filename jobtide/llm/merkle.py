"""Merkle manifest of a table: a content-addressed store of segments, and proofs by descent from the root.

A leaf is the digest of a row's columns; each is written as ``-`` if null, else as its number of UTF-8
bytes, ``:`` and its text.  The leaves of a group (a language) ascend by id; two consecutive nodes make the
next level's node, a last node without a partner makes one alone, until one is left, the group's subroot (a lone leaf
is its own).  Subroots, null group first and the rest in the order of their bytes, make the root likewise.

**Store.** Segments of ``LEVELS`` levels are made at once: a record takes the digest of a node to its
(at most 1,024) descendants that many levels below, its children.  A tree of a billion leaves takes three
rounds, whose rows shrink by a thousand each.

**Descent.** A request is a leaf's place in its group.  Requests go down from the root; requests that share
a digest travel as one row until their ways part, so no digest is a hot key.  At a record the next digit of
the place (base 1,024) selects a child, and the unselected siblings on the way to it are collected, one per
level.  The segments of a path stand from the root down; reversed they are the proof from the leaf up.

Only two numbers reach the driver (the heights of the tallest group and of the tree of groups).

Results for odd input: null values count as above; rows with a null id come first and are never
tampered with; rows with equal ids are ordered by their leaf, repeated rows have a leaf each; an empty
table gives an empty table; extra columns of any name are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobtide.llm.tables import DOCUMENT_COLUMNS, Scratch
from jobtide.operators.once import evaluate_once

LEVELS = 10  # of one segment
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED_ONE_IN = 7


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row by the given columns, in this order."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def _height(nodes: Column) -> Column:
    """Levels above so many nodes: the binary digits of the last one's place."""
    return F.when(nodes > 1, F.length(F.bin(nodes - 1))).otherwise(0).cast("int")


def _next_level(nodes: Column) -> Column:
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(nodes) - 1, 1))
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))


def _top(children: Column, levels: Column) -> Column:
    return F.get(F.aggregate(F.sequence(F.lit(1), levels), children, lambda nodes, _: _next_level(nodes)), F.lit(0))


def _all_levels(children: Column, levels: Column) -> Column:
    """The children and the levels above them, but for the top."""
    below = F.when(levels > 1, F.sequence(F.lit(2), levels)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(below, F.array(children), lambda made, _: F.concat(made, F.array(_next_level(F.element_at(made, -1)))))


def _unselected(nodes: Column, levels: Column, child: Column) -> Column:
    """Siblings on the way down to a child: one entry per level, null where a node has none."""

    def sibling(level: Column) -> Column:
        place = F.call_function("shiftright", child, level)
        other = place.bitwiseXOR(F.lit(1))
        return F.struct(F.get(F.get(nodes, level), other).alias("digest"), (other < place).alias("before"))

    return F.transform(F.sequence(levels - 1, F.lit(0), F.lit(-1)), sibling)


def ranked(rows: DataFrame, group: str, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """The rows with ``index``, their place in their group, and ``nodes``, the number of rows in it.

    The rows are sorted into ranges over all groups, so a group that holds most rows is many ranges; places
    are taken inside the ranges and moved by the counts of earlier ones.
    """
    apart = rows.withColumn("copy", F.monotonically_increasing_id())
    sorted_rows = apart.repartitionByRange(group, *order, "copy")
    held = scratch.store(sorted_rows.withColumn("range", F.spark_partition_id()), "ranges")
    counts = held.groupBy(group, "range").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    moves = counts.select(group, "range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("nodes"))
    inside = F.row_number().over(Window.partitionBy(group, "range").orderBy(*order, "copy"))
    placed = held.withColumn("index", inside.cast("bigint") - 1).join(moves, [group, "range"])
    return placed.withColumn("index", F.col("index") + F.col("before")).drop("range", "copy", "before")


def build(nodes: DataFrame, tallest: int, scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """(tree, height, digest) of each tree's top, and the records (digest, children, levels) of all segments.

    ``nodes`` has tree, index, digest and height (levels of its tree); records are None where no tree has a level.
    """
    tops = nodes.where("height = 0").select("tree", "height", "digest")
    records = None
    for done in range(0, tallest, LEVELS):
        sharing = nodes.where(F.col("height") > done).groupBy("tree", "height", F.expr(f"shiftright(index, {LEVELS})").alias("index"))
        children = F.transform(F.sort_array(F.collect_list(F.struct("index", "digest"))), lambda one: one["digest"])
        made = sharing.agg(children.alias("children")).withColumn("levels", F.least(F.lit(LEVELS), F.col("height") - done))
        made = scratch.store(made.withColumn("digest", _top(F.col("children"), F.col("levels"))), "segments")
        tops = tops.unionByName(made.where(F.col("height") <= done + LEVELS).select("tree", "height", "digest"))
        records = made if records is None else records.unionByName(made)
        nodes = made.select("tree", "index", "digest", "height")
    if records is not None:
        records = records.select("digest", "children", "levels").dropDuplicates(["digest"])
    return tops, records


def descend(starts: DataFrame, records: DataFrame | None, tallest: int) -> DataFrame:
    """Rows (tree, index, path, leaves) that hold the proofs of the lowest segments.

    ``starts`` has tree, height, digest and path (siblings met on the way from the root down).  ``leaves`` lists
    the children of the lowest segment ``index`` of the tree with their own siblings; for a tree without
    levels it is its only leaf.
    """
    no_siblings = F.array().cast("array<struct<digest:string,before:boolean>>")
    at_leaf = starts.where("height = 0").select(
        "tree", F.lit(0).cast("bigint").alias("index"), "path", F.array(F.struct("digest", no_siblings.alias("siblings"))).alias("leaves")
    )
    if records is None:
        return at_leaf
    front = None
    for segment in reversed(range(-(-tallest // LEVELS))):
        tops = starts.where((F.col("height") > segment * LEVELS) & (F.col("height") <= (segment + 1) * LEVELS))
        tops = tops.select("tree", F.lit(0).cast("bigint").alias("index"), "digest", "path")
        front = tops if front is None else front.unionByName(tops)
        opened = evaluate_once(front.join(records, "digest"), "nodes", _all_levels(F.col("children"), F.col("levels")))
        each = F.transform(
            F.col("children"),
            lambda digest, child: F.struct(digest.alias("digest"), _unselected(F.col("nodes"), F.col("levels"), child).alias("siblings")),
        )
        opened = opened.select("tree", "index", "path", each.alias("leaves"))
        if segment:
            parted = opened.select("tree", "index", "path", F.posexplode("leaves").alias("digit", "child"))
            below = F.expr(f"shiftleft(index, {LEVELS})") + F.col("digit")
            front = parted.select("tree", below.alias("index"), "child.digest", F.concat("path", "child.siblings").alias("path"))
    return opened.unionByName(at_leaf)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof (from the leaf up) lead to."""

    def up(digest: Column, step: Column) -> Column:
        other = F.coalesce(step["digest"], F.lit(""))
        return F.sha2(F.when(step["before"], F.concat(other, digest)).otherwise(F.concat(digest, other)), 256)

    return F.aggregate(proof, leaf, up)


def manifest(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Each row of ``leaves`` with subroot, root and proof.

    ``leaves`` has group (string or null), id and leaf, and any other columns.  ``proof`` lists from the leaf up, for each
    level, the sibling's digest (null where there is none) and whether it stands before.
    """
    # null sorts before every named group
    keyed = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), "group"), F.lit("-")))
    placed = scratch.store(ranked(keyed, "tree", ["id", "leaf"], scratch).withColumn("height", _height(F.col("nodes"))), "leaves")
    tallest = placed.agg(F.max("height")).first()[0]
    if tallest is None:
        no_proof = F.lit(None).cast("array<struct<digest:string,before:boolean>>")
        return leaves.withColumns({"subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string"), "proof": no_proof})
    tops, records = build(placed.select("tree", "index", F.col("leaf").alias("digest"), "height"), tallest, scratch)
    tops = scratch.store(tops, "subroots")

    # the tree of groups, by the same steps
    groups = ranked(tops.select(F.lit("").alias("all"), "tree", "digest", F.col("height").alias("below")), "all", ["tree"], scratch)
    groups = scratch.store(groups.withColumn("height", _height(F.col("nodes"))), "groups")
    tall = groups.agg(F.max("height")).first()[0]
    root, above = build(groups.select(F.col("all").alias("tree"), "index", "digest", "height"), tall, scratch)
    root = scratch.store(root, "root")
    no_path = F.array().cast("array<struct<digest:string,before:boolean>>")
    ways = descend(root.withColumn("path", no_path), above, tall).select("index", "path", F.posexplode("leaves").alias("digit", "child"))
    ways = ways.select((F.expr(f"shiftleft(index, {LEVELS})") + F.col("digit")).alias("index"), F.concat("path", "child.siblings").alias("path"))
    only_root = F.broadcast(root.select(F.col("tree").alias("all"), F.col("digest").alias("root")))
    starts = groups.join(ways, "index").join(only_root, "all")
    starts = scratch.store(starts.select("tree", F.col("below").alias("height"), "digest", "path", "root"), "starts")

    # requests of one lowest segment meet its proofs as one row
    others = [c for c in placed.columns if c not in ("tree", "index", "nodes", "height")]
    sharing = placed.groupBy("tree", F.expr(f"shiftright(index, {LEVELS})").alias("index"))
    requests = sharing.agg(F.collect_list(F.struct(F.col("index").bitwiseAND((1 << LEVELS) - 1).cast("int").alias("digit"), *others)).alias("requests"))
    subroots = starts.select("tree", F.col("digest").alias("subroot"), "root")
    met = requests.join(descend(starts, records, tallest), ["tree", "index"]).join(subroots, "tree")
    one = met.select("subroot", "root", "path", "leaves", F.explode("requests").alias("one"))
    proof = F.reverse(F.concat("path", F.get(F.col("leaves"), F.col("one.digit"))["siblings"]))
    return one.select(*[F.col("one")[c].alias(c) for c in others], "subroot", "root", proof.alias("proof"))


def report(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, digest of the proof, and whether the row as found now still leads to the root."""
    doc_id, source, lang, n_chars, text = (F.col(c) for c in FIELDS)
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED_ONE_IN == 0
    leaf = leaf_digest(doc_id, source, lang, n_chars, text)
    found = F.when(tampered, leaf_digest(doc_id, source, lang, n_chars + 1, text))
    leaves = docs.select(*DOCUMENT_COLUMNS).select(lang.alias("group"), doc_id.alias("id"), leaf.alias("leaf"), found.alias("found"))
    proven = manifest(leaves, Scratch(docs.sparkSession, "merkle"))
    proven = proven.withColumn("folded_root", folded(F.coalesce("found", "leaf"), F.col("proof")))
    siblings = F.concat_ws("", F.transform("proof", lambda step: step["digest"]))
    return proven.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings, 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
