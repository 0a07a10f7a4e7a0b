"""Merkle manifest of a dataset: leaves of rows, one tree per language, a tree of their roots, proofs.

A level of a tree is kept as strings. Every aligned block of ``1 << BITS`` nodes is one
row whose level is the joined hex digests of its nodes; parents are hashes of fixed-width
substrings of that string, and the levels of a block are made from it one after the other up to
the block's single root. Roots of blocks are the nodes of the next round, until every
tree has one. The siblings of a node are the substrings beside it in its block's levels, so
a proof is the segments of the rounds put together. Strings are held as bytes: a substring of bytes
costs the same at any place.

Leaves are put in order by ranges of (group, order), numbered inside each range, and moved
up by the rows of the ranges before, so a hot language is many tasks; no group is sorted or gathered as a whole.
Rounds divide the rows by ``1 << BITS``: four of them hold 10^12 leaves. Each round is a written table.

``H`` is the lower-case hex sha256 of its inputs joined, digests as their hex text. Runs are two nodes; the last one
may be a single node and becomes ``H`` of it alone. A lone leaf is its tree's root.

Nulls: a null column counts as ``-``; null languages are a tree of their own, which comes first; a
null doc_id comes before all others of its language and has no number, so its row is not tampered with. Rows under one doc_id are ordered by their leaf; equal rows are equal leaves in
places of their own, each with its own proof. An empty table gives an empty one.
Only the five columns are read, so extra columns may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.sources.workspace import settle

BITS = 10  # levels in a block
DIGEST = 64  # hex letters
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*inputs: Column) -> Column:
    return F.sha2(F.concat(*[i.cast("binary") for i in inputs]), 256)


def field(value: Column) -> Column:
    """A value as its length in UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    return digest(*[field(columns[name]) for name in FIELDS])


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with their ``place`` in the ascending order of their group, from 0 without a gap, and the group's ``size``.

    ``rows`` must be a written table; ``order`` should tell rows apart, so that ranges stay even.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    at = F.monotonically_increasing_id()
    sorted_rows = settle(ranged.withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)), "sorted")
    parts = sorted_rows.groupBy(group, "__part").agg(F.min("__at").alias("__least"), F.count(F.lit(1)).alias("__n"))
    of = Window.partitionBy(group)
    before = of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col(group).alias("__group"), F.col("__part").alias("__of"), "__least",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), F.sum("__n").over(of).alias("size"),
    )
    joined = sorted_rows.join(parts, sorted_rows[group].eqNullSafe(parts["__group"]) & (sorted_rows["__part"] == parts["__of"]))
    place = F.col("__before") + F.col("__at") - F.col("__least")
    return joined.withColumn("place", place).drop("__at", "__part", "__group", "__of", "__least", "__before")


def _parents(level: Column) -> Column:
    """The next level's string: hashes of two nodes each, in order."""
    pair = 2 * DIGEST
    starts = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / pair).cast("int"))
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i * pair + 1, F.lit(pair)), 256)), "").cast("binary")


def _levels(blocks: DataFrame, bits: int) -> DataFrame:
    """``levels`` of every block, lowest first. A group's only block ends at one node, others go on to the common height."""
    need = F.ceil(F.log2(F.col("size"))).cast("int")
    height = F.when(F.col("size") > 1 << bits, F.lit(bits)).otherwise(need)
    grown = F.aggregate(
        F.array_repeat(F.lit(0), height), F.array("level"), lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1))))
    )
    return blocks.withColumn("levels", grown).withColumn("node", F.element_at("levels", -1).cast("string")).drop("level")


def _path(levels: Column, inside: Column) -> Column:
    """(sibling, left) of the node at place ``inside`` in every level but the last; an absent sibling is the empty string."""
    heights = F.sequence(F.lit(0), F.size(levels) - 2)

    def step(j: Column) -> Column:
        at = F.call_function("shiftright", inside, j).cast("int")
        beside = at.bitwiseXOR(F.lit(1))
        sibling = F.substring(F.element_at(levels, j + 1), beside * DIGEST + 1, F.lit(DIGEST)).cast("string")
        return F.struct(sibling.alias("sibling"), (beside < at).alias("left"))

    empty = F.array().cast("array<struct<sibling: string, left: boolean>>")
    return F.when(F.size(levels) > 1, F.transform(heights, step)).otherwise(empty)


def trees(nodes: DataFrame, group: str, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks over (group, place, size, node), and (group, node) of every group's root.

    A round's block has ``block``, its ``levels`` and the number ``size`` of its group's nodes in that round.
    """
    rounds, width = [], 1 << bits
    level = nodes.select(group, "place", "size", "node")
    while True:
        of = level.groupBy(group, F.call_function("shiftright", F.col("place"), F.lit(bits)).alias("block"))
        run = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "node"))), lambda n: n["node"]), "")
        blocks = settle(_levels(of.agg(run.cast("binary").alias("level"), F.first("size").alias("size")), bits), "round")
        rounds.append(blocks)
        upper = F.ceil(F.col("size") / width).cast("long")
        level = blocks.select(group, F.col("block").alias("place"), upper.alias("size"), "node")
        if not level.where("size > 1").limit(1).count():
            return rounds, level.select(group, "node")


def paths(nodes: DataFrame, group: str, rounds: list[DataFrame], bits: int = BITS) -> DataFrame:
    """Nodes (group, place, ...) with the ``path`` of (sibling, left) up to their group's root.

    The paths of blocks are found from the last round down, one row a block; only the last join has a row for each node.
    """
    shift = lambda c, n: F.call_function("shiftright", F.col(c), F.lit(n))
    above = None
    for blocks in reversed(rounds):
        wide = blocks.select(F.col(group).alias("__group"), F.col("block").alias("__block"), "levels")
        if above is not None:
            wide = wide.join(above, wide["__group"].eqNullSafe(above["__of"]) & (wide["__block"] == above["__place"])).drop("__of", "__place")
        else:
            wide = wide.withColumn("upper", F.array().cast("array<struct<sibling: string, left: boolean>>"))
        if blocks is rounds[0]:
            break
        size = F.floor(F.octet_length(F.get("levels", 0)) / DIGEST).cast("int")
        each = wide.select("__group", "__block", "levels", "upper", F.explode(F.sequence(F.lit(0), size - 1)).alias("inside"))
        place = F.call_function("shiftleft", F.col("__block"), F.lit(bits)) + F.col("inside")
        above = each.select(F.col("__group").alias("__of"), place.alias("__place"), F.concat(_path(F.col("levels"), F.col("inside")), "upper").alias("upper"))
        above = settle(above, "paths")
    held = nodes.withColumn("__to", shift("place", bits))
    joined = held.join(wide, held[group].eqNullSafe(wide["__group"]) & (held["__to"] == wide["__block"]))
    inside = F.col("place").bitwiseAND(F.lit((1 << bits) - 1))
    return joined.withColumn("path", F.concat(_path(F.col("levels"), inside), "upper")).drop("__to", "__group", "__block", "levels", "upper")


def folded(start: Column, path: Column) -> Column:
    """The root that a node and its siblings give."""

    def up(node: Column, step: Column) -> Column:
        pair = F.when(step["left"], F.concat(step["sibling"], node)).otherwise(F.concat(node, step["sibling"]))
        return F.sha2(pair.cast("binary"), 256)

    return F.aggregate(path, start, up)


def manifest(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) for every row; ``proof`` is the path of (sibling, left)."""
    kinds = {"doc_id": "long", "n_chars": "long"}
    rows = docs.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in FIELDS])
    columns = {c: F.col(c) for c in FIELDS}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = leaf(columns | {"n_chars": F.col("n_chars") + 1})
    original = leaf(columns)
    leaves = rows.select("doc_id", "lang", original.alias("leaf"), F.when(tampered, changed).otherwise(original).alias("shown"))
    # the number of a written row tells equal rows apart, so no range holds more of them than another
    leaves = settle(leaves.withColumn("nr", F.monotonically_increasing_id()), "leaves")
    in_place = settle(placed(leaves, "lang", ["doc_id", "leaf", "nr"]).drop("nr"), "places")
    rounds, subroots = trees(in_place.withColumn("node", F.col("leaf")), "lang", bits)
    tops = settle(subroots.withColumn("all", F.lit(0)).withColumnRenamed("node", "subroot"), "subroots")
    tops = settle(placed(tops, "all", ["lang"]).withColumn("node", F.col("subroot")), "tops")
    over, root = trees(tops, "all", bits)
    tops = paths(tops, "all", over, bits).join(root.select("all", F.col("node").alias("root")), "all")
    tops = tops.select(F.col("lang").alias("__lang"), "subroot", "root", F.col("path").alias("above"))
    found = paths(in_place, "lang", rounds, bits)
    found = found.join(tops, found["lang"].eqNullSafe(tops["__lang"])).withColumn("proof", F.concat("path", "above"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof", folded(F.col("shown"), F.col("proof")).alias("folded_root"))


def verified(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row."""
    made = manifest(docs, bits)
    siblings = F.array_join(F.transform("proof", lambda s: s["sibling"]), "")
    proof = F.sha2(siblings.cast("binary"), 256).alias("proof_sha256")
    return made.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_field(name: str) -> str:
    return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(n_chars if f == "n_chars" else f) for f in FIELDS) + ")"


_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), "
    "lambda r, b: list_reduce(list_prepend(xor(r, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"
)


def _sql_tree(name: str, start: str, group: str) -> str:
    """All levels of the trees over ``start`` (group, i, h), and the path of every node of level 0."""
    return f"""{name} AS (
  SELECT 0 AS level, {group}, i, h, count(*) OVER (PARTITION BY {group}) AS n FROM {start}
  UNION ALL
  SELECT level + 1, {group}, i // 2, sha256(string_agg(h, '' ORDER BY i)), (max(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY level, {group}, i // 2
), {name}_path AS (
  SELECT s.{group}, s.i, string_agg(coalesce(b.h, ''), '' ORDER BY a.level) AS siblings,
    list(coalesce(b.h, '') ORDER BY a.level) AS path, list(a.i % 2 = 1 ORDER BY a.level) AS lefts
  FROM {start} s JOIN {name} a ON a.{group} IS NOT DISTINCT FROM s.{group} AND a.i = s.i >> a.level AND a.n > 1
  LEFT JOIN {name} b ON b.level = a.level AND b.{group} IS NOT DISTINCT FROM a.{group} AND b.i = xor(a.i, 1) GROUP BY 1, 2
), {name}_root AS (
  SELECT {group}, h FROM {name} WHERE n = 1
)"""


MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_sql_leaf("n_chars")} AS h,
    CASE WHEN {_CRC} % 7 = 0 THEN {_sql_leaf("(n_chars + 1)")} ELSE {_sql_leaf("n_chars")} END AS shown FROM documents
), first AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS BIGINT) AS i FROM leaves
), {_sql_tree("low", "first", "lang")}, tops AS (
  SELECT lang, h, 0 AS k, CAST(row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS i FROM low_root
), {_sql_tree("high", "tops", "k")}, whole AS (
  SELECT f.doc_id, f.h AS leaf, f.shown, t.h AS subroot, r.h AS root,
    coalesce(p.siblings, '') || coalesce(q.siblings, '') AS siblings,
    list_concat(coalesce(p.path, []), coalesce(q.path, [])) AS path, list_concat(coalesce(p.lefts, []), coalesce(q.lefts, [])) AS lefts
  FROM first f JOIN tops t ON t.lang IS NOT DISTINCT FROM f.lang CROSS JOIN high_root r
  LEFT JOIN low_path p ON p.lang IS NOT DISTINCT FROM f.lang AND p.i = f.i LEFT JOIN high_path q ON q.i = t.i
), done AS (
  SELECT *, list_reduce(list_prepend(shown, list_transform(list_zip(path, lefts), lambda s: CASE WHEN s[2] THEN '<' || s[1] ELSE '>' || s[1] END)),
    lambda node, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || node ELSE node || s[2:] END)) AS folded_root FROM whole
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified FROM done
"""
