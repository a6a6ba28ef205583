"""A Merkle manifest of a dataset, with a proof for every row.

Rows are leaves of one tree for each group, by id; the groups' roots are leaves of one tree more. Two consecutive nodes, or a
last single one, become their hash, level by level. A leaf's place and the size of its group say which siblings
its proof needs: level and place of each, looked up in the written table of nodes, put in order and folded into the leaf.

No tree is built or read in one task. Leaves are numbered by ranges; FAN levels at a time, nodes of one block of 2^FAN become an array
and then the levels above them. A proof is looked up in the same steps: a node finds the siblings of the FAN levels
above it in its own block, and what lies higher is the proof of the block's top node, which all nodes of the block share.
So a leaf makes FAN coordinates however large its tree is, a node is wanted by 2^FAN others at most, and large groups need no
key that is common to all of their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stash, table

#: Levels that are built, and looked up, in one step: blocks of 256 nodes.
FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """H: binary sha256 of the concatenated parts; digests go in as lower-case hex text."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(hash: Column) -> Column:
    return F.lower(F.hex(hash))


def _written(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return digest(*(_written(c) for c in fields.values()))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``i``, the place of a row in its ``tree`` from 0 by ``order``, and ``n``, the tree's rows.

    Rows are sorted in ranges of (tree, order), whatever the sizes of trees, and each range's rows start where those of the ranges
    before it end. ``rows`` must be a stash, as ranges are chosen from a sample of it.
    """
    at, part = F.col("__at"), F.shiftright("__at", 33)
    ranged = stash(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("__at", F.monotonically_increasing_id()))
    runs = ranged.groupBy("tree", part.alias("__range")).agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    ranges = Window.partitionBy("tree")  # one row for each range that holds a part of the tree
    before = F.coalesce(F.sum("__rows").over(ranges.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("tree", "__range", (before - F.col("__first")).alias("__shift"), F.sum("__rows").over(ranges).alias("n"))
    return ranged.withColumn("__range", part).join(starts, ["tree", "__range"]).withColumn("i", at + F.col("__shift")).drop("__at", "__range", "__shift")


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves: none above a single one."""
    return F.when(n < 2, 0).otherwise(F.length(F.bin(n - 1)))


def up(place: Column, levels: Column | int) -> Column:
    """The place of the node so many levels above a place."""
    return F.call_function("shiftright", place, F.lit(levels).cast("int"))


def _parents(nodes: Column) -> Column:
    """Hashes of one level from those of the level below."""
    pair = lambda j: digest(hexed(nodes[2 * j]), F.coalesce(hexed(F.get(nodes, 2 * j + 1)), F.lit("")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), pair)


def blocks_of(base: DataFrame) -> DataFrame:
    """(tree, n, block, levels, top) of ``base`` (tree, i, n, hash): the nodes of a block by level, and the one above them.

    A tree of at most one block ends with its root; its nodes have as many levels as the tree.
    """
    rows = base.groupBy("tree", "n", up(F.col("i"), FAN).alias("block")).agg(F.array_sort(F.collect_list(F.struct("i", "hash"))).alias("__all"))
    rows = rows.select("tree", "n", "block", F.transform("__all", lambda x: x["hash"]).alias("__0"))
    for s in range(1, FAN + 1):
        none = F.array().cast("array<binary>")
        rows = rows.withColumn(f"__{s}", F.when(height(F.col("n")) >= s, _parents(F.col(f"__{s - 1}"))).otherwise(none))
    levels = F.filter(F.array(*(f"__{s}" for s in range(FAN + 1))), lambda x: F.size(x) > 0)
    full = rows.select("tree", "n", "block", levels.alias("__levels"))
    return full.select("tree", "n", "block", F.slice("__levels", 1, F.size("__levels") - 1).alias("levels"), F.element_at("__levels", -1)[0].alias("top"))


def build(leaves: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(nodes, blocks above them) in steps of FAN levels, from the leaves (tree, i, n, hash) to the roots; blocks are written tables."""
    steps, base = [], leaves
    while True:
        blocks = stash(blocks_of(base.select("tree", "i", "n", "hash")))
        steps.append((base, blocks))
        if blocks.where("block > 0").isEmpty():
            return steps
        base = blocks.select("tree", F.col("block").alias("i"), (up(F.col("n") - 1, FAN) + 1).alias("n"), F.col("top").alias("hash"))


def roots(steps: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    return steps[-1][1].select("tree", F.col("top").alias("hash"))


def siblings(base: DataFrame, blocks: DataFrame, payload: list[str]) -> DataFrame:
    """(tree, i, payload, steps): of each node the siblings of the FAN levels above it, in order.

    A step has the sibling's hash, null where the node stands alone, and whether it is the left one.
    """
    i, n, s = F.col("i"), F.col("n"), F.col("__s")
    upto = F.greatest(F.least(height(n), F.lit(FAN)), F.lit(1)).cast("int")
    wanted = F.transform(F.sequence(F.lit(0), upto - 1), lambda level: _sibling(i, n, level))
    coordinates = base.select("tree", "i", "n", F.struct(*payload).alias("__payload"), F.posexplode(wanted).alias("__s", "place"))
    coordinates = coordinates.withColumn("__payload", F.when(s == 0, F.col("__payload")))
    nodes = blocks.select("tree", "block", F.posexplode("levels").alias("__s", "__nodes"))
    nodes = nodes.select("tree", "__s", F.call_function("shiftleft", F.col("block"), (FAN - s).cast("int")).alias("__from"), F.posexplode("__nodes").alias("__k", "hash"))
    nodes = nodes.select("tree", "__s", (F.col("__from") + F.col("__k")).alias("place"), "hash")
    left = up(i, s).bitwiseAND(F.lit(1)) == 1
    found = coordinates.join(nodes, ["tree", "__s", "place"], "left")
    # The one coordinate of a tree's single leaf is no step.
    step = F.when(F.col("n") > 1, F.struct("__s", "hash", left.alias("left")))
    gathered = found.groupBy("tree", "i").agg(F.array_sort(F.collect_list(step)).alias("__steps"), F.first("__payload", ignorenulls=True).alias("__payload"))
    return gathered.select("tree", "i", "__payload.*", F.transform("__steps", lambda x: F.struct(x["hash"].alias("hash"), x["left"].alias("left"))).alias("steps"))


def _sibling(i: Column, n: Column, level: Column) -> Column:
    """Its place, null where the level ends before it."""
    place = up(i, level)
    other = place + 1 - 2 * place.bitwiseAND(F.lit(1))
    return F.when(other <= up(n - 1, level), other)


def paths(steps: list[tuple[DataFrame, DataFrame]], payload: list[str], above: DataFrame) -> DataFrame:
    """(tree, payload, path, and what ``above`` has) of every leaf: its siblings up to the root, then the root's own path.

    ``above`` has a row for each tree: tree, path and further columns.
    """
    known = above.withColumn("i", F.lit(0).cast("bigint"))
    further = [c for c in above.columns if c not in ("tree", "path")]
    for at, (base, blocks) in reversed(list(enumerate(steps))):
        own = siblings(base, blocks, payload if at == 0 else [])
        parent = known.select(F.col("tree").alias("__tree"), F.col("i").alias("__i"), F.col("path").alias("__path"), *further)
        met = own.join(parent, (F.col("tree") == F.col("__tree")) & (up(F.col("i"), FAN) == F.col("__i")))
        known = met.select("tree", "i", *(payload if at == 0 else []), F.concat("steps", "__path").alias("path"), *further)
    return known.drop("i")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def one(below: Column, step: Column) -> Column:
        own, other = hexed(below), F.coalesce(hexed(step["hash"]), F.lit(""))
        return digest(F.when(step["left"], F.concat(other, own)).otherwise(F.concat(own, other)))

    return F.aggregate(path, leaf, one)


def proof_text(path: Column) -> Column:
    """The siblings of a path as hex text, one after the other."""
    return F.array_join(F.transform(path, lambda x: F.coalesce(hexed(x["hash"]), F.lit(""))), "")


def with_proofs(docs: DataFrame, hashes: dict[str, Column], key: str = "doc_id", group: str = "lang") -> DataFrame:
    """``key``, the hashes, subroot, root (binary) and path of every row of ``docs``.

    ``hashes`` are the leaf, named ``leaf``, and whatever else is to be kept by the row. Groups are ordered by the bytes of their
    names, null first, rows by key, null first, then by leaf; of rows alike in all of that each has a place and a path of its own.
    An empty table gives an empty one.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    rows = stash(docs.select(F.col(key).alias("__key"), tree.alias("tree"), *(c.alias(n) for n, c in hashes.items())).withColumn("__tie", F.monotonically_increasing_id()))
    steps = build(numbered(rows, "__key", "leaf", "__tie").withColumn("hash", F.col("leaf")))
    groups = stash(roots(steps).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"))
    top = build(numbered(groups, "group"))
    none = F.array().cast("array<struct<hash:binary,left:boolean>>")
    above = paths(top, ["group", "hash"], roots(top).select("tree", F.col("hash").alias("root"), none.alias("path")))
    above = above.select(F.col("group").alias("tree"), F.col("hash").alias("subroot"), "root", "path")
    found = paths(steps, ["__key", *hashes], above)
    return found.select(F.col("__key").alias(key), *hashes, "subroot", "root", "path")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document; by language, then by doc_id.

    A tampered copy of a leaf has 1 more in n_chars where 7 divides the checksum of its id; null ids and null n_chars stay as they are.
    Repeated rows are leaves of their own; null fields, empty and long texts are hashed like others; further columns are left out.
    """
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = leaf_hash(fields | {"n_chars": F.col("n_chars") + 1})
    proved = with_proofs(docs, {"leaf": leaf_hash(fields), "other": F.when(hit & F.col("n_chars").isNotNull(), more)})
    folded_root = folded(F.coalesce("other", "leaf"), F.col("path"))
    out = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")).cast("binary"), 256).alias("proof_sha256"), folded_root.alias("folded_root"))
    return out.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"), "proof_sha256",
        hexed(F.col("folded_root")).alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"),
    )
