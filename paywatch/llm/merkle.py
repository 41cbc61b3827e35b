"""Merkle manifest of a documents table: levels kept as one hex string per aligned block, hashed by SQL substrings."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import stage
from paywatch.llm.ordering import dealt, placed

ARITY = 3
# A block holds ARITY ** LEVELS consecutive nodes: 243 digests are 15 kB a level.
LEVELS = 5
BLOCK = ARITY**LEVELS
HEX = 64
# Paths of this many sources, about 2 kB each, are broadcast; more are joined by shuffle.
BROADCAST_PATHS = 10_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that neighbouring fields cannot run into each other."""
    string = value.cast("string")
    return F.when(string.isNull(), "-").otherwise(F.concat(F.octet_length(string).cast("string"), F.lit(":"), string))


def leaf(text: Column | None = None) -> Column:
    """The digest of a document row, or of the row with another text."""
    values = [F.col(c) if c != "text" or text is None else text for c in FIELDS]
    return digest(*map(field, values))


def fold(start: Column, path: Column) -> Column:
    """The digest at the end of a path of sibling segments, from the node it starts at."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def _parents(level: Column) -> Column:
    """The next level: every ARITY consecutive digests become theirs, the last run may have fewer."""
    width = ARITY * HEX
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / width).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * width + 1, F.lit(width)).cast("binary"), 256)), "")


def _height(total: Column) -> Column:
    """Levels above the nodes inside a block: all of them where a group has several blocks, else until one is left."""
    return F.when(total > BLOCK, LEVELS).otherwise(sum(((total > ARITY**i).cast("int") for i in range(LEVELS)), F.lit(0)))


def _blocks(nodes: DataFrame, keep: list[str]) -> DataFrame:
    """(grp, block, total, height, members, levels): at most BLOCK members each, with all levels above them."""
    members = F.array_sort(F.collect_list(F.struct("pos", "node", *keep)))
    held = nodes.groupBy("grp", F.floor(F.col("pos") / BLOCK).alias("block")).agg(F.max("total").alias("total"), members.alias("members"))
    held = held.withColumn("height", _height(F.col("total")))
    first = F.array(F.array_join(F.col("members.node"), ""))
    above = F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), F.col("height"))
    levels = F.aggregate(above, first, lambda held, _: F.array_append(held, _parents(F.element_at(held, -1))))
    return held.withColumn("levels", levels)


def _tiers(nodes: DataFrame, keep: list[str], name: str) -> list[DataFrame]:
    """Blocks of nodes, blocks of the digests of these blocks, and so on until every group is one block."""
    tiers = []
    while True:
        tiers.append(stage(_blocks(nodes, keep), f"{name}-{len(tiers)}"))
        if (tiers[-1].agg(F.max("total")).first()[0] or 0) <= BLOCK:
            return tiers
        several = tiers[-1].where(F.col("total") > BLOCK)
        nodes = several.select("grp", F.col("block").alias("pos"), F.element_at("levels", -1).alias("node"), F.ceil(F.col("total") / BLOCK).alias("total"))
        keep = []


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(grp, root) of every group."""
    parts = [t.where(F.col("total") <= BLOCK).select("grp", F.element_at("levels", -1).alias("root")) for t in tiers]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _own_path() -> Column:
    """Sibling segments of `member` inside its block: what stands left and right of it in its run, level by level."""
    place = F.col("member.pos") % BLOCK

    def segment(level: Column) -> Column:
        digests = F.get("levels", level)
        at = F.floor(place / F.get(F.array(*(F.lit(ARITY**i) for i in range(LEVELS))), level)).cast("int")
        inside = at % ARITY
        left = F.substring(digests, (at - inside) * HEX + 1, inside * HEX)
        return F.struct(left.alias("left"), F.substring(digests, (at + 1) * HEX + 1, (ARITY - 1 - inside) * HEX).alias("right"))

    return F.transform(F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), F.col("height")), segment)


def _paths(tiers: list[DataFrame], ends: DataFrame | None, keep: list[str]) -> DataFrame:
    """(grp, pos, node, *keep, path, *columns of ends): every node of the lowest tier with its way up.

    `ends` (end_grp, end_path, ...) goes on from each group's root. A block's way up is joined to the block, so it
    is not repeated in a shuffle for its members.
    """
    more = [] if ends is None else [c for c in ends.columns if c not in ("end_grp", "end_path")]
    none = F.array().cast(PATH)
    upper = None
    for n, tier in reversed(list(enumerate(tiers))):
        last = tier.where(F.col("total") <= BLOCK)
        if ends is None:
            rows = last.withColumn("upper", none)
        else:
            rows = last.join(ends, F.col("grp").eqNullSafe(F.col("end_grp"))).withColumnRenamed("end_path", "upper").drop("end_grp")
        if upper is not None:
            here = F.col("grp").eqNullSafe(F.col("up_grp")) & (F.col("block") == F.col("up_pos"))
            inner = tier.where(F.col("total") > BLOCK).join(upper, here).drop("up_grp", "up_pos")
            rows = rows.unionByName(inner)
        # Two steps: the path is used several times by callers and must be computed once.
        each = rows.select("grp", "height", "levels", "upper", *more, F.explode("members").alias("member"))
        kept = [F.col(f"member.{c}").alias(c) for c in ("pos", "node", *(keep if n == 0 else []))]
        each = each.select("grp", *kept, F.concat(_own_path(), "upper").alias("path"), *more)
        if n:
            upper = stage(each.select(F.col("grp").alias("up_grp"), F.col("pos").alias("up_pos"), F.col("path").alias("upper"), *more), "ways")
    return each


class Manifest(NamedTuple):
    """Stored levels of every source's tree, of the tree over their roots, and the columns kept beside a leaf."""

    sources: list[DataFrame]
    top: list[DataFrame]
    keep: list[str]

    def subroots(self) -> DataFrame:
        """(source, subroot)."""
        return _roots(self.sources).select(F.col("grp").alias("source"), F.col("root").alias("subroot"))

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return _roots(self.top).select("root")

    def proofs(self) -> DataFrame:
        """(doc_id, source, leaf, *kept columns, path, subroot, root), one row per document row.

        `path` has the sibling segments from the leaf over its source's root to the root, so that
        `fold(leaf, path)` is the root.
        """
        ends = _paths(self.top, None, ["source"])
        ends = stage(ends.select(F.col("source").alias("end_grp"), F.col("path").alias("end_path"), F.col("node").alias("subroot"), fold(F.col("node"), F.col("path")).alias("root")), "ends")
        ends = F.broadcast(ends) if ends.count() <= BROADCAST_PATHS else ends
        rows = _paths(self.sources, ends, self.keep)
        kept = [c for c in self.keep if c != "doc_id"]
        return rows.select("doc_id", F.col("grp").alias("source"), F.col("node").alias("leaf"), *kept, "path", "subroot", "root")


def manifest(docs: DataFrame, beside: Mapping[str, Column] | None = None) -> Manifest:
    """The trees over the rows of a documents table.

    A leaf is the digest of doc_id, source, lang, n_chars and text, in which a null differs from an empty text. Per
    source, a null one included, leaves ascend by doc_id, null first; rows of one id by leaf, so that repeated rows
    are interchangeable. Every ARITY nodes have a parent until one is left; the roots of the sources, ordered by name,
    null first, have a tree of their own. An empty table has no root. Other columns are not read; `beside` gives
    columns that are kept with every leaf. Texts are hashed where they are read and never shuffled, so a very long
    one costs its own size.
    """
    beside = dict(beside or {})
    kept = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("grp"), leaf().alias("node")]
    leaves = docs.select(*kept, *(c.alias(n) for n, c in beside.items()), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "node", "row"]
    rows = placed(dealt(stage(leaves, "leaves"), ["grp", *order], "leaves-dealt"), "grp", order)
    keep = ["doc_id", *beside]
    sources = _tiers(rows, keep, "blocks")
    roots = _roots(sources).select(F.lit(0).alias("grp"), F.col("grp").alias("source"), F.col("root").alias("node"))
    ranked = placed(dealt(stage(roots, "roots"), ["grp", "source"], "roots-dealt"), "grp", ["source"])
    return Manifest(sources, _tiers(ranked, ["source"], "top"), keep)


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)
