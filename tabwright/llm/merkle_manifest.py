"""Merkle manifest of a table: a content-addressed store of digest-to-children records, and proofs
by descent from the root.

H is the lower-case hex sha256 of its inputs, concatenated.  A row's leaf is H of its columns (null:
``-``, else byte count, ``:``, value).  The leaves of a group ascend by the order column; every
``FANOUT`` consecutive nodes become their H until one is left, the group's subroot; the subroots,
ordered by group (null first, bytewise), likewise become the root.

* Building: row numbers come from a range partition (a hot group spans many partitions); a level is
  one ``groupBy`` of at most FANOUT rows a key.  Each level is written as records
  ``digest -> children`` (binary, the children one after the other); equal digests are one record.
* Proofs: requests are (group, rank).  The descent starts at the root and goes level by level: the
  frontier joins the records on the digest, the rank's digit in base FANOUT picks the child, the
  other children join the path, and only nodes that some request passes stay in the frontier.  So
  a node is expanded once however many requests pass it, and the path segments, root first, are
  reversed for the request at the end.

The driver keeps the root, the number of groups and the largest group's size.

Edge cases: null values count in leaves as ``-``; null ids come first; ties of the order column are
ordered by leaf, so rows that are equal in all columns are interchangeable; a lone leaf is its
group's subroot and a lone subroot the root; an empty table has no rows and a null root;
other columns are never touched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import bounded, written
from tabwright.operators.numbering import row_number_within

FANOUT = 16
SHIFT = 4        # FANOUT = 2 ** SHIFT
WIDTH = 32       # bytes of a digest
SEGMENTS = "array<struct<left:binary,right:binary>>"


def digest(*parts: Column) -> Column:
    """H of the parts."""
    return F.sha2(F.concat(*parts), 256)


def hex_text(c: Column) -> Column:
    return F.lower(F.hex(c))


def leaf_of(*values: Column) -> Column:
    text = [v.cast("string") for v in values]
    return digest(*[F.when(v.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in text])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give; ``path`` runs from the leaf to the root."""
    return F.aggregate(path, leaf, lambda acc, s: digest(hex_text(s["left"]), acc, hex_text(s["right"])))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(hex_text(s["left"]), hex_text(s["right"]))), ""), 256)


# -- building ----------------------------------------------------------------------------------
@dataclass
class Forest:
    """The trees of some groups: ``levels[h]`` holds the records of height h + 1; ``tops`` the groups'
    ``gid, n, top`` (their last node)."""
    levels: list[DataFrame]
    tops: DataFrame


@dataclass
class Manifest:
    leaves: DataFrame       # gid, rank, leaf, the carried columns
    groups: DataFrame       # gid, group value, n, place (the group's rank among the subroots)
    trees: Forest           # of the groups
    crown: Forest           # of the subroots
    root: str | None


def grow(nodes: DataFrame, largest: int, name: str) -> Forest:
    """Trees over ``gid, rank, n, node`` (binary digests, ranks from 0, ``n`` leaves in the group)."""
    tops = [nodes.where("n = 1").select("gid", "n", F.col("node").alias("top"))]
    levels, height, below = [], 1, nodes
    while FANOUT ** (height - 1) < largest:
        kids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "node"))),
                                        lambda x: hex_text(x["node"])), "")
        # a group takes part as long as it has several nodes
        level = (below.where(F.col("n") > FANOUT ** (height - 1))
                 .groupBy("gid", F.shiftright("rank", SHIFT).alias("rank"), "n").agg(kids.alias("kids"))
                 .select("gid", "rank", "n", F.unhex(F.sha2("kids", 256)).alias("node"),
                         F.unhex("kids").alias("children")))
        level = written(level, f"{name}-{height}")
        levels.append(level)
        tops.append(level.where(F.col("n") <= FANOUT ** height).select("gid", "n", F.col("node").alias("top")))
        below, height = level, height + 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return Forest(levels, out)


def build(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          order: str = "doc_id", group: str = "source", carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table.  ``carry``: further columns of the leaves' table."""
    extra = [c.alias(f"carry_{k}") for k, c in (carry or {}).items()]
    rows = docs.select(F.col(group).alias("grp"), F.col(order).alias("ord"),
                       leaf_of(*[F.col(c) for c in columns]).alias("leaf"), *extra)
    rows = rows.withColumn("leaf", F.unhex("leaf"))
    # numbers over the whole table: groups ascend (null first), then the order column, then the leaf
    numbered = written(row_number_within(rows, ["grp", "ord", "leaf"], name="g"), "merkle-numbered")
    groups = written(row_number_within(numbered.groupBy("grp").agg(F.min("g").alias("gid"), F.count(F.lit(1)).alias("n")),
                                       ["gid"], name="place"), "merkle-groups")
    n_groups, largest = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    side = bounded(groups.select(F.col("grp").alias("grp2"), "gid", "n"), 128)
    leaves = written(numbered.join(side, F.col("grp").eqNullSafe(F.col("grp2")))
                     .select("gid", (F.col("g") - F.col("gid")).alias("rank"), "n", "leaf", F.col("ord").alias("id"),
                             *[F.col(f"carry_{k}").alias(k) for k in (carry or {})]), "merkle-leaves")
    trees = grow(leaves.select("gid", "rank", "n", F.col("leaf").alias("node")), largest or 0, "merkle-tree")
    sub = (trees.tops.select("gid", "top").join(groups.select("gid", "place"), "gid")
           .select(F.lit(0).cast("long").alias("gid"), F.col("place").alias("rank"),
                   F.lit(n_groups).cast("long").alias("n"), F.col("top").alias("node")))
    crown = grow(written(sub, "merkle-subroots"), n_groups, "merkle-crown")
    last = crown.tops.select(hex_text(F.col("top"))).first()
    return Manifest(leaves, groups, trees, crown, last[0] if last else None)


# -- descent -----------------------------------------------------------------------------------
def records(level: DataFrame) -> DataFrame:
    """The content-addressed store of a level: equal digests have equal children."""
    return level.select("node", "children").dropDuplicates(["node"])


def segment(kids: Column, digit: Column) -> Column:
    """The children but the chosen one."""
    at = (digit * WIDTH).cast("int")
    return F.struct(F.substring(kids, F.lit(1), at).alias("left"),
                    F.substring(kids, at + WIDTH + 1, F.lit(FANOUT * WIDTH)).alias("right"))


def descend(forest: Forest, starts: DataFrame, wanted: DataFrame, *payload: str) -> DataFrame:
    """From every group's top (``starts``: ``gid, n, node, path``) to the wanted ``gid, rank`` (with their
    ``payload``): payload, ``leaf`` and ``path``, whose segments run from the root downwards."""
    keys = [wanted.select("gid", "rank")]
    for _ in forest.levels:  # the nodes of every height that some request passes
        keys.append(keys[-1].select("gid", F.shiftright("rank", SHIFT).alias("rank")).distinct())
    # a lone leaf is its group's top: it has no record and adds no segment
    lone = starts.where("n = 1").select("gid", F.lit(0).cast("long").alias("at"), "node",
                                        F.lit(None).cast("binary").alias("children"), "path")
    front = None
    for h in range(max(1, len(forest.levels)), 0, -1):
        full = lone if h == 1 else None
        if forest.levels:
            new = starts.where((F.col("n") > FANOUT ** (h - 1)) & (F.col("n") <= FANOUT ** h)).select(
                "gid", F.lit(0).cast("long").alias("at"), "node", "path")
            front = new if front is None else front.unionByName(new)
            inner = front.join(records(forest.levels[h - 1]), "node").select("gid", "at", "node", "children", "path")
            full = inner if full is None else inner.unionByName(full)
        below = wanted if h == 1 else keys[h - 1]
        digit, kids = F.pmod("rank", F.lit(FANOUT)), F.col("children")
        step = (full.join(below.withColumn("at", F.shiftright("rank", SHIFT)), ["gid", "at"])
                .withColumn("node", F.when(kids.isNull(), F.col("node")).otherwise(
                    F.substring(kids, (digit * WIDTH + 1).cast("int"), F.lit(WIDTH))))
                .withColumn("path", F.when(kids.isNull(), F.col("path")).otherwise(
                    F.concat("path", F.array(segment(kids, digit))))))
        if h == 1:
            return step.select(*payload, F.col("node").alias("leaf"), "path")
        front = step.select("gid", F.col("rank").alias("at"), "node", "path")


def prove(m: Manifest, requests: DataFrame, *payload: str) -> DataFrame:
    """Requests (``gid, rank`` of leaves, payload) with ``leaf``, ``subroot`` (binary) and ``path`` from leaf to root."""
    no_path = F.array().cast(SEGMENTS)
    if m.root is None:
        return requests.select(*payload, F.lit(None).cast("binary").alias("leaf"),
                               F.lit(None).cast("binary").alias("subroot"), no_path.alias("path")).limit(0)
    top = m.crown.tops.select("gid", "n", F.col("top").alias("node"), no_path.alias("path"))
    asked = m.groups.join(requests.select("gid").distinct(), "gid").select(
        F.lit(0).cast("long").alias("gid"), F.col("place").alias("rank"), F.col("gid").alias("group"),
        F.col("n").alias("size"))
    to_groups = written(descend(m.crown, top, asked, "group", "size"), "merkle-descent")
    starts = to_groups.select(F.col("group").alias("gid"), F.col("size").alias("n"), F.col("leaf").alias("node"), "path")
    found = descend(m.trees, starts, requests.select("gid", "rank", *payload), "gid", *payload)
    sub = to_groups.select(F.col("group").alias("gid"), F.col("leaf").alias("subroot"))
    return (found.join(bounded(sub, 64), "gid")
            .select(*payload, "leaf", "subroot", F.reverse("path").alias("path")))
