"""Merkle manifest of a dataset with octopus multiproofs.

Every row is a leaf.  The leaves of a group (a language) are numbered by id; every
``ARITY`` consecutive nodes become their hash, level by level, up to the group's
subroot.  The subroots, in order of their groups, are the leaves of a second tree,
whose top is the root of the dataset.

* Leaves are hashed at the scan; only ids and digests move after that.  They are
  range-partitioned by (group, id), so a group of any size is numbered by many tasks:
  a place in the partition plus the counts of the partitions before it.
* Leaf partitions are blocks of ``ARITY**LEVELS`` consecutive leaves of a group, one
  shuffle builds ``LEVELS`` levels at a time, and a group's node store is a table by
  level.
* Multiproof: each leaf partition works out which node coordinates it needs and can't
  derive from its own leaves (the minimal union over all its leaves' proofs), fetches
  these once by a join, derives the interior nodes that its leaves share, and expands
  the proof of each leaf itself.  Coordinates are asked for once per partition, not
  once per leaf.

Defined results: a null group is a group of its own and the first; a null id is the
first of its group.  Leaves of equal id are ordered by their digests; equal rows are
leaves of their own.  A lone leaf is its subroot, a lone subroot the root, and a proof
without siblings is the hash of the empty text.  An empty table has no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, materialise

ARITY = 8
LEVELS = 4
BLOCK = ARITY**LEVELS
_PART_BITS = 33  # monotonically_increasing_id: the partition stands above these bits
_TOP = "*"       # key of the tree over the subroots; group keys are empty or begin with "="


def field(c: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def digest(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth_of(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return sum((F.when(n > ARITY**k, 1).otherwise(0) for k in range(21)), F.lit(0))


def parents(nodes: Column) -> Column:
    """Digests of the runs of a list of digests."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int")),
                       lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256))


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, ...) with ``pos`` (0, 1, ... by ``order`` within the tree) and ``n``."""
    keys = ["tree", *order, "_m"]
    ranked = leaves.withColumn("_m", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranked = materialise(ranked.drop("_m").withColumn("_seq", F.monotonically_increasing_id()), "merkle-ranked")
    ranked = ranked.withColumn("_part", F.shiftright("_seq", _PART_BITS))
    parts = ranked.groupBy("tree", "_part").agg(F.min("_seq").alias("_start"), F.count("*").alias("_count"))
    # One row per partition and tree in it.
    w = Window.partitionBy("tree")
    before = F.sum("_count").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_start")).alias("_shift"), F.sum("_count").over(w).alias("n"))
    return ranked.join(parts, ["tree", "_part"]).withColumn("pos", F.col("_seq") + F.col("_shift")).drop("_seq", "_part", "_shift")


@dataclass
class Tree:
    """Blocks of leaves (tree, n, depth, block, rows), nodes (tree, level, pos, digest) and
    roots (tree, root) of one or more trees."""
    blocks: DataFrame
    nodes: DataFrame
    roots: DataFrame


def grow(leaves: DataFrame, order: list[str]) -> Tree:
    """Trees over ``leaves`` (tree, leaf, ...), numbered by ``order``."""
    rows = numbered(leaves, order).withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("depth", depth_of(F.col("n")))
    others = [c for c in leaves.columns if c not in ("tree", "leaf")]
    blocks = rows.groupBy("tree", "n", "depth", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "leaf", *others))).alias("rows"))
    blocks = materialise(blocks, "merkle-blocks")
    deepest = blocks.agg(F.max("depth")).first()[0] or 0
    base, level, tables = blocks.withColumn("nodes", F.col("rows.leaf")), 0, []
    while True:
        # Levels level .. level + LEVELS of the trees that reach so far.
        known = base.withColumn("l0", F.col("nodes"))
        for k in range(1, LEVELS + 1):
            known = known.withColumn(f"l{k}", F.when(F.col("depth") >= level + k, parents(F.col(f"l{k - 1}"))))
        each = [F.struct(F.lit(level + k).alias("level"), F.lit(BLOCK // ARITY**k).alias("width"), F.col(f"l{k}").alias("nodes"))
                for k in range(0 if not level else 1, LEVELS + 1)]
        flat = known.select("tree", "n", "depth", "block", F.explode(F.array(*each)).alias("l")).filter("l.nodes is not null")
        flat = flat.select("tree", "n", "depth", F.col("l.level").alias("level"), F.col("block"), F.col("l.width").alias("width"),
                           F.posexplode("l.nodes").alias("i", "digest"))
        flat = flat.select("tree", "n", "depth", (F.col("block") * F.col("width") + F.col("i")).alias("pos"), "digest", "level")
        tables.append(materialise(flat, "merkle-nodes", "level"))
        level += LEVELS
        if deepest <= level:
            break
        up = tables[-1].filter((F.col("level") == level) & (F.col("depth") > level))
        up = up.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("tree", "n", "depth", "block").agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("nodes"))
        base = up.withColumn("nodes", F.col("nodes.digest"))
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.unionByName(t)
    return Tree(blocks, nodes, nodes.filter("level = depth").select("tree", F.col("digest").alias("root")))


def octopus(positions: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Coordinates (level, position) that complete the proofs of all the positions and
    can't be derived from their leaves, in a tree of n leaves."""
    out, known, level = [], np.unique(positions), 0
    while n > 1:
        runs = np.unique(known // ARITY)
        children = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        missing = np.setdiff1d(children[children < n], known)
        out += [(level, int(p)) for p in missing]
        known, n, level = runs, -(-n // ARITY), level + 1
    return out


class Proofs:
    """The proofs of a leaf partition, from its leaves and the nodes it fetched."""

    def __init__(self, leaves: dict[int, str], n: int, fetched: dict[tuple[int, int], str]):
        self.runs: list[dict[int, list[str]]] = []      # level -> run -> digests of its children
        self.above: list[dict[int, str]] = []           # level -> node -> siblings from there up, as text
        known, level = leaves, 0
        while n > 1:
            nodes = known | {p: d for (l, p), d in fetched.items() if l == level}
            runs = {r: [nodes[p] for p in range(r * ARITY, min((r + 1) * ARITY, n))] for r in {p // ARITY for p in known}}
            self.runs.append(runs)
            known = {r: h("".join(c)) for r, c in runs.items()}
            n, level = -(-n // ARITY), level + 1
        self.root = known[0]
        up = {0: ""}
        for runs in reversed(self.runs):
            up = {r * ARITY + i: "".join(c[:i] + c[i + 1:]) + up[r] for r, c in runs.items() for i in range(len(c))}
            self.above.append(up)
        self.above.reverse()

    def siblings(self, pos: int) -> str:
        """Digests of the proof of a leaf, level by level."""
        return self.above[0][pos] if self.above else ""

    def fold(self, pos: int, leaf: str) -> str:
        """The root that a leaf's digest and the proof's siblings give."""
        for runs in self.runs:
            c, i = runs[pos // ARITY], pos % ARITY
            leaf = h("".join((*c[:i], leaf, *c[i + 1:])))
            pos //= ARITY
        return leaf


@dataclass
class Manifest:
    """The groups' trees, the tree over their subroots, and for each group its place
    there: groups (tree, subroot, place, groups, root)."""
    lower: Tree
    upper: Tree
    groups: DataFrame


def manifest(leaves: DataFrame) -> Manifest:
    """Manifest of ``leaves`` (grp string, id long, leaf string, ...)."""
    key = F.coalesce(F.concat(F.lit("="), "grp"), F.lit(""))
    leaves = leaves.select(key.alias("tree"), "id", "leaf", *[c for c in leaves.columns if c not in ("grp", "id", "leaf")])
    # Stored: range partitioning reads its input twice, and hashing the texts is the dear part.
    lower = grow(materialise(leaves, "merkle-leaves"), ["id", "leaf"])
    tops = lower.roots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("grp_key"), F.col("root").alias("leaf"))
    upper = grow(tops, ["grp_key"])
    place = upper.blocks.select("tree", F.col("n").alias("groups"), F.explode("rows").alias("r"))
    groups = place.join(upper.roots, "tree").select(F.col("r.grp_key").alias("tree"), F.col("r.leaf").alias("subroot"),
                                                    F.col("r.pos").alias("place"), "groups", "root")
    return Manifest(lower, upper, materialise(groups, "merkle-groups"))


def requests(blocks: DataFrame) -> DataFrame:
    """(tree, block, of, level, pos): the nodes that each leaf partition fetches, of its
    own tree and (``of`` = the top tree) of the tree over the subroots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, block, n, positions, place, groups in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(tree, block, tree, l, p) for l, p in octopus(np.array(positions), n)]
                out += [(tree, block, _TOP, l, p) for l, p in octopus(np.array([place]), groups)]
            yield pa.RecordBatch.from_pylist([dict(zip(("tree", "block", "of", "level", "pos"), r)) for r in out], schema=schema)

    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("of", pa.string()), ("level", pa.int32()), ("pos", pa.int64())])
    ask = blocks.select("tree", "block", "n", F.col("rows.pos"), "place", "groups")
    return ask.mapInArrow(run, "tree string, block long, of string, level int, pos long")


def prove(m: Manifest, claimed: str | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root and verified of every leaf.
    ``claimed`` names a column of the leaves with a digest to be held against the
    manifest in place of the leaf's own (where it is null: the leaf's own)."""
    blocks = m.lower.blocks.join(m.groups, "tree")
    ask = materialise(requests(blocks), "merkle-requests")
    levels = [r.level for r in ask.select("level").distinct().collect()]  # at most 21
    nodes = m.lower.nodes.unionByName(m.upper.nodes).filter(F.col("level").isin(levels))
    nodes = nodes.select(F.col("tree").alias("of"), "level", "pos", "digest")
    got = ask.join(nodes, ["of", "level", "pos"]).groupBy("tree", "block").agg(
        F.collect_list(F.struct((F.col("of") == _TOP).alias("top"), "level", "pos", "digest")).alias("fetched"))
    rows = F.transform("rows", lambda r: F.struct(r["pos"].alias("pos"), r["id"].alias("id"), r["leaf"].alias("leaf"),
                                                  (F.coalesce(r[claimed], r["leaf"]) if claimed else r["leaf"]).alias("claimed")))
    work = blocks.join(got, ["tree", "block"], "left").select("n", "place", "groups", "subroot", "root", "fetched", rows.alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n, place, groups, subroot, root, fetched, leaves = (c[k].as_py() for c in batch.columns)
                parts: list[dict] = [{}, {}]
                for f in fetched or []:
                    parts[f["top"]][f["level"], f["pos"]] = f["digest"]
                own = Proofs({r["pos"]: r["leaf"] for r in leaves}, n, parts[0])
                top = Proofs({place: subroot}, groups, parts[1])
                rest = top.siblings(place)
                folded = [top.fold(place, own.fold(r["pos"], r["claimed"])) for r in leaves]
                size = len(leaves)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["id"] for r in leaves], pa.int64()), pa.array([r["leaf"] for r in leaves]), pa.array([subroot] * size),
                    pa.array([root] * size), pa.array([h(own.siblings(r["pos"]) + rest) for r in leaves]), pa.array(folded),
                    pa.array([f == root for f in folded])], names=names)

    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return work.mapInArrow(run, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(grp, id, leaf, claimed) of documents; where ``tampered`` holds, ``claimed`` is the
    digest with the text's A-Z lower-cased, else null."""
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.when(F.coalesce(tampered, F.lit(False)), digest(*head, ascii_lower(F.col("text"))))
    return docs.select(F.col("lang").alias("grp"), F.col("doc_id").cast("long").alias("id"), digest(*head, F.col("text")).alias("leaf"),
                       changed.alias("claimed"))
