"""Merkle manifest of a table: a digest per row, tree and whole, and a proof per row.

Every source has a tree of its own over its rows in order of ``doc_id``; the
roots of the sources, in order of their names, are the leaves of one more tree,
whose root stands for the table. While a level has more than one node, each run
of 16 consecutive nodes (the last may be shorter) becomes the digest of its
members.

A tree is cut into aligned blocks of 4096 leaves, four levels of nodes with the
root. A block is one binary value of 32-byte digests in van Emde Boas order: the
levels are split at half height, the top half comes first and then each subtree
below it, every one laid out alike. So a run of 16 lies beside its parent.
``addresses`` tells places by arithmetic alone, for building a block and for
fetching siblings. The roots of the blocks are the leaves of the next tier of
blocks, up to a tier with one block.

A source may hold most rows: rows are numbered by range partitions and counts of
these, and a group is a block, 4096 rows at most. Blocks are written tables, so
a lost executor's blocks are built again from stored rows.

Null ids come first, rows with the same id are ordered by their digests, and
equal rows have leaves of their own. A null source is a source, before all
others; an empty one differs from it. A null doc_id, source, lang, n_chars or
text is hashed as ``-``. An empty table has no rows and no root. Further columns
of the table are not read.
"""

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseframe.llm.work import written

#: Nodes of a run; levels of edges in a block; leaves of a block.
FAN = 16
HEIGHT = 3
BLOCK = FAN**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<place:int,siblings:string>>"
_HEX = 64
#: Rows that go out together with their paths, some kilobytes each.
_SLICE = 256


def leaf_digest(**given: Column) -> Column:
    """Digest of a row of documents; ``given`` columns stand in for those of the row."""

    def field(col):
        value = col.cast("string")
        length = F.octet_length(value).cast("string")
        return F.coalesce(F.concat(length, F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*(field(given.get(name, F.col(name))) for name in FIELDS)), 256)


# Addresses


def _nodes(levels: int) -> int:
    return (FAN**levels - 1) // (FAN - 1)


def addresses(depth: int, places: np.ndarray, levels: int) -> np.ndarray:
    """Slots of the nodes ``places`` at ``depth`` below the root of a tree of ``levels``.

    The top half of the levels comes first, then the subtrees under it from left
    to right, each laid out in the same way.
    """
    if levels == 1:
        return np.zeros_like(places)
    top = levels // 2
    if depth < top:
        return addresses(depth, places, top)
    width = FAN ** (depth - top)
    below = levels - top
    return (
        _nodes(top) + places // width * _nodes(below) + addresses(depth - top, places % width, below)
    )


def _height(size: int) -> int:
    """Levels of edges of a tree over ``size`` leaves, a block's at most."""
    height = 0
    while size > FAN**height and height < HEIGHT:
        height += 1
    return height


def _store(digests: list[bytes], size: int) -> np.ndarray:
    """A block in its layout, from the digests of its leaves; ``size`` is the tree's."""
    height = _height(size)
    slots = np.zeros((_nodes(height + 1), 32), np.uint8)
    level = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
    for depth in range(height, -1, -1):
        slots[addresses(depth, np.arange(len(level)), height + 1)] = level
        if depth:
            text = level.tobytes().hex().encode()
            runs = range(0, len(text), FAN * _HEX)
            above = b"".join(sha256(text[at : at + FAN * _HEX]).digest() for at in runs)
            level = np.frombuffer(above, np.uint8).reshape(-1, 32)
    return slots


def _siblings(slots: np.ndarray, n_leaves: int, size: int) -> list[tuple[np.ndarray, list[str]]]:
    """From the leaves up: the place in its run and the other members' digests, of each node."""
    height = _height(size)
    found, count = [], n_leaves
    for depth in range(height, 0, -1):
        text = slots[addresses(depth, np.arange(count), height + 1)].tobytes().hex()
        others = []
        for at in range(count):
            start = at // FAN * FAN * _HEX
            own = at * _HEX
            others.append(text[start:own] + text[own + _HEX : start + FAN * _HEX])
        found.append((np.arange(count, dtype=np.int32) % FAN, others))
        count = -(-count // FAN)
    return found


# Numbering and building


def _in_tree(leaves: DataFrame, *order: str) -> DataFrame:
    """Adds ``place`` (from 0) in the ``tree`` by ``order``, and the tree's ``size``.

    Rows are dealt by ranges of the order, so a tree may span partitions; a row's
    place is its place among those of its tree in its partition, after those of
    the partitions before. ``arrival`` tells rows apart that are equal in all else.
    """
    keys = [F.col(name).asc_nulls_first() for name in (*order, "arrival")]
    dealt = written(
        leaves.withColumn("arrival", F.monotonically_increasing_id())
        .repartitionByRange("tree", *keys)
        .withColumn("part", F.spark_partition_id())
    )
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        dealt.groupBy("tree", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "tree",
            "part",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
            F.sum("n").over(whole).alias("size"),
        )
    )
    number = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*keys))
    return written(
        dealt.join(counts, ["tree", "part"])
        .withColumn("place", F.col("first") + number - 1)
        .withColumn("block", F.floor(F.col("place") / BLOCK))
        .drop("part", "arrival", "first")
    )


def _built(rows: DataFrame) -> DataFrame:
    """One row per block: its nodes in their layout and its root."""

    def build(key, table):
        table = table.sort_by("place")
        size = table.column("size")[0].as_py()
        digests = [bytes.fromhex(digest) for digest in table.column("digest").to_pylist()]
        slots = _store(digests, size)
        return pa.table(
            {
                "tree": [key[0].as_py()],
                "block": [key[1].as_py()],
                "size": [size],
                "n_leaves": [len(digests)],
                "nodes": [slots.tobytes()],
                "root": [slots[0].tobytes().hex()],
            }
        )

    return written(
        rows.select("tree", "block", "size", "place", "digest")
        .groupBy("tree", "block")
        .applyInArrow(
            build, "tree string, block long, size long, n_leaves long, nodes binary, root string"
        )
    )


def _tiers(rows: DataFrame) -> list[DataFrame]:
    """Blocks over the rows, blocks over their roots, and so on; a tier is a written table."""
    tiers = [_built(rows)]
    while True:
        wide = tiers[-1].filter(F.col("size") > BLOCK)
        if wide.isEmpty():
            return tiers
        upper = wide.select(
            "tree",
            F.floor(F.col("block") / BLOCK).alias("block"),
            F.ceil(F.col("size") / BLOCK).alias("size"),
            F.col("block").alias("place"),
            F.col("root").alias("digest"),
        )
        tiers.append(_built(upper))


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """``tree`` and ``root`` of the trees that end in each tier."""
    ends = [tier.filter(F.col("size") <= BLOCK).select("tree", "root") for tier in tiers]
    roots = ends[0]
    for more in ends[1:]:
        roots = roots.unionByName(more)
    return roots


# Paths


class _Block:
    """A stored block with the path of its root; gives the paths of its leaves."""

    def __init__(self, n_leaves: int, size: int, nodes: bytes, path: list[dict]):
        slots = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
        self.n_leaves = n_leaves
        self.levels = _siblings(slots, n_leaves, size)
        self.path = path

    def paths(self, wanted: np.ndarray) -> pa.ListArray:
        """Of each leaf its siblings in the block, then those of the block's root."""
        steps = len(self.levels) + len(self.path)
        places = np.empty((len(wanted), steps), np.int32)
        siblings: list[str] = [""] * (len(wanted) * steps)
        for step, (own, others) in enumerate(self.levels):
            at = wanted // FAN**step
            places[:, step] = own[at]
            siblings[step::steps] = [others[place] for place in at.tolist()]
        for step, above in enumerate(self.path, len(self.levels)):
            places[:, step] = above["place"]
            siblings[step::steps] = [above["siblings"]] * len(wanted)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(wanted) + 1, dtype=np.int32) * steps),
            pa.StructArray.from_arrays(
                [pa.array(places.ravel()), pa.array(siblings, pa.string())], ["place", "siblings"]
            ),
        )


def _below(blocks: DataFrame) -> DataFrame:
    """``tree``, ``block``, ``path`` of the blocks under those given, and what these carry."""
    names = ["tree", "block", "path", "subroot", "root"]

    def children(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row["n_leaves"], row["size"], row["nodes"], row["path"])
                for start in range(0, block.n_leaves, _SLICE):
                    wanted = np.arange(start, min(start + _SLICE, block.n_leaves))
                    tree, subroot, root = (
                        pa.repeat(pa.scalar(row[name], pa.string()), len(wanted))
                        for name in ("tree", "subroot", "root")
                    )
                    under = pa.array(wanted + row["block"] * BLOCK)
                    yield pa.RecordBatch.from_arrays(
                        [tree, under, block.paths(wanted), subroot, root], names
                    )

    return blocks.mapInArrow(
        children, f"tree string, block long, path {PATH}, subroot string, root string"
    )


def _block_paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first tier with the path of every block's root to the root of all.

    ``above`` has ``tree``, ``path``, ``subroot`` and ``root`` of every tree.
    """
    under = None
    for tier in reversed(tiers):
        stored = tier.select("tree", "block", "size", "n_leaves", "nodes")
        here = stored.filter(F.col("size") <= BLOCK).join(above, "tree")
        if under is not None:
            inner = stored.filter(F.col("size") > BLOCK).join(under, ["tree", "block"])
            here = here.unionByName(inner)
        under = _below(here)
    return here


def _row_paths(rows: DataFrame, blocks: DataFrame, carried: dict[str, str]) -> DataFrame:
    """``carried`` columns of the rows, with ``path``, ``subroot`` and ``root``.

    A block and its rows meet in one partition, the block first; the rows follow
    in pieces, so a task holds one block and one piece of its rows.
    """
    stored = ("n_leaves", "size", "nodes", "path", "subroot", "root")
    kinds = dict(blocks.dtypes)
    ends = rows.select(
        "tree", "block", "place", *carried, *(F.lit(None).cast(kinds[name]).alias(name) for name in stored)
    )
    starts = blocks.select(
        "tree",
        "block",
        F.lit(-1).cast("long").alias("place"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in carried.items()),
        *stored,
    )
    met = (
        ends.unionByName(starts)
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "place")
    )

    def prove(batches):
        block, same = None, ()
        for batch in batches:
            place = batch.column("place").to_numpy()
            cuts = np.flatnonzero(place < 0).tolist()
            for start, end in zip([0, *cuts], [*cuts, len(place)], strict=True):
                if start < end and place[start] < 0:
                    row = batch.slice(start, 1).select(stored).to_pylist()[0]
                    block = _Block(row["n_leaves"], row["size"], row["nodes"], row["path"])
                    same = (row["subroot"], row["root"])
                    start += 1
                for at in range(start, end, _SLICE):
                    part = batch.slice(at, min(_SLICE, end - at))
                    paths = block.paths(place[at : at + part.num_rows] % BLOCK)
                    told = [pa.repeat(pa.scalar(value, pa.string()), part.num_rows) for value in same]
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(name) for name in carried), paths, *told],
                        [*carried, "path", "subroot", "root"],
                    )

    types = ", ".join(f"{name} {kind}" for name, kind in carried.items())
    return met.mapInArrow(prove, f"{types}, path {PATH}, subroot string, root string")


# The manifest


@dataclass
class Manifest:
    """Rows with their places, and the stored blocks of the sources and of their roots."""

    rows: DataFrame
    sources: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]

    def root(self) -> DataFrame:
        """One row with the root; none for an empty table."""
        return _roots(self.top).select("root")

    def source_roots(self) -> DataFrame:
        """``source`` and ``subroot`` of every source."""
        name = F.when(F.col("name") != "", F.substring("name", 2, 2**31 - 1))
        return self.subroots.select(name.alias("source"), F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """The rows with ``subroot``, ``root`` and ``path``, the siblings level by level.

        A step of a path is the digests of the run's other members as one text,
        and the place among them where the node's own digest belongs.
        """
        nothing = F.array().cast(PATH)
        whole = _roots(self.top).select(
            "tree", nothing.alias("path"), F.lit("").alias("subroot"), "root"
        )
        kept = {"name": "string", "digest": "string"}
        above = _row_paths(self.subroots, _block_paths(self.top, whole), kept).select(
            F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"
        )
        own = ("tree", "place", "size", "block")
        carried = {
            field.name: field.dataType.simpleString()
            for field in self.rows.schema
            if field.name not in own
        }
        blocks = _block_paths(self.sources, written(above))
        return _row_paths(self.rows, blocks, carried).withColumnRenamed("digest", "leaf")


def manifest(leaves: DataFrame) -> Manifest:
    """The manifest of rows with ``doc_id``, ``source`` and ``leaf``.

    Other columns are carried to the proofs; those must not be named tree, place,
    size, block, digest, part, arrival, first, path, subroot or root.
    """
    source = F.col("source").cast("string")
    # Null sorts first as the empty text, and all names stay in the order of their bytes.
    named = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    rows = _in_tree(
        written(named.drop("source").withColumnRenamed("leaf", "digest")), "doc_id", "digest"
    )
    sources = _tiers(rows)
    roots = _roots(sources).select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")
    )
    subroots = _in_tree(roots, "name")
    return Manifest(rows, sources, subroots, _tiers(subroots))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along the path of its proof."""

    def up(digest, step):
        own = step["place"] * _HEX
        rest = step["siblings"].substr(own + 1, F.lit(2**31 - 1))
        return F.sha2(F.concat(step["siblings"].substr(F.lit(1), own), digest, rest), 256)

    return F.aggregate(path, leaf, up)


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up and from left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: step["siblings"])), 256)


def leaves_of(documents: DataFrame, **more: Column) -> DataFrame:
    """``doc_id``, ``source`` and ``leaf`` of documents, and ``more`` columns."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_digest().alias("leaf"),
        *(col.alias(name) for name, col in more.items()),
    )


def verify(proofs: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Proofs with ``proof_sha256``, ``folded_root`` from the column ``leaf``, and ``verified``."""
    return (
        proofs.withColumn("proof_sha256", path_digest(F.col("path")))
        .withColumn("folded_root", folded(F.col(leaf), F.col("path")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
