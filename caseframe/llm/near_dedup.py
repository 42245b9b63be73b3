"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds its distinct shingles. One hash function orders all
shingles, and a sketch is the ``SKETCH`` smallest hashes of a set.

* Documents with equal sets form a class; one of them, the smallest id, goes on.
* Inverted lists: every retained value counts the classes that hold it. Two sets
  as similar as asked share at least ``needed`` retained values, so they share
  one among the rarest ``kept - needed + 1`` of either sketch. A class whose
  sketch is mostly values of its own therefore leaves here, and very common
  values come last, where they are seldom reached.
* The lists are never expanded into pairs. Each list ties its classes to its
  smallest member, and classes tied together form a work group.
* A work group is cut into tiles of about ``TILE`` classes. A pair of tiles is
  one piece of work for one task: overlaps of sketches (a matrix product), the
  union sketch's estimate, then exact Jaccard on the full sets. A piece returns
  links that span what it connected, so its rows grow with its classes and not
  with their pairs.
* Links are joined to components.

For sets no larger than the sketch ``needed`` is exact. For larger ones it is
set so that a pair as similar as asked misses it with a probability below
``MISS`` (Chernoff's bound); there is no cap on lists, partners or candidates.

Nulls and empty texts have an empty set and are linked with nothing. A null id
never names a component: such rows have the component of the other rows with
their set, null if there is none. Rows that repeat an id count as one document
when their sets are equal, and each stands for itself otherwise. Extra columns
are ignored; an empty table gives an empty result.
"""

import functools
import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.words import chunks, shingle_sets, words
from caseframe.llm.work import components, free_names, groups, small_batches, texts, written

SKETCH = 64
TILE = 256
MISS = 1e-9
#: Pairs estimated at once, and cells of a matrix of full sets in one task.
_PAIRS = 4096
_CELLS = 1 << 24

_SKETCHES = "doc_id long, n_shingles long, set_key binary, sketch array<long>"
_WORK = "work_group long, low int, high int, tile int, node long, shingles binary"


@functools.cache
def needed(size: int, percent: int, sketch: int = SKETCH) -> int:
    """Retained values that a set of ``size`` shares with any set as similar as asked."""
    if size <= sketch:
        beyond = max(0, size * 100 // percent - sketch)
        return max(1, -(-percent * size // 100) - beyond)
    share = percent / 100
    for least in range(math.floor(share * sketch), 0, -1):
        part = least / sketch
        if part >= share:
            continue
        gap = part * math.log(part / share) + (1 - part) * math.log((1 - part) / (1 - share))
        if sketch * gap >= -math.log(MISS):
            return least
    return 1


def _sketches(shingle: int):
    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                sets = shingle_sets(words(data, offsets), shingle)
                small = [values[:SKETCH] for values in sets]
                ends = np.cumsum([0, *map(len, small)], dtype=np.int32)
                flat = np.concatenate([*small, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(values) for values in sets], pa.int64()),
                        pa.array([_set_key(values) for values in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["doc_id", "n_shingles", "set_key", "sketch"],
                )

    return run


def _set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _work(shingle: int):
    """A row for each pair of tiles that a class belongs to, with its full set."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch):
                sets = shingle_sets(words(data, offsets), shingle)
                plain = part.select(["doc_id", "set_key", "work_group", "tile", "tiles"]).to_pylist()
                rows = []
                for row, values in zip(plain, sets, strict=True):
                    if _set_key(values) != row["set_key"]:  # another text under the same id
                        continue
                    for other in range(row["tiles"]):
                        low, high = sorted((row["tile"], other))
                        rows.append(
                            (row["work_group"], low, high, row["tile"], row["doc_id"], values.tobytes())
                        )
                        if len(rows) >= 2000:
                            yield _work_rows(rows)
                            rows = []
                if rows:
                    yield _work_rows(rows)

    return run


def _work_rows(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    names = ["work_group", "low", "high", "tile", "node", "shingles"]
    columns = zip(*rows, strict=True)
    arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _incidence(values: list[np.ndarray], most: int | None = None) -> np.ndarray | None:
    """Which of the values that occur more than once each set holds; None beyond ``most`` cells."""
    owner = np.repeat(np.arange(len(values)), [len(own) for own in values])
    _, place, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    width = int((count > 1).sum())
    if most is not None and len(values) * width > most:
        return None
    shared = count[place] > 1
    holds = np.zeros((len(values), width), np.float32)
    holds[owner[shared], column[place[shared]]] = 1
    return holds


def sketch_overlaps(sketches: list[np.ndarray]) -> np.ndarray:
    """Number of retained values that each two sketches share."""
    holds = _incidence(sketches)
    return (holds @ holds.T).astype(np.int64)


def estimates(sketches: list[np.ndarray], pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair, how many values of the union's sketch both sets hold, and its size."""
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    table = np.full((len(sketches), SKETCH), last)
    for at, sketch in enumerate(sketches):
        table[at, : len(sketch)] = sketch
    both, seen = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    for at in range(0, len(pairs), _PAIRS):
        some = pairs[at : at + _PAIRS]
        values = np.sort(np.concatenate([table[some[:, 0]], table[some[:, 1]]], axis=1), axis=1)
        new = np.ones(values.shape, bool)
        new[:, 1:] = values[:, 1:] != values[:, :-1]
        rank = np.cumsum(new, axis=1)
        real = (values != last) & (rank <= SKETCH)
        both[at : at + _PAIRS] = (real & ~new).sum(axis=1)
        seen[at : at + _PAIRS] = (real & new).sum(axis=1)
    return both, seen


def piece_links(
    sets: list[np.ndarray], sides: list[int], percent: int
) -> list[tuple[int, int]]:
    """Pairs of places that connect what the exact similarity connects.

    With two sides only pairs across them are looked at. Pairs that links found
    before already connect are passed over.
    """
    sketches = [values[:SKETCH] for values in sets]
    sizes = [len(values) for values in sets]
    least = np.array([needed(size, percent) for size in sizes])
    enough = sketch_overlaps(sketches) >= np.maximum(least[:, None], least[None, :])
    if len(set(sides)) > 1:
        side = np.array(sides)
        enough &= side[:, None] != side[None, :]
    pairs = np.argwhere(np.triu(enough, 1))
    both, seen = estimates(sketches, pairs)
    pairs = pairs[both >= np.where(seen == SKETCH, needed(SKETCH + 1, percent), 1)]
    holds = _incidence(sets, _CELLS) if len(pairs) > len(sets) else None
    common = None if holds is None else (holds @ holds.T).astype(np.int64)
    parent = list(range(len(sets)))

    def root(place):
        while parent[place] != place:
            parent[place] = parent[parent[place]]
            place = parent[place]
        return place

    if common is not None:
        total = np.array(sizes)
        union = total[pairs[:, 0]] + total[pairs[:, 1]] - common[pairs[:, 0], pairs[:, 1]]
        pairs = pairs[100 * common[pairs[:, 0], pairs[:, 1]] >= percent * union]
    found = []
    for a, b in pairs.tolist():
        if root(a) == root(b):
            continue
        if common is None:
            inter = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * inter < percent * (sizes[a] + sizes[b] - inter):
                continue
        parent[root(a)] = root(b)
        found.append((a, b))
    return found


def _to_smallest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The smallest node that the pairs connect a node with, and the node, for all others."""
    parent: dict[int, int] = {}

    def root(node):
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return [(root(node), node) for node in parent if root(node) != node]


def _links(percent: int):
    def run(frames):
        for piece in groups(frames, ["work_group", "low", "high"]):
            sides = piece["tile"].tolist()
            low, high = int(piece["low"].iat[0]), int(piece["high"].iat[0])
            if len(piece) < 2 or (low != high and len(set(sides)) < 2):
                continue
            sets = [np.frombuffer(value, np.uint64) for value in piece["shingles"]]
            nodes = piece["node"].tolist()
            pairs = _to_smallest(
                [(nodes[a], nodes[b]) for a, b in piece_links(sets, sides, percent)]
            )
            if pairs:
                yield pd.DataFrame(pairs, columns=["a", "b"])

    return run


def stars(rows: DataFrame, others: str) -> DataFrame:
    """Edges ``a``, ``b`` that connect what each ``node`` tied to all of its ``others`` does.

    A node goes to the smallest of them, and that one to the others. Nodes that share
    many of the others give these ties once for all, so the rows grow with the nodes
    and with the distinct pairs of hubs, and not with the ties.
    """
    least = F.array_min(F.array_append(others, F.col("node")))
    ends = F.array_distinct(F.array_append(others, F.col("node")))
    edges = rows.select(least.alias("a"), F.explode(ends).alias("b"))
    return edges.filter("a <> b").distinct()


def fewer_links(links: DataFrame) -> DataFrame:
    """Edges that connect what the links do, which pieces of one group find many times over.

    A class has a link from each piece that it is in, to the smallest that it reached
    there, so the number of its links is that of its group's tiles.
    """
    found = links.groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("smaller"))
    return stars(found, "smaller")


def near_duplicates(
    documents: DataFrame, percent: int = 80, shingle: int = 5, tile: int = TILE
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of each row.

    Documents are linked when 100 * intersection >= percent * union of their
    sets. A component has the smallest id that can be reached.
    """
    spark = documents.sparkSession
    rows = texts(documents)
    with small_batches(spark):
        sketches = written(rows.mapInArrow(_sketches(shingle), _SKETCHES))
    classes = written(
        sketches.filter("n_shingles > 0")
        .groupBy("set_key", "n_shingles")
        .agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"))
    )
    known = classes.filter("node is not null")

    # Inverted lists of the retained values.
    retained = known.select("node", F.explode("sketch").alias("value"))
    lists = written(
        retained.groupBy("value")
        .agg(F.count("*").alias("length"), F.min("node").alias("hub"))
        .filter("length > 1")
    )
    prefix = F.create_map(
        *[
            F.lit(value)
            for size in range(1, SKETCH + 1)
            for value in (size, size - needed(size, percent) + 1)
        ]
    )[F.least("n_shingles", F.lit(SKETCH)).cast("int")]
    prefix = F.when(F.col("n_shingles") <= SKETCH, prefix).otherwise(
        SKETCH - needed(SKETCH + 1, percent) + 1
    )
    own = F.least("n_shingles", F.lit(SKETCH)) - F.size("shared")
    rare = (
        retained.join(lists, "value")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("length", "value", "hub"))).alias("shared"))
        .join(known.select("node", "n_shingles", "set_key"), "node")
        .withColumn("take", (prefix - own).cast("int"))
        .filter("take > 0")
        .select(
            "node", "set_key", F.slice("shared", F.lit(1), F.col("take"))["hub"].alias("hubs")
        )
    )
    rare = written(rare)
    ties = written(stars(rare.select("node", "hubs"), "hubs"))
    tied = components(ties).withColumnRenamed("component", "work_group")
    members = written(rare.select("node", "set_key").join(tied, "node"))
    sizes = members.groupBy("work_group").agg(F.count("*").alias("size")).filter("size > 1")
    plan = members.join(sizes, "work_group").select(
        F.col("node").alias("doc_id"),
        "set_key",
        "work_group",
        F.ceil(F.col("size") / tile).cast("int").alias("tiles"),
    )
    plan = plan.withColumn("tile", F.expr("cast(pmod(xxhash64(doc_id), tiles) as int)"))

    # Tiles against tiles, on full sets.
    # Merged at any size, so that small tables move what large ones do.
    work = rows.join(plan.hint("merge"), "doc_id").mapInArrow(_work(shingle), _WORK)
    piece = ["work_group", "low", "high"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = (
        work.repartition(width, *piece)
        .sortWithinPartitions(*piece, "node")
        .mapInPandas(_links(percent), "a long, b long")
    )
    with small_batches(spark):
        edges = written(fewer_links(links))
    named = components(edges)
    reached = (
        known.select("set_key", "n_shingles", "node")
        .join(named, "node", "left")
        .select("set_key", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    )
    return (
        sketches.select("doc_id", "n_shingles", "set_key")
        .join(written(reached), ["set_key", "n_shingles"], "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") == 0, F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_of_each(documents: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The rows of ``documents`` whose id names their component, all columns as they were.

    Rows without an id stay: nothing can stand for them.
    """
    labels = near_duplicates(documents, percent, shingle)
    (name,) = free_names(documents, "gone")
    gone = labels.filter("doc_id is not null").filter("not kept").select(
        F.col("doc_id").alias(name)
    )
    same = F.col("doc_id").cast("long") == F.col(name)
    return documents.join(gone.distinct().hint("merge"), same, "left_anti")
