"""Spelling variants: words one edit apart, grouped under the form that is used most.

Words are counted over all texts and cut into blocks by how many letters they
have of each of four classes (by code point modulo 4), which also fixes their
length. One edit moves a word at most to a block beside its own: another letter
of the same length, or a letter more. Blocks are cut into tiles of at most about
1024 words, and a task multiplies the letter counts of two tiles: the product
(a block of the Gram matrix) gives squared distances of the counts. A replaced
letter makes 2, an inserted one 1; pairs at these distances are compared letter
by letter. A pair never becomes a row: a task returns, for each word that it
found a neighbour of, how many and the one used most.

No block or word is left out, whatever its size: a block with many words is
dealt over tiles by hash, and its pairs of tiles over tasks.

A null text has no words; a null id is the empty text in the digest that picks
the runs to shorten. A word is used most with the largest count; ties go to the
smallest in code point order. Repeated rows count each time, an empty table
gives no rows, and further columns are not read.
"""

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caseframe.llm.work import written

#: Letters of a word, the divisor of the digests of runs that lose a letter,
#: the least length and count of a word, and how much more often a form is used.
LETTERS = "A-Za-zÀ-ÿ"
SHORTENED, SHORTEST, LEAST, DOMINANCE = 199, 6, 5, 5
CLASSES = 4
#: Words of a tile, fewer where they are long: 64 Ki letters at most, or one word.
_TILE, _TILE_LETTERS = 1024, 1 << 16
#: Counted words that a task holds before it passes them on.
_HELD = 100_000
_COMPARED = 1 << 14
_SALTS = 32
_LOWER, _HIGH = ord("a"), 0xC0
_COLUMNS = 26 + 64


# Counting


def _counted(doc_id, text: bytes, runs: re.Pattern, total: Counter) -> None:
    # bytes.lower changes A-Z only.
    found = Counter(runs.findall(text.lower().decode("utf-8", "replace")))
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in found.items():
        digest = crc32(run.encode(), start)
        if digest % SHORTENED == 0:
            place = digest % len(run)
            run = run[:place] + run[place + 1 :]
            if len(run) < SHORTEST:
                continue
        total[run] += n


def count_words(documents: DataFrame) -> DataFrame:
    """``word``, ``n`` of the lower-cased runs of letters of all texts.

    Words shorter than ``SHORTEST`` or with fewer than ``LEAST`` uses are left out.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    ).filter(F.col("text").isNotNull())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A maximal run that is too short cannot become long enough.
        runs = re.compile(f"[{LETTERS}]{{{SHORTEST},}}")
        total: Counter = Counter()

        def batch():
            return pa.RecordBatch.from_pydict({"word": list(total), "n": list(total.values())})

        for part in batches:
            for doc_id, text in zip(part.column("doc_id"), part.column("text"), strict=True):
                _counted(doc_id.as_py(), text.as_py(), runs, total)
                if len(total) >= _HELD:
                    yield batch()
                    total.clear()
        if total:
            yield batch()

    counted = rows.mapInArrow(partial, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


# Blocks and tiles


def _class_counts(word: Column) -> Column:
    """Letters of the word in each class."""
    letters = [*range(ord("A"), ord("Z") + 1), *range(_LOWER, _LOWER + 26), *range(_HIGH, 0x100)]
    others = ("".join(chr(c) for c in letters if c % CLASSES != k) for k in range(CLASSES))
    return F.array(*(F.length(F.translate(word, other, "")) for other in others))


def _steps() -> list[list[int]]:
    """How class counts differ within a block and to the blocks beside it, each pair once."""
    unit = np.eye(CLASSES, dtype=int)
    moved = [unit[a] - unit[b] for a in range(CLASSES) for b in range(a + 1, CLASSES)]
    return [step.tolist() for step in (0 * unit[0], *moved, *unit)]


def _beside(block: Column) -> Column:
    steps = (F.array(*(block[k] + step[k] for k in range(CLASSES))) for step in _steps())
    return F.array(*steps)


def _tiles(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks with their number of tiles; tiles with their sorted words."""
    placed = words.withColumn("block", _class_counts(F.col("word")))
    capacity = F.greatest(F.lit(1), F.least(F.lit(_TILE), F.lit(_TILE_LETTERS) / F.max(F.length("word"))))
    blocks = placed.groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / F.floor(capacity)).cast("int").alias("n_tiles")
    )
    tile = F.pmod(F.xxhash64("word"), F.col("n_tiles")).cast("int")
    # A block may hold most words; salted, its words learn the number of tiles in many tasks.
    salted = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    tiles = (
        placed.withColumn("salt", F.pmod(F.hash("word"), F.lit(_SALTS)))
        .join(salted, ["block", "salt"])
        .groupBy("block", tile.alias("tile"))
        .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("members"))
    )
    return blocks, written(tiles)


def _pairs(blocks: DataFrame, tiles: DataFrame) -> DataFrame:
    """Members of every two tiles of a block or of blocks beside each other."""
    beside = blocks.select("block", "n_tiles", F.explode(_beside(F.col("block"))).alias("other"))
    found = beside.join(
        blocks.select(F.col("block").alias("other"), F.col("n_tiles").alias("other_tiles")), "other"
    )
    same = F.col("block") == F.col("other")
    # A block with very many tiles has their square in pairs: dealt out before the second explode.
    left = found.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
    first = F.when(same, F.col("tile")).otherwise(0)
    pairs = left.repartition("block", "other", "tile").withColumn(
        "other_tile", F.explode(F.sequence(first, F.col("other_tiles") - 1))
    )
    names = ("block", "other", "tile", "other_tile")
    others = tiles.select(
        F.col("block").alias("other"),
        F.col("tile").alias("other_tile"),
        F.col("members").alias("other_members"),
    )
    return pairs.select(*names).join(tiles, ["block", "tile"]).join(others, ["other", "other_tile"])


# Products


def _letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    """Letters of each kind in each word; 24 bits hold the squares of short words exactly."""
    column = np.where(codes >= _HIGH, codes - _HIGH + 26, codes - _LOWER).astype(np.int64)
    row = np.arange(len(codes), dtype=np.int64)[:, None] * _COLUMNS
    counts = np.bincount((row + column).ravel(), minlength=len(codes) * _COLUMNS)
    kind = np.float32 if codes.shape[1] < 2048 else np.float64
    return counts.reshape(len(codes), _COLUMNS).astype(kind)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replaced letter, or ``b`` by one inserted."""
    length = a.shape[1]
    if b.shape[1] == length:
        return (a != b).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= length


def near_pairs(a: list[str], b: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of ``a`` and ``b`` that are one edit apart.

    All words of ``a`` have one length, those of ``b`` the same or one letter more.
    With ``same``, ``b`` is ``a`` and each pair comes once.
    """
    codes, others = _letters(a), _letters(b)
    counts, other_counts = _letter_counts(codes), _letter_counts(others)
    distances = (
        (counts**2).sum(axis=1)[:, None]
        + (other_counts**2).sum(axis=1)[None, :]
        - 2 * (counts @ other_counts.T)
    )
    wanted = 2 if codes.shape[1] == others.shape[1] else 1
    left, right = np.nonzero(np.triu(distances == wanted, 1) if same else distances == wanted)
    step = max(1, _COMPARED * 16 // max(codes.shape[1], 16))
    kept = [
        _one_edit(codes[left[at : at + step]], others[right[at : at + step]])
        for at in range(0, len(left), step)
    ]
    near = np.concatenate(kept) if kept else np.zeros(0, bool)
    return left[near], right[near]


def _best(own: np.ndarray, other: np.ndarray, words: list[str], n: np.ndarray) -> Iterator[tuple]:
    """Place of a word, how many neighbours, and the count and place of the best one."""
    if not len(own):
        return
    order = np.lexsort((other, -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    sizes = np.diff(np.append(first, len(own)))
    for at, size in zip(first.tolist(), sizes.tolist(), strict=True):
        best = int(other[at])
        yield int(own[at]), size, int(n[best]), words[best]


def _neighbours(pairs: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best`` of the words with neighbours in a pair of tiles."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                sides = [row.column(name)[0].values for name in ("members", "other_members")]
                (a, n), (b, m) = (
                    (side.field("word").to_pylist(), side.field("n").to_numpy()) for side in sides
                )
                same = row.column("same")[0].as_py()
                left, right = near_pairs(a, b, same)
                rows = [(a[own], *rest) for own, *rest in _best(left, right, b, m)]
                rows += [(b[own], *rest) for own, *rest in _best(right, left, a, n)]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column) for column in columns], ["word", "n_near", "best_n", "best"]
                    )

    same = (F.col("block") == F.col("other")) & (F.col("tile") == F.col("other_tile"))
    return pairs.select("members", "other_members", same.alias("same")).mapInArrow(
        found, "word string, n_near long, best_n long, best string"
    )


# Forms


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of forms, which double in each round.

    A form is used more often than its word, so there are no circles, and chains
    are as long as the logarithm of the counts.
    """
    names = written(forms.select("word", F.col("form").alias("root")))
    while True:
        further = names.select(F.col("word").alias("root"), F.col("root").alias("next"))
        changes = Observation()
        names = written(
            names.join(further, "root", "left")
            .observe(changes, F.count("next").alias("n"))
            .select("word", F.coalesce("next", "root").alias("root"))
        )
        if not changes.get["n"]:
            return names


def group_words(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of words with counts ``n``.

    The form of a word is its most used neighbour, if that is used at least
    ``dominance`` (2 or more) times as often; the root is the end of the chain of forms.
    """
    if dominance < 2:
        raise ValueError("a form must be used more often than its word")
    words = written(words.select("word", "n"))
    blocks, tiles = _tiles(words)
    near = (
        _neighbours(_pairs(blocks, tiles))
        .groupBy("word")
        .agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first"),
        )
    )
    most = -F.col("first.less")
    leads = most >= F.col("n") * dominance
    formed = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(leads, F.col("first.best")).alias("form"),
            F.when(leads, most).alias("form_n"),
        )
    )
    roots = _roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(documents: DataFrame) -> DataFrame:
    """The words of all documents with their forms and roots."""
    return group_words(count_words(documents))
