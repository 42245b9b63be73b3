"""Benchmark passages in documents, by latent semantic retrieval.

* Passages are windows of 16, 24, 32, 48 or 64 words, every eight words. Words are runs
  of letters and digits, hashed to ``FEATURES`` columns, and weighted by their inverse
  document frequency over all documents.
* The latent space comes from a randomised singular value decomposition of the
  passages' TF-IDF matrix: random projections, summed over the tasks, with one
  power iteration. It is fitted on all documents and the benchmark.
* Search: longer items are cut into equal parts of 64 words at most, of which one
  at least holds the asked share of its words if the whole item does. Every
  passage of every document is projected and compared with the parts of its
  length. Coordinates are divided by their singular values, so that unrelated
  passages are close to perpendicular.
* Candidates of at least ``COSINE``, for parts shorter than the shortest window
  less by the root of their share of it, are checked: the longest common subsequence
  of the item's words and the passage with its surroundings, where enough of the
  item's rarest words occur for it to be as long as asked. A document is
  contaminated if it has ``LCS`` of the item's words in order, or ``WEAK`` of
  them and the item's answer, its last sentence, word for word.

The benchmark is searched in blocks of ``ITEMS`` items, of which one is held at
a time, so its size is not bounded by memory. All passages are searched; there
is no cap on candidates.

Null and empty texts and texts without letters or digits have no passages. Items without
words match nothing. Rows that repeat an id are searched each, and give a row
per item with the larger ratio. Null ids, also of items, are searched and
reported as null.
Extra columns are ignored; empty tables give an empty result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.words import NO_LETTER_OR_DIGIT, chunks, words
from caseframe.llm.work import array_sum, free_names, texts, written

FEATURES = 1 << 14
RANK = 64
ITEMS = 4096
STRIDE = 8
WINDOWS = (16, 24, 32, 48, 64)
COSINE = 0.35
LCS = 0.8
WEAK = 0.6
LEAST_ANSWER = 3
_FIT_PASSAGE = 32
_ROWS = 1 << 15
#: Places that a sum takes one by one, and sums made side by side.
_PIECE = 32
_PIECES = 1024
_SPLIT_BYTES = 1 << 18

_SPLIT = "features binary"
_MATCH = "doc_id long, item_id long, cosine double, lcs_ratio double, answer_found boolean, at_word long"


def _features(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % FEATURES


def _letter_words(batch):
    for part, data, offsets in chunks(batch):
        found = words(data, offsets, NO_LETTER_OR_DIGIT)
        yield part, found, _features(found.hashes)


def _split(batches):
    """The columns of each text's words, two bytes a word."""
    for batch in batches:
        for _, found, features in _letter_words(batch):
            bounds = pa.py_buffer((2 * found.first).astype(np.int64))
            data = pa.py_buffer(features.astype(np.uint16))
            column = pa.Array.from_buffers(
                pa.large_binary(), len(found.first) - 1, [None, bounds, data]
            )
            yield pa.RecordBatch.from_arrays([column.cast(pa.binary())], ["features"])


def _split_texts(batches):
    """Where the texts that ``_split`` made begin, and their words' columns, some texts at a time."""
    for batch in batches:
        for _, data, offsets in chunks(batch, "features", _SPLIT_BYTES):
            yield offsets // 2, data.view(np.uint16)


def _document_counts(batches):
    counts, n = np.zeros(FEATURES + 1, np.int64), 0
    for first, features in _split_texts(batches):
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        # Sorted here, because numpy finds distinct integers by hashing, which takes longer.
        kind = np.uint32 if len(first) * FEATURES < 1 << 32 else np.uint64
        pairs = np.sort((owner * FEATURES + features).astype(kind))
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[1:] != pairs[:-1]
        counts[:FEATURES] += np.bincount(pairs[new] % FEATURES, minlength=FEATURES)
        n += len(first) - 1
    counts[FEATURES] = n
    yield pd.DataFrame({"total": [counts.tobytes()]})


def _as_pandas(run):
    """Read Arrow batches, yield pandas frames, as mapInArrow wants batches out."""
    def both(batches):
        for frame in run(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    return both


def _sums(rows: np.ndarray, places: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``rows[places]`` over stretches that begin at ``first`` and are not empty.

    Stretches are cut into pieces of at most ``_PIECE`` places, of which all first
    rows are added up at once, then all second ones; then the pieces are.
    """
    ends = np.append(first[1:], len(places))
    counts = -(-(ends - first) // _PIECE)
    piece = np.cumsum(counts) - counts
    starts = np.repeat(first - piece * _PIECE, counts) + np.arange(counts.sum()) * _PIECE
    sizes = np.minimum(np.repeat(ends, counts) - starts, _PIECE)
    result = np.empty((len(starts), rows.shape[1]), rows.dtype)
    order = np.argsort((_PIECE - sizes).astype(np.uint8), kind="stable")
    taken = np.empty((min(_PIECES, len(order)), rows.shape[1]), rows.dtype)
    for low in range(0, len(order), _PIECES):
        some = order[low : low + _PIECES]
        begin, size = starts[some], sizes[some]
        total = rows.take(places[begin], axis=0)
        for at in range(1, size[0]):
            n = len(size) - int(np.searchsorted(size[::-1], at, side="right"))
            total[:n] += rows.take(places[begin[:n] + at], axis=0, out=taken[:n], mode="clip")
        result[some] = total
    if len(result) > len(first):
        return _sums(result, np.arange(len(result)), piece)
    return result


def _stretches(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of stretches of ``size`` words that do not cross texts, and their texts."""
    lengths = np.diff(first)
    counts = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][owner] + place * size, owner


def _gram(idf: np.ndarray, space: np.ndarray):
    """This task's part of A' A space, with a row of A for each passage."""
    weights = (idf[:, None] * space).astype(np.float32)

    def run(batches):
        total = np.zeros(space.shape)
        for bounds, features in _split_texts(batches):
            starts, _ = _stretches(bounds, _FIT_PASSAGE)
            if not len(starts):
                continue
            seen = _sums(weights, features, starts)
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(features))))
            norms = np.sqrt(np.add.reduceat(idf[features] ** 2, starts)) + 1e-9
            seen /= norms[:, None] ** 2
            order = np.argsort(features, kind="stable")
            own = features[order]
            new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            total[own[new]] += _sums(seen, passage[order], new)
        total = (total * idf[:, None]).astype(np.float32)
        yield pd.DataFrame({"total": [total.tobytes()]})

    return run


def latent_space(rows: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Right singular vectors over singular values, times the words' weights.

    ``rows`` are what ``_split`` made of the texts.
    """

    def applied(space):
        partial = rows.mapInArrow(_as_pandas(_gram(idf, space)), "total binary")
        return array_sum(partial, "total", np.zeros(space.shape, np.float32)).astype(float)

    start = np.random.default_rng(0).normal(size=(FEATURES, RANK))
    basis, _ = np.linalg.qr(applied(start))
    again = applied(basis)
    values, turn = np.linalg.eigh(basis.T @ again)
    scale = np.sqrt(np.maximum(values, values.max() * 1e-6 + 1e-12))
    return (idf[:, None] * (basis @ turn / scale)).astype(np.float32)


class Items:
    """A block of benchmark items, by the window that suits their length."""

    def __init__(self, table: pd.DataFrame, space: np.ndarray, idf: np.ndarray):
        column = pa.array(table["text"].tolist(), pa.string())
        batch = pa.RecordBatch.from_arrays([column], ["text"])
        self.ids, self.words, self.answers, self.masks, features = [], [], [], [], []
        at = 0
        for part, data, offsets in chunks(batch):
            found = words(data, offsets, NO_LETTER_OR_DIGIT)
            for i in range(part.num_rows):
                own = found.hashes[found.first[i] : found.first[i + 1]]
                if len(own):
                    own_id = table["item_id"].iat[at + i]
                    self.ids.append(None if pd.isna(own_id) else int(own_id))
                    self.words.append(own)
                    self.answers.append(_answer(table["text"].iat[at + i]))
                    self.masks.append(_masks(own.tolist()))
                    features.append(_features(own))
            at += part.num_rows
        self._find_rarest(idf)
        parts = [
            (item, part)
            for item, own in enumerate(features)
            for part in np.array_split(own, -(-len(own) // WINDOWS[-1]))
        ]
        self.item_of = [item for item, _ in parts]
        lengths = np.array([len(part) for _, part in parts])
        edges = [(a * b) ** 0.5 for a, b in zip(WINDOWS, WINDOWS[1:], strict=False)]
        kind = np.searchsorted(edges, lengths)
        self.of_window = [np.flatnonzero(kind == i) for i in range(len(WINDOWS))]
        self.least = COSINE * np.sqrt(np.minimum(lengths / WINDOWS[0], 1))
        vectors = [space[part].sum(axis=0) for _, part in parts]
        self.vectors = _unit(np.array(vectors).reshape(-1, space.shape[1]))

    def _find_rarest(self, idf: np.ndarray) -> None:
        """The rarest words of each item, more than may be missing, and how many must be there."""
        rarest, self.must = [], []
        for own in self.words:
            missing = len(own) - int(np.ceil(WEAK * len(own) - 1e-9))
            some = np.argsort(-idf[_features(own)], kind="stable")[: missing + 3 + len(own) // 4]
            rarest.append(own[some])
            self.must.append(len(some) - missing)
        self.rare, place = np.unique(
            np.concatenate([*rarest, np.zeros(0, np.uint64)]), return_inverse=True
        )
        self.rare_features = np.zeros(FEATURES, bool)
        self.rare_features[_features(self.rare)] = True
        ends = np.cumsum([len(own) for own in rarest], dtype=int)
        parts = np.split(place, ends[:-1]) if rarest else []
        counted = [np.unique(part, return_counts=True) for part in parts]
        self.rare_of = [own for own, _ in counted]
        self.rare_times = [times for _, times in counted]

    def places(self, hashes: np.ndarray, features: np.ndarray):
        """A function that gives where an item's rarest words are, and which is there."""
        maybe = np.flatnonzero(self.rare_features[features])
        at = np.minimum(np.searchsorted(self.rare, hashes[maybe]), max(len(self.rare) - 1, 0))
        same = self.rare[at] == hashes[maybe]
        where, word = maybe[same], at[same]
        order = np.argsort(word, kind="stable")
        bounds = np.searchsorted(word[order], np.arange(len(self.rare) + 1))
        of_word = [where[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

        def of_item(item: int) -> tuple[np.ndarray, np.ndarray]:
            found = [of_word[w] for w in self.rare_of[item]]
            where = np.concatenate(found)
            which = np.repeat(np.arange(len(found)), [len(own) for own in found])
            order = np.argsort(where, kind="stable")
            return where[order], which[order]

        return of_item

    def enough(self, item: int, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which stretches of ``which`` hold different words of the item for as many as must be there."""
        sizes = high - low
        maybe = np.flatnonzero(sizes >= self.must[item])
        if not len(maybe):
            return maybe
        sizes = sizes[maybe]
        row = np.repeat(np.arange(len(maybe)), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes - low[maybe], sizes)
        there = np.zeros((len(maybe), len(self.rare_of[item])), bool)
        there[row, which[at]] = True
        return maybe[there @ self.rare_times[item] >= self.must[item]]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + 1e-9)


def _word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return words(data, np.array([0, len(data)]), NO_LETTER_OR_DIGIT).hashes


def _answer(text: str) -> list[int]:
    """Words of the last sentence, or none if it is too short to tell anything."""
    import re

    for sentence in reversed(re.split(r"[.?!\n]+", text)):
        found = _word_hashes(sentence).tolist()
        if found:
            return found if len(found) >= LEAST_ANSWER else []
    return []


def _masks(own: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for place, word in enumerate(own):
        masks[word] = masks.get(word, 0) | 1 << place
    return masks


def common_subsequence(masks: dict[int, int], length: int, other: list[int]) -> int:
    """Length of the longest common subsequence, with a bit for each word of the item."""
    full = (1 << length) - 1
    row = full
    for mask in filter(None, map(masks.get, other)):
        both = row & mask
        row = ((row + both) | (row - both)) & full
    return length - row.bit_count()


def most_in_common(masks: dict[int, int], length: int, other: list[int]) -> int:
    """No common subsequence is longer: each distinct word of the item that is not there is missing."""
    return length - len(masks) + len(masks.keys() & other)


def _contains(other: list[int], answer: list[int]) -> bool:
    n = len(answer)
    return any(
        other[at : at + n] == answer
        for at, word in enumerate(other[: len(other) - n + 1])
        if word == answer[0]
    )


def _matches(found, features, space: np.ndarray, items: Items):
    """(text, item, cosine, ratio, answer, word) of what passes the checks."""
    starts, owner = _stretches(found.first, STRIDE)
    if not len(starts):
        return
    pieces = np.zeros((len(starts) + 1, space.shape[1]))
    pieces[1:] = _sums(space, features, starts)
    np.cumsum(pieces, axis=0, out=pieces)
    last = np.cumsum(np.bincount(owner))[owner]
    rare = items.places(found.hashes, features)
    at = np.arange(len(starts))
    for window, some in zip(WINDOWS, items.of_window, strict=True):
        if not len(some):
            continue
        end = np.minimum(at + window // STRIDE, last)
        # The tail of a text is inside the last full window.
        use = np.flatnonzero((at + window // STRIDE <= last) | (np.diff(owner, prepend=-1) > 0))
        vectors = items.vectors[some].astype(np.float32)
        for low in range(0, len(use), _ROWS):
            rows = use[low : low + _ROWS]
            cosines = np.empty((len(some), len(rows)), np.float32)
            for part in range(0, len(rows), _PIECES):
                few = rows[part : part + _PIECES]
                passages = pieces.take(end[few], axis=0) - pieces.take(few, axis=0)
                cosines[:, part : part + _PIECES] = vectors @ _unit(passages.astype(np.float32)).T
            near = cosines >= items.least[some][:, None]
            checked: dict[tuple[int, int, int], tuple[float, bool]] = {}
            for column in np.flatnonzero(near.any(axis=1)).tolist():
                item = items.item_of[some[column]]
                close = np.flatnonzero(near[column])
                place = rows[close]
                text = owner[place]
                n = len(items.words[item])
                slack = max(n, STRIDE)
                begin = np.maximum(found.first[text], starts[place] - slack)
                stop = np.minimum(found.first[text + 1], starts[place] + window + slack)
                where, which = rare(item)
                low_at, high_at = np.searchsorted(where, begin), np.searchsorted(where, stop)
                for one in items.enough(item, which, low_at, high_at).tolist():
                    key = item, int(begin[one]), int(stop[one])
                    if key not in checked:
                        other = found.hashes[key[1] : key[2]].tolist()
                        ratio = most_in_common(items.masks[item], n, other) / n
                        if ratio >= WEAK:
                            ratio = common_subsequence(items.masks[item], n, other) / n
                        else:
                            ratio = 0.0
                        answer = ratio >= WEAK and bool(items.answers[item])
                        checked[key] = ratio, answer and _contains(other, items.answers[item])
                    ratio, answer = checked[key]
                    if ratio >= LCS or answer:
                        own = int(text[one])
                        at_word = int(starts[place[one]] - found.first[own])
                        yield own, item, float(cosines[column, close[one]]), ratio, answer, at_word


def _searched(space: np.ndarray, items: Items):
    def run(batches):
        for batch in batches:
            rows = []
            for part, found, features in _letter_words(batch):
                best: dict[tuple[int, int], tuple] = {}
                for text, item, *rest in _matches(found, features, space, items):
                    old = best.get((text, item))
                    if old is None or (rest[1], rest[0]) > (old[1], old[0]):
                        best[text, item] = tuple(rest)
                ids = part.column("doc_id").to_pylist()
                rows += [(ids[text], items.ids[item], *rest) for (text, item), rest in best.items()]
            frame = pd.DataFrame(rows, columns=[field.split()[0] for field in _MATCH.split(", ")])
            kinds = {"doc_id": "Int64", "item_id": "Int64", "answer_found": "bool", "at_word": "int64"}
            kinds |= {"cosine": "float64", "lcs_ratio": "float64"}
            yield frame.astype(kinds)

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document and benchmark item whose passage it holds."""
    spark = documents.sparkSession
    rows = texts(documents)
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).dropna(subset=["text"])
    split = written(rows.select("text").mapInArrow(_split, _SPLIT))
    counts = array_sum(
        split.mapInArrow(_as_pandas(_document_counts), "total binary"),
        "total",
        np.zeros(FEATURES + 1, np.int64),
    )
    idf = np.log((counts[FEATURES] + 1) / (counts[:FEATURES] + 1)) + 0.1
    of_items = items.select("text").mapInArrow(_split, _SPLIT)
    space = latent_space(split.unionByName(of_items), idf)
    blocks = -(-items.count() // ITEMS)
    found = spark.createDataFrame([], _MATCH)
    for block in range(blocks):
        part = items.filter(F.expr(f"pmod(xxhash64(item_id), {blocks}) = {block}"))
        # As strings, for pandas would make floats of ids beside a null.
        part = part.withColumn("item_id", F.col("item_id").cast("string")).toPandas()
        search = _as_pandas(_searched(space, Items(part, space, idf)))
        found = found.unionByName(rows.mapInArrow(search, _MATCH))
    order = F.struct("lcs_ratio", "cosine", F.col("at_word").alias("_at"))
    return (
        found.groupBy("doc_id", "item_id")
        .agg(
            F.max_by("cosine", order).alias("cosine"),
            F.max("lcs_ratio").alias("lcs_ratio"),
            F.max("answer_found").alias("answer_found"),
            F.max_by("at_word", order).alias("at_word"),
        )
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` in which no benchmark item was found, all columns as they were."""
    # Rows are known by a 64-bit hash of id and text, as ids may be null or repeat.
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.xxhash64(F.col("doc_id").cast("long"), text)
    found = contaminated(documents.select(row.alias("doc_id"), text.alias("text")), benchmark)
    (name,) = free_names(documents, "found")
    found = found.select(F.col("doc_id").alias(name)).distinct()
    return documents.join(found.hint("merge"), row == F.col(name), "left_anti")
