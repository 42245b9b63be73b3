"""Removal of every byte that a repeated stretch of ``LENGTH`` bytes covers.

Prefix-free parsing on Spark. A rolling hash of ``GRAM`` bytes runs over each
text; the smallest hash among those inside a window of ``LENGTH`` bytes is the
window's trigger. Equal windows have equal triggers at equal places, wherever
they are, and every window has one. Neighbouring windows with the same trigger
make a phrase, the text from the first window's start to the last one's end.

* The parse is the list of phrases of each text, as hashes of trigger and content.
* The dictionary holds each different phrase once. A trigger that occurs once in
  the corpus ends there: its windows are unique. That is most of a corpus.
* A phrase that occurs twice repeats in all its windows. Where a trigger has
  different phrases, the text of one occurrence of each is fetched, and 64-bit
  hashes of its windows are sorted within the trigger. Equal neighbours are the
  repeated windows. No suffix array is made, of the dictionary or of the parse:
  only equality over ``LENGTH`` bytes is asked, which the hashes answer up to a
  collision, and phrases reach to the end of their last window.
* The parse then tells each text which of its windows repeat.

A trigger with more than ``HOT`` different phrases, such as the edge of a very
common passage, is not ordered by one task: its windows are rows of their own,
and Spark counts them.

Texts are bytes of UTF-8, so removal may leave a part of a character; matches
never cross documents, and what is removed is judged on the input. Null and
empty texts have no bytes. Rows that repeat text are copies of each other, also
when they repeat the id, or it is null. Texts shorter than the length keep all
bytes. Extra columns are ignored; an empty table gives an empty result. A single
text may have up to 256 MB.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.words import chunks, prefix_sums, stretch_hashes
from caseframe.llm.work import texts, whole_groups, written

LENGTH = 200
GRAM = 32
HOT = 4096
_CHUNK = 1 << 20
_PLACE_BITS = np.uint64(28)

_PARSE = "text_key long, triggers array<long>, phrases array<long>, starts array<int>, counts array<int>"
_CONTENT = "trigger long, phrase long, n long, content binary"
_MARKS = "trigger long, phrase long, run_start int, run_end int"


def parse(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Phrases of all texts: trigger, content hash, start of the first window, windows, text."""
    none = np.zeros(0, np.int64)
    if len(data) >= 1 << int(_PLACE_BITS):
        raise ValueError("a text has more than 256 MB")
    if len(data) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    sums = prefix_sums(data)
    places = np.arange(len(data) - gram + 1)
    hashes = stretch_hashes(sums, places, places + gram)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    lowest = (hashes >> _PLACE_BITS << _PLACE_BITS) | places.astype(np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        lowest = np.minimum(lowest[:-span], lowest[span:])
        span *= 2
    if span < width:
        lowest = np.minimum(lowest[: len(lowest) - (width - span)], lowest[width - span :])
    trigger = (lowest & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(trigger)]
    valid = np.ones(len(trigger), bool)
    for end in offsets[1:-1].tolist():
        valid[max(end - length + 1, 0) : end] = False  # would reach into the next text
    start = np.flatnonzero(valid)
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    new = np.ones(len(start), bool)
    new[1:] = (trigger[start[1:]] != trigger[start[:-1]]) | (owner[start[1:]] != owner[start[:-1]])
    first = start[new]
    count = np.diff(np.flatnonzero(np.append(new, True)))
    content = stretch_hashes(sums, first, first + count - 1 + length)
    return hashes[trigger[first]], content, first, count, owner[first]


def _parsed(length: int, gram: int):
    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, size=_CHUNK):
                trigger, phrase, first, count, owner = parse(data, offsets, length, gram)
                ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                start = first - offsets[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("text_key"),
                        *(
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                            for values in (
                                trigger.view(np.int64),
                                phrase.view(np.int64),
                                start.astype(np.int32),
                                count.astype(np.int32),
                            )
                        ),
                    ],
                    ["text_key", "triggers", "phrases", "starts", "counts"],
                )

    return run


def _contents(length: int, gram: int):
    """Bytes of the phrases that the dictionary asks for; ``asked`` has phrase and count."""

    def run(batches):
        for batch in batches:
            for part, data, offsets in chunks(batch, size=_CHUNK):
                trigger, phrase, first, count, owner = parse(data, offsets, length, gram)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                plain, rows = data.tobytes(), []
                for at, asked in enumerate(part.column("asked").to_pylist()):
                    wanted = {(row["trigger"], row["phrase"]): row["n"] for row in asked}
                    for i in range(bounds[at], bounds[at + 1]):
                        name = (int(trigger[i].view(np.int64)), int(phrase[i].view(np.int64)))
                        n = wanted.pop(name, None)
                        if n is not None:
                            end = first[i] + count[i] - 1 + length
                            rows.append((*name, n, plain[first[i] : end]))
                columns = zip(*rows, strict=True) if rows else [[], [], [], []]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
                    ["trigger", "phrase", "n", "content"],
                )

    return run


def _windows(frame: pd.DataFrame, length: int):
    """Row of the frame, place in the phrase and hash of all windows of its phrases."""
    sizes = np.array([len(value) for value in frame["content"]], np.int64)
    data = np.frombuffer(b"".join(frame["content"]), np.uint8)
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(frame)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(sizes) - sizes)[row] + place
    return row, place, stretch_hashes(prefix_sums(data), start, start + length)


def _runs(frame: pd.DataFrame, row: np.ndarray, place: np.ndarray) -> pd.DataFrame:
    """Repeated windows, in order of row and place, as runs of phrases."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    owner = row[first]
    return pd.DataFrame(
        {
            "trigger": frame["trigger"].to_numpy()[owner],
            "phrase": frame["phrase"].to_numpy()[owner],
            "run_start": place[first].astype("int32"),
            "run_end": (place[last] + 1).astype("int32"),
        }
    )


def _ordered(length: int):
    """Sort the window hashes of each trigger's phrases and mark equal neighbours."""

    def run(frames):
        for frame in whole_groups(frames, "trigger"):
            row, place, hashes = _windows(frame, length)
            trigger, n = frame["trigger"].to_numpy()[row], frame["n"].to_numpy()[row]
            order = np.lexsort((hashes, trigger))
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (
                trigger[order[1:]] != trigger[order[:-1]]
            )
            first = np.flatnonzero(new)
            if not len(first):
                continue
            times = np.add.reduceat(n[order], first)
            repeated = np.zeros(len(order), bool)
            repeated[order] = np.repeat(times > 1, np.diff(np.append(first, len(order))))
            if repeated.any():
                yield _runs(frame, row[repeated], place[repeated])

    return run


def _window_rows(length: int):
    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at : at + 500].reset_index(drop=True)
                row, place, hashes = _windows(part, length)
                yield pd.DataFrame(
                    {
                        "trigger": part["trigger"].to_numpy()[row],
                        "phrase": part["phrase"].to_numpy()[row],
                        "n": part["n"].to_numpy()[row],
                        "place": place.astype("int32"),
                        "hash": hashes.view(np.int64),
                    }
                )

    return run


def _counted(contents: DataFrame, length: int) -> DataFrame:
    """Marks of hot triggers: a row per window, counted by Spark."""
    windows = contents.mapInPandas(
        _window_rows(length), "trigger long, phrase long, n long, place int, hash long"
    )
    windows = written(windows)
    again = windows.groupBy("trigger", "hash").agg(F.sum("n").alias("times")).filter("times > 1")
    return windows.join(again, ["trigger", "hash"]).select(
        "trigger", "phrase", F.col("place").alias("run_start"), (F.col("place") + 1).alias("run_end")
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap, in order."""
    result: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


_RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string,"
    " spans array<struct<start: long, end: long>>"
)


def _removed(with_kept: bool):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = {
        "n_bytes": pa.int64(),
        "n_removed": pa.int64(),
        "n_spans": pa.int64(),
        "kept_sha256": pa.string(),
        "spans": span,
    }
    kinds |= {"kept": pa.binary()} if with_kept else {}

    def run(batches):
        for batch in batches:
            rows = {name: [] for name in kinds}
            for part, data, offsets in chunks(batch, size=_CHUNK):
                for at, found in enumerate(part.column("found").to_pylist()):
                    text = data[offsets[at] : offsets[at + 1]]
                    spans = merged([(one["start"], one["end"]) for one in found or ()])
                    bounds = [0, *(place for both in spans for place in both), len(text)]
                    kept = b"".join(
                        text[start:end].tobytes()
                        for start, end in zip(bounds[::2], bounds[1::2], strict=True)
                    )
                    rows["n_bytes"].append(len(text))
                    rows["n_removed"].append(len(text) - len(kept))
                    rows["n_spans"].append(len(spans))
                    rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    rows["spans"].append([{"start": start, "end": end} for start, end in spans])
                    if with_kept:
                        rows["kept"].append(kept)
            arrays = [pa.array(rows[name], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays], ["doc_id", *kinds]
            )

    return run


def remove_repeats(
    documents: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
    with_kept: bool = False,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans`` of each row.

    With ``with_kept`` the remaining bytes come along as ``kept``.
    """
    rows = texts(documents).withColumn("text_key", F.xxhash64("doc_id", "text"))
    parses = written(rows.select("text_key", "text").mapInArrow(_parsed(length, gram), _PARSE))
    spots = parses.select(
        "text_key", F.explode(F.arrays_zip("triggers", "phrases", "starts", "counts")).alias("spot")
    ).select(
        "text_key",
        F.col("spot.triggers").alias("trigger"),
        F.col("spot.phrases").alias("phrase"),
        F.col("spot.starts").alias("start"),
        F.col("spot.counts").alias("count"),
    )
    again = written(
        spots.groupBy("trigger")
        .agg(F.count("*").alias("n"), F.min("phrase").alias("low"), F.max("phrase").alias("high"))
        .filter("n > 1")
        .select("trigger", (F.col("low") != F.col("high")).alias("differs"))
    )
    found = written(spots.join(again, "trigger"))
    dictionary = written(
        found.groupBy("trigger", "phrase", "count", "differs").agg(
            F.count("*").alias("n"), F.min("text_key").alias("text_key")
        )
    )
    whole = dictionary.filter("n > 1").select(
        "trigger", "phrase", F.lit(0).alias("run_start"), F.col("count").alias("run_end")
    )

    # Text of one occurrence of each phrase whose trigger has others.
    asked = (
        dictionary.filter("differs")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("trigger", "phrase", "n")).alias("asked"))
    )
    distinct_rows = rows.select("text_key", "text")
    contents = written(
        distinct_rows.join(asked.hint("merge"), "text_key").mapInArrow(_contents(length, gram), _CONTENT)
    ).dropDuplicates(["trigger", "phrase"])
    crowds = dictionary.filter("differs").groupBy("trigger").agg(F.count("*").alias("phrases"))
    crowded = written(crowds.filter(F.col("phrases") > hot).select("trigger"))
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = [
        whole,
        contents.join(crowded, "trigger", "left_anti")
        .repartition(width, "trigger")
        .sortWithinPartitions("trigger")
        .mapInPandas(_ordered(length), _MARKS),
    ]
    if not crowded.isEmpty():
        marks.append(_counted(contents.join(crowded, "trigger", "left_semi"), length))
    marked = marks[0]
    for more in marks[1:]:
        marked = marked.unionByName(more)
    marked = written(marked)
    spans = written(
        found.join(marked, ["trigger", "phrase"])
        .groupBy("text_key")
        .agg(
            F.collect_set(
                F.struct(
                    (F.col("start") + F.col("run_start")).alias("start"),
                    (F.col("start") + F.col("run_end") - 1 + length).alias("end"),
                )
            ).alias("found")
        )
    )
    return (
        rows.join(spans.hint("merge"), "text_key", "left")
        .select("doc_id", "text", "found")
        .mapInArrow(_removed(with_kept), _RESULT + (", kept binary" if with_kept else ""))
    )
