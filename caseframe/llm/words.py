"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

Works on the UTF-8 bytes of an Arrow column, a few megabytes at a time, so that
the cost of Python is per chunk and per document, not per word.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Words are runs of bytes other than space, \t, \n, \v, \f and \r.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Runs of letters only: ASCII letters and whatever is not ASCII.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = False
#: Runs of letters and digits.
NO_LETTER_OR_DIGIT = NO_LETTER.copy()
NO_LETTER_OR_DIGIT[ord("0") : ord("9") + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 20


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(base: int, count: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``count``."""
    result = np.ones(max(count, 1), np.uint64)
    filled, factor = 1, base
    while filled < count:
        upto = min(2 * filled, count)
        result[filled:upto] = result[: upto - filled] * np.uint64(factor)
        filled, factor = upto, factor * factor % (1 << 64)
    return result[:count]


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    if base not in _tables or len(_tables[base]) < count:
        # Twice what is asked for, so that longer and longer texts seldom make a new one.
        _tables[base] = powers(base, _CHUNK + 1 if count <= _CHUNK + 1 else 2 * count)
    return _tables[base][:count]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of the bytes follows, one longer."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], equal for equal content."""
    raw = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column without nulls, and its n + 1 offsets."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)
    places = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return content[places[0] : places[-1]], places - places[0]


def chunks(
    batch: pa.RecordBatch, name: str = "text", size: int = _CHUNK
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``size`` bytes of text, at least a row each."""
    _, offsets = byte_arrays(batch.column(name))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        part = batch.slice(start, end - start)
        yield part, *byte_arrays(part.column(name))
        start = end


@dataclass
class Words:
    """Words of all texts of a chunk in order; text i has words[first[i]:first[i + 1]]."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def _word_hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words, a stretch of bytes at a time: the sums take eight bytes for each."""
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = max(int(np.searchsorted(ends, starts[at] + _CHUNK, side="right")), at + 1)
        base = starts[at]
        sums = prefix_sums(lower[base : ends[upto - 1]])
        hashes[at:upto] = stretch_hashes(sums, starts[at:upto] - base, ends[at:upto] - base)
        at = upto
    return hashes


def words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
) -> Words:
    """Lower-cased (A-Z) words of the texts: runs of bytes that are no separators."""
    lower = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(separator[data], out=inside[1:-1])
    starts_here = inside[1:-1] & ~inside[:-2]
    ends_here = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts_here[cuts] = inside[1:-1][cuts]
    ends_here[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(starts_here)
    ends = np.flatnonzero(ends_here) + 1
    hashes = _word_hashes(lower, starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def shingle_sets(found: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words than ``size`` has its whole sequence as one shingle,
    a text without words has none.
    """
    count = len(found.hashes)
    rolled = np.zeros(max(count - size + 1, 0), np.uint64)
    for place in range(size):
        rolled = rolled * np.uint64(_BASE) + found.hashes[place : place + len(rolled)]
    rolled = mixed(rolled)
    sets = []
    for start, end in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if end - start >= size:
            sets.append(np.unique(rolled[start : end - size + 1]))
        elif end > start:
            whole = np.array([end - start], np.uint64)
            for place in range(start, end):
                whole = mixed(whole * np.uint64(_BASE) + found.hashes[place : place + 1])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
