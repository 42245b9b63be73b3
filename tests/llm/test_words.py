import numpy as np
import pyarrow as pa

from caseframe.llm.words import byte_arrays, chunks, prefix_sums, shingle_sets, stretch_hashes, words
from caseframe.llm.work import components
from tests.llm.helpers import generator, shingles, words_of

TEXTS = ["", "A b\tC", "  é É x\x0b\x0cy ", "one", "a b c d", "a b c d e", " nbsp  em", "x" * 5000]


def _batch(values):
    return pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["text"])


def test_words_and_shingles_equal_plain_python():
    rng = generator(0)
    values = TEXTS + [
        "".join(rng.choice("aB \t\né\x1c") for _ in range(rng.randrange(60))) for _ in range(300)
    ]
    for size in (50, 1 << 20):
        names, sets = {}, []
        for part, data, offsets in chunks(_batch(values), size=size):
            found = words(data, offsets)
            for at, text in enumerate(part.column("text").to_pylist()):
                own = found.hashes[found.first[at] : found.first[at + 1]].tolist()
                plain = words_of(text)
                assert len(own) == len(plain)
                for word, value in zip(plain, own, strict=True):
                    assert names.setdefault(word, value) == value
            sets += [len(own) for own in shingle_sets(found, 5)]
        assert len(set(names.values())) == len(names)
        assert sets == [len(shingles(text)) for text in values]


def test_hashes_are_of_content_alone():
    data = np.frombuffer(b"abcabcab" * 30, np.uint8)
    at = np.array([0, 1, 24])
    hashes = stretch_hashes(prefix_sums(data), at, at + 5)
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_sliced_columns_keep_their_bytes():
    column = pa.array(["ab", "c", "", "def"], pa.string()).slice(1, 3)
    data, offsets = byte_arrays(column)
    assert bytes(data) == b"cdef" and offsets.tolist() == [0, 1, 1, 4]


def test_components_of_chains_and_stars(spark):
    rng = generator(4)
    chain = [(at, at + 1) for at in range(100, 160)]
    star = [(5, at) for at in range(6, 40)]
    edges = chain + star + [(200, 200), (301, 300)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    named = {row["node"]: row["component"] for row in found}
    expected = {at: 100 for at in range(100, 161)} | {at: 5 for at in range(5, 40)}
    assert named == expected | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
