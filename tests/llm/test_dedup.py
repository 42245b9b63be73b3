"""Exact, near and substring duplicates against brute force."""

import hashlib

import numpy as np
import pytest

from caseframe.llm import near_dedup, repeats
from caseframe.llm.exact_dedup import distinct_documents, exact_duplicates
from caseframe.llm.near_dedup import keep_one_of_each, near_duplicates
from caseframe.llm.queries import QUERIES
from caseframe.llm.work import components
from tests.llm.helpers import (
    SMALL,
    copies,
    documents,
    generator,
    near_components,
    repeats_of,
    sentence,
    small,
    texts,
)

EDGES = [(1, None), (2, ""), (3, "One"), (4, "one"), (5, " one "), (None, "one"), (6, "a b c d")]
EDGES += [(7, "a b c d"), (7, "a b c d"), (8, "\x0b\x1c   "), (9, "퟿ é" * 400)]


def exact_expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text, []).append(doc_id)
    result = []
    for doc_id, text in rows:
        ids = [one for one in groups[text] if one is not None]
        keep = max(ids) if ids else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        result.append((doc_id, keep, len(groups[text]), doc_id == keep, digest))
    return result


def in_order(rows):
    return sorted(rows, key=str)


def exact_rows(df):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return [tuple(row) for row in df.select(*names).collect()]


@pytest.mark.parametrize("salts", [1, 64])
def test_exact_equals_brute_force(spark, salts):
    rng = generator(1)
    rows = [(at, rng.choice(["a", "b", "", "A", sentence(rng, 3)])) for at in range(200)]
    found = exact_duplicates(documents(spark, rows), salts)
    assert in_order(exact_rows(found)) == in_order(exact_expected(rows))


def test_exact_edges(spark):
    rows = [(doc_id, text or "") for doc_id, text in EDGES]
    found = exact_duplicates(documents(spark, EDGES, extra=True))
    assert in_order(exact_rows(found)) == in_order(exact_expected(rows))
    assert exact_duplicates(documents(spark, [])).count() == 0


def test_distinct_documents_keep_one_row_and_all_columns(spark):
    df = documents(spark, EDGES, extra=True)
    kept = distinct_documents(df)
    assert kept.schema == df.schema
    rows = [(row["doc_id"], row["text"] or "") for row in kept.collect()]
    largest = {}
    for doc_id, text in EDGES:
        largest[text or ""] = max(largest.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert in_order(rows) == in_order((doc_id, text) for text, doc_id in largest.items())
    assert distinct_documents(documents(spark, [])).count() == 0


def near_rows(df):
    return {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in df.collect()}


@pytest.mark.parametrize("seed", [1])
@pytest.mark.parametrize("tile", [4, 256])
def test_near_equals_brute_force_on_copies_of_copies(spark, seed, tile):
    rows = copies(generator(seed))
    found = near_duplicates(documents(spark, rows), 85, tile=tile)
    assert near_rows(found) == near_components(rows, 85)
    assert all(row["kept"] == (row["doc_id"] == row["component_id"]) for row in found.collect())


@pytest.mark.parametrize("percent", [80, 85])
def test_near_equals_brute_force_on_the_tables(spark, percent):
    df = small(spark, "documents")
    assert near_rows(near_duplicates(df, percent)) == near_components(texts(df), percent)


def test_near_query_links_at_85(spark):
    found = QUERIES["op2_minhash_near_dedup"](spark, SMALL)
    assert near_rows(found) == near_components(texts(small(spark, "documents")), 85)


def test_near_edges_do_not_grow_with_the_tiles_of_a_group(spark, monkeypatch):
    rng = generator(8)
    words = sentence(rng, 120).split()
    rows = [(at, " ".join(f"w{at}" if i == at % 120 else w for i, w in enumerate(words))) for at in range(360)]
    given, whole = [], near_dedup.components

    def counted(edges):
        given.append(edges.count())
        return whole(edges)

    monkeypatch.setattr(near_dedup, "components", counted)
    found = near_duplicates(documents(spark, rows), 80, tile=12)
    assert near_rows(found) == near_components(rows, 80)
    # The smallest of each of the 30 tiles may be tied to that of each other.
    assert len(given) == 2 and max(given) < 2 * len(rows)


def test_stars_connect_what_the_ties_do(spark):
    ties = [(5, [1, 2]), (6, [2, 3]), (7, [3]), (8, [8]), (2, [2]), (9, [12])]
    edges = near_dedup.stars(spark.createDataFrame(ties, "node long, others array<long>"), "others")
    plain = spark.createDataFrame([(n, o) for n, all in ties for o in all], "a long, b long")
    assert sorted(components(edges).collect()) == sorted(components(plain).collect())


def test_near_finds_long_texts_beyond_the_sketch(spark):
    rng = generator(5)
    rows = copies(rng, n_bases=2, n_copies=8, words=600)
    passage = sentence(rng, 40)
    rows += [(1000 + at, f"{sentence(rng, 300)} {passage}") for at in range(20)]
    assert near_rows(near_duplicates(documents(spark, rows), 80)) == near_components(rows, 80)


def test_near_edges(spark):
    found = near_duplicates(documents(spark, EDGES, extra=True)).collect()
    by_id = {row["doc_id"]: row for row in found}
    assert len(found) == len(EDGES)
    assert (by_id[1]["n_shingles"], by_id[1]["component_id"]) == (0, 1)
    assert (by_id[2]["n_shingles"], by_id[2]["kept"]) == (0, True)
    assert [by_id[at]["component_id"] for at in (3, 4, 5)] == [3, 3, 3]
    assert by_id[None]["component_id"] == 3
    assert [row["component_id"] for row in found if row["doc_id"] in (6, 7)] == [6, 6, 6]
    assert near_duplicates(documents(spark, [])).count() == 0
    assert near_duplicates(documents(spark, [(1, None), (2, "")])).count() == 2


def test_keep_one_of_each(spark):
    rows = copies(generator(7))
    df = documents(spark, rows, extra=True)
    kept = keep_one_of_each(df, 80)
    assert kept.schema == df.schema
    expected = {root for _, root in near_components(rows, 80).values()}
    assert {row["doc_id"] for row in kept.collect()} == expected


def test_needed_is_met_by_all_similar_sets():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        size = int(rng.integers(1, 200))
        common = int(np.ceil(size * rng.uniform(0.85, 1)))
        values = rng.integers(0, 1 << 62, 2 * size + 5).astype(np.uint64)
        one = np.unique(values[:size])
        other = np.unique(np.concatenate([values[size - common : size], values[size : size + size // 9]]))
        both = len(np.intersect1d(one, other))
        if 100 * both < 85 * len(np.union1d(one, other)):
            continue
        shared = len(np.intersect1d(one[:64], other[:64]))
        assert shared >= max(near_dedup.needed(len(one), 85), near_dedup.needed(len(other), 85))


def test_estimate_counts_the_union_sketch():
    one, other = np.arange(0, 200, 2, dtype=np.uint64), np.arange(0, 200, dtype=np.uint64)
    both, seen = near_dedup.estimates([one[:64], other[:64], one[:3]], np.array([[0, 1], [0, 2]]))
    assert (both.tolist(), seen.tolist()) == ([32, 3], [64, 64])


def repeat_rows(df):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return [tuple(row) for row in df.select(*names).collect()]


@pytest.mark.parametrize("hot", [2])
def test_repeats_equal_brute_force_on_the_tables(spark, hot):
    df = small(spark, "documents")
    found = repeats.remove_repeats(df, hot=hot)
    assert in_order(repeat_rows(found)) == in_order(repeats_of(texts(df), 200))


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force_on_small_alphabets(spark, seed):
    rng = generator(seed)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randrange(5, 60))) for _ in range(12)]
    rows = [
        (at, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))) + "é" * (at % 40))
        for at in range(40)
    ]
    rows += [(100, "a" * 500), (101, "ab" * 100), (102, None), (102, None)]
    df = documents(spark, rows, extra=True)
    plain = [(doc_id, text or "") for doc_id, text in rows]
    for gram, hot in ((8, 4096), (20, 3)):
        found = repeats.remove_repeats(df, length=20, gram=gram, hot=hot)
        assert in_order(repeat_rows(found)) == in_order(repeats_of(plain, 20))


def test_repeats_within_one_text_and_edges(spark):
    rng = generator(9)
    once = sentence(rng, 50)
    rows = [(1, once + " and " + once), (2, None), (3, ""), (None, "x" * 250), (4, "y" * 200)]
    rows += [(5, once[:199]), (6, sentence(rng, 200)), (6, "z" * 3)]
    found = repeats.remove_repeats(documents(spark, rows, extra=True))
    plain = [(doc_id, text or "") for doc_id, text in rows]
    assert in_order(repeat_rows(found)) == in_order(repeats_of(plain, 200))
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_repeated_rows_are_copies_of_each_other(spark):
    rows = [(1, sentence(generator(3), 100))] * 2
    found = repeats.remove_repeats(documents(spark, rows)).collect()
    assert [row["n_removed"] for row in found] == [row["n_bytes"] for row in found]


def test_kept_bytes_have_the_digest(spark):
    found = repeats.remove_repeats(small(spark, "documents"), with_kept=True).collect()
    assert all(hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"] for row in found)
    assert any(row["n_removed"] for row in found)


def test_sets_go_to_python_in_batches_of_bounded_bytes(spark, monkeypatch):
    name, write, seen = "spark.sql.execution.arrow.maxBytesPerBatch", near_dedup.written, []

    def noted(df):
        seen.append(spark.conf.get(name))
        return write(df)

    monkeypatch.setattr(near_dedup, "written", noted)
    spark.conf.unset(name)
    before = spark.conf.get(name)
    near_duplicates(documents(spark, EDGES)).collect()
    assert seen.count(str(4 << 20)) == 2
    assert spark.conf.get(name) == before
