"""The manifest against a plain tree over lists."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from caseframe.llm import merkle
from caseframe.llm.queries import QUERIES
from tests.llm.helpers import DOCUMENT, SMALL, small


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return digest(
        *("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:1], row[3], row[2], row[4], text))
    )


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[at : at + 16]) for at in range(0, len(last), 16)])
    return levels


def siblings(levels, place):
    """Members of the run before and after the node, level by level."""
    found = []
    for level in levels[:-1]:
        start = place // 16 * 16
        found.append((level[start:place], level[place + 1 : start + 16]))
        place //= 16
    return found


def brute_force(rows):
    """Rows of (doc_id, text, lang, source, n_chars) to rows of the query, sorted."""
    trees = {}
    for row in rows:
        trees.setdefault(row[3], []).append((row, leaf(row, row[1])))
    names = sorted(trees, key=lambda name: (name is not None, (name or "").encode()))
    for members in trees.values():
        members.sort(key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
    built = {name: levels_of([own for _, own in trees[name]]) for name in names}
    top = levels_of([built[name][-1][0] for name in names]) if names else []
    result = []
    for at, name in enumerate(names):
        for place, (row, own) in enumerate(trees[name]):
            path = siblings(built[name], place) + siblings(top, at)
            changed = row[0] is not None and crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, lowered(row[1])) if changed else own
            for before, after in path:
                folded = digest(*before, folded, *after)
            proof = digest(*(d for before, after in path for d in (*before, *after)))
            root = top[-1][0]
            result.append(
                (row[0], own, built[name][-1][0], root, proof, folded, folded == root)
            )
    return sorted(result, key=str)


def told(spark, tmp_path, frame):
    frame.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
    ]
    return sorted(map(tuple, found.collect()), key=str)


def plain(frame):
    return [tuple(row) for row in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_given_documents(spark, tmp_path):
    docs = small(spark, "documents")
    result = told(spark, tmp_path, docs)
    assert result == brute_force(plain(docs))
    assert {row[-1] for row in result} == {True, False}


def test_more_rows_than_a_block_and_more_sources_than_a_block(spark, tmp_path):
    rng = random.Random(5)
    rows = [(at, f"Text {rng.random()}", "en", "hot", at) for at in range(merkle.BLOCK + 300)]
    rows += [(at, f"T{at}", None, f"s{at}", 1) for at in range(merkle.BLOCK + 20)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, DOCUMENT).repartition(5)
    assert told(spark, tmp_path, frame) == brute_force(rows)


@pytest.mark.parametrize("extra", [False, True])
def test_nulls_ties_and_repeated_rows(spark, tmp_path, extra):
    rows = [
        (None, None, None, None, None),
        (None, "A", "en", None, 1),
        (5, "Same", "en", "", 4),
        (5, "Same", "en", "", 4),
        (5, "Other", "en", "", 4),
        (7, "Éé ß 字", "de", "ä", 7),
        (-3, "", "", "z", 0),
        (8, "Long " * 400_000, "en", "z", 2_000_000),
    ]
    frame = spark.createDataFrame(rows, DOCUMENT)
    if extra:
        for name in ("tree", "place", "size", "block", "digest", "path", "root", "leaf", "part"):
            frame = frame.selectExpr("*", f"'mine' AS {name}")
    assert told(spark, tmp_path, frame) == brute_force(rows)


def test_one_row_and_none(spark, tmp_path):
    one = [(20, "Only", "en", "s", 4)]
    result = told(spark, tmp_path, spark.createDataFrame(one, DOCUMENT))
    assert result == brute_force(one) and result[0][1] == result[0][3]
    assert told(spark, tmp_path, spark.createDataFrame([], DOCUMENT)) == []
    empty = merkle.manifest(merkle.leaves_of(spark.createDataFrame([], DOCUMENT)))
    assert empty.root().collect() == [] and empty.source_roots().collect() == []


def test_roots_do_not_depend_on_the_layout(spark):
    docs = small(spark, "documents")
    one = merkle.manifest(merkle.leaves_of(docs.coalesce(1)))
    many = merkle.manifest(merkle.leaves_of(docs.repartition(13)))
    assert one.root().collect() == many.root().collect()
    assert sorted(one.source_roots().collect()) == sorted(many.source_roots().collect())


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_a_tree_once_and_keep_subtrees_together(levels):
    slots = [
        merkle.addresses(depth, np.arange(16**depth), levels).tolist() for depth in range(levels)
    ]
    assert sorted(slot for level in slots for slot in level) == list(range((16**levels - 1) // 15))
    if levels > 1:
        # A run of 16 at the bottom is stored side by side, behind its parent.
        runs = np.array(slots[-1]).reshape(-1, 16)
        if levels % 2 == 0 or levels == 5:
            assert (np.diff(runs, axis=1) == 1).all()
        bottom = levels - levels // 2
        under = 16 ** (levels // 2)
        subtree = np.sort(
            np.concatenate([np.array(level).reshape(under, -1) for level in slots[levels // 2 :]], axis=1),
            axis=1,
        )
        assert (np.diff(subtree, axis=1) == 1).all()
        assert subtree.shape[1] == (16**bottom - 1) // 15


def test_query_is_registered():
    assert "op13_merkle_manifest" in QUERIES and SMALL
