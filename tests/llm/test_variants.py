"""Words, neighbours and forms against plain loops over all pairs."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from caseframe.llm import variants
from caseframe.llm.queries import QUERIES
from tests.llm.helpers import DOCUMENT, small


def words_of(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            digest = crc32(f"{doc_id}:{run}".encode())
            if digest % 199 == 0:
                at = digest % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {word: n for word, n in total.items() if len(word) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:at] + b[at + 1 :] == a for at in range(len(b)))


def near_words(words):
    """Neighbours by the words with one letter left out, checked by ``one_edit``."""
    shorter = {}
    for word in words:
        for key in {word, *(word[:at] + word[at + 1 :] for at in range(len(word)))}:
            shorter.setdefault(key, set()).add(word)
    near = {word: set() for word in words}
    for group in shorter.values():
        for word in group:
            near[word] |= {other for other in group if other != word and one_edit(word, other)}
    return near


def brute_force(words):
    near = near_words(words)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-words[other], other), default=None)
        form[word] = best if best and words[best] >= 5 * words[word] else None
    result = []
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        result.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(result, key=str)


def rows_of(df):
    return sorted(
        map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str
    )


def test_given_documents(spark):
    docs = small(spark, "documents")
    words = words_of([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows_of(variants.spelling_variants(docs)) == brute_force(words)


def invented(rng, n):
    """Words of few letters, so that many are near, with copies one or two edits away."""
    letters = "abcdehtéÀÿz"
    words = {}
    while len(words) < n:
        word = "".join(rng.choice(letters[:5]) for _ in range(rng.randint(6, 9)))
        for _ in range(rng.randint(1, 4)):
            words[word] = rng.choice([5, 5, 6, 25, 26, 125, 130, 700])
            at = rng.randrange(len(word))
            kind = rng.randrange(3)
            middle = "" if kind == 0 else rng.choice(letters)
            word = word[:at] + middle + word[at + (kind != 2) :]
            if len(word) < 6:
                break
    return words


def test_words_with_many_neighbours(spark, monkeypatch):
    monkeypatch.setattr(variants, "_TILE", 50)
    words = invented(random.Random(3), 3000)
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    result = rows_of(variants.group_words(frame))
    assert result == brute_force(words)
    assert sum(row[1] != row[2] for row in result if row[1]) > 5


def test_chains_are_followed_to_the_end(spark):
    chain = ["aaaaaaaaaaaa"[:6] + "b" * k for k in range(9)]
    words = {word: 5 * 5**k for k, word in enumerate(chain)} | {"zzzzzz": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    result = rows_of(variants.group_words(frame))
    assert result == brute_force(words)
    assert {row[2] for row in result} == {chain[-1], "zzzzzz"}


def test_edge_cases(spark):
    long = "q" * 70_000
    texts = [
        None,
        "",
        "short × 12345 ÉÉÉÉÉÉ éééééé",
        " ".join(["Colour color colours COLOUR colou-r"] * 6),
        " ".join([f"{long} {long}x"] * 5),
        "colour colour",
        "naïveté naıveté " * 5,
    ]
    rows = [(at // 2 if at else None, text, "en", "s", 1) for at, text in enumerate(texts)] * 3
    frame = spark.createDataFrame(rows, DOCUMENT)
    plain = words_of([("" if r[0] is None else r[0], r[1]) for r in rows])
    assert long in plain
    expected = brute_force(plain)
    assert rows_of(variants.spelling_variants(frame)) == expected
    clash = frame.selectExpr("*", "'x' AS word", "1 AS n", "2 AS block", "3 AS tile", "'y' AS form")
    assert rows_of(variants.spelling_variants(clash)) == expected


def test_no_rows_and_no_forms_from_weak_dominance(spark):
    assert variants.spelling_variants(spark.createDataFrame([], DOCUMENT)).collect() == []
    with pytest.raises(ValueError):
        variants.group_words(spark.createDataFrame([], "word string, n long"), 1)


@pytest.mark.parametrize("seed", range(4))
def test_products_find_what_all_pairs_find(seed):
    rng = random.Random(seed)
    words = sorted(invented(rng, 400))
    for length in (6, 7, 8):
        a = [word for word in words if len(word) == length]
        for more in (0, 1):
            b = [word for word in words if len(word) == length + more]
            left, right = variants.near_pairs(a, b, more == 0)
            found = {(a[x], b[y]) for x, y in zip(left, right, strict=True)}
            pairs = ((x, y) for x in a for y in b if more or x < y)
            assert found == {(x, y) for x, y in pairs if one_edit(x, y)}


def test_every_edit_leads_to_a_block_beside(spark):
    words = sorted(invented(random.Random(9), 300))
    steps = {tuple(step) for step in variants._steps()}
    steps |= {tuple(-np.array(step)) for step in steps}

    def counts(word):
        return np.array([sum(ord(c) % variants.CLASSES == k for c in word) for k in range(variants.CLASSES)])

    for a in words:
        for b in words:
            if one_edit(a, b):
                assert tuple(counts(b) - counts(a)) in steps


def test_query(spark):
    assert "op11_spelling_variants" in QUERIES
