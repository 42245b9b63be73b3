"""Plain Python versions of the operators and small tables for their tests."""

import hashlib
import random
import re

from tests.conftest import TESTDATA

SMALL = f"{TESTDATA}/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def small(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def documents(spark, pairs, extra=False):
    """A documents table of (id, text), with null metadata now and then."""
    rows = [
        (doc_id, text, None if at % 3 == 0 else "en", f"src{at % 2}", None if text is None else len(text))
        for at, (doc_id, text) in enumerate(pairs)
    ]
    if not extra:
        return spark.createDataFrame(rows, DOCUMENT)
    clash = "kept boolean, digest string, salt int, node long, component_id string, bucket int, tags map<string,int>"
    rows = [(*row, True, "x", 1, 2, "y", 3, {"a": 1}) for row in rows]
    return spark.createDataFrame(rows, f"{DOCUMENT}, {clash}")


def texts(df):
    return [(row["doc_id"], row["text"] or "") for row in df.select("doc_id", "text").collect()]


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [word for word in re.split(r"[\x20\x09-\x0d]+", lowered) if word]


def shingles(text, size=5):
    found = words_of(text)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[at : at + size]) for at in range(len(found) - size + 1)}


def near_components(rows, percent):
    """Smallest reachable id of each id, over all pairs."""
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in ids}


def repeats_of(rows, length):
    """n_bytes, n_removed, n_spans and digest of what is left, for each row."""
    data = [text.encode() for _, text in rows]
    seen = {}
    for content in data:
        for at in range(len(content) - length + 1):
            window = content[at : at + length]
            seen[window] = seen.get(window, 0) + 1
    result = []
    for (doc_id, _), content in zip(rows, data, strict=True):
        gone = bytearray(len(content))
        for at in range(len(content) - length + 1):
            if seen[content[at : at + length]] > 1:
                gone[at : at + length] = b"\1" * length
        kept = bytes(byte for byte, out in zip(content, gone, strict=True) if not out)
        spans = sum(1 for at, out in enumerate(gone) if out and (at == 0 or not gone[at - 1]))
        digest = hashlib.sha256(kept).hexdigest()
        result.append((doc_id, len(content), sum(gone), spans, digest))
    return result


VOCABULARY = [f"w{number}" for number in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def copies(rng, n_bases=6, n_copies=12, words=60):
    """Texts and copies of them with some words changed, ids in random order."""
    made = []
    for _ in range(n_bases):
        base = sentence(rng, words + rng.randrange(40)).split()
        made.append(" ".join(base))
        for _ in range(n_copies):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            made.append(" ".join(copy))
    rng.shuffle(made)
    return list(enumerate(made))


def generator(seed):
    return random.Random(seed)
