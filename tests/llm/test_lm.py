import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from caseframe.llm import lm
from caseframe.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, small, texts, words_of


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def check_counts(found, plain):
    counts = collections.Counter()
    for doc_id, text in plain:
        if not is_held_out(doc_id):
            counts.update([*words_of(text), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in plain:
        tokens = [*words_of(text), None]
        base = sum(math.log10((counts[token] + 1) / (n + v + 1)) for token in tokens)
        known = sum(counts[token] > 0 for token in tokens)
        expected.append((str(doc_id), is_held_out(doc_id), len(tokens), known, n, round(base, 6)))
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    rows = [
        (str(row["doc_id"]), *(row[name] for name in names), round(row["base_score"], 6))
        for row in found
    ]
    assert sorted(rows) == sorted(expected)
    assert all(row["score"] <= 0 and math.isfinite(row["score"]) for row in found)


def test_counts_and_base_scores_equal_brute_force(spark):
    found = QUERIES["op7_lm_scoring"](spark, SMALL).collect()
    check_counts(found, texts(small(spark, "documents")))


def test_many_blocks_give_the_counts_of_one(spark):
    df = small(spark, "documents")
    check_counts(lm.score_texts(df, block_bytes=20_000).collect(), texts(df))


def test_model_beats_the_base_on_held_out_documents(spark):
    df = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    held = [row for row in lm.score_texts(df, block_bytes=200_000).collect() if row["held_out"]]
    tokens = sum(row["n_tokens"] for row in held)
    gain = sum(row["score"] - row["base_score"] for row in held) / tokens
    assert gain > 0.05


def test_class_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    share = rng.random(20)
    model = lm.Model(share / share.sum(), rng.normal(0, 1, 21 * 16 + 20 * 16 + 3 * 16 + 20))
    context = rng.integers(0, 21, (1, 3))
    total = sum(
        math.exp(model.log_probabilities(context, np.array([target]))[0]) for target in range(20)
    )
    assert abs(total - 1) < 1e-5


def test_training_learns_what_follows_what():
    rng = np.random.default_rng(0)
    contexts = rng.integers(0, 4, (20_000, 3))
    targets = (contexts[:, 0] + 1) % 4
    trainer = lm.Trainer(lm.Model(np.full(4, 0.25)), seed=0)
    for _ in range(20):
        trainer.learn(contexts, targets)
    assert trainer.model.log_probabilities(contexts[:500], targets[:500]).mean() > -0.5


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a B"), (3, "a b"), (3, "a b"), (4, "x " * 50_000), (11, "new")]
    found = lm.score_texts(documents(spark, rows, extra=True)).collect()
    check_counts(found, [(doc_id, text or "") for doc_id, text in rows])
    assert lm.score_texts(documents(spark, [])).count() == 0
    held = next(number for number in range(100) if is_held_out(number))
    (only,) = lm.score_texts(documents(spark, [(held, "never seen")])).collect()
    assert (only["n_known"], only["train_tokens"], only["base_score"]) == (0, 0, 0.0)


def scores_of(spark, training, tried):
    """Scores of texts that are held out, learnt from others."""
    numbers = [number for number in range(100_000) if not is_held_out(number)]
    held = [number for number in range(10_000) if is_held_out(number)]
    rows = [*zip(numbers, training, strict=False), *zip(held, tried, strict=False)]
    found = lm.score_texts(documents(spark, rows), block_bytes=4_000, bucket_words=500).collect()
    check_counts(found, rows)
    scores = {row["doc_id"]: row["score"] for row in found}
    return [scores[number] for number in held[: len(tried)]]


def test_rare_words_of_one_class_have_vectors_of_their_own(spark):
    fillers = " ".join(f"f{number}" for number in range(110))
    training = [fillers] * 50 + ["left f3", "right f4"] * 60
    training += ["left aaxy", "right bbxy"] * 20 + ["ccxz left", "ddxz right"] * 20
    a, b, c, d = scores_of(
        spark, training, ["left aaxy", "left bbxy", "right aaxy", "right bbxy"]
    )
    assert a > b + 0.1 and d > c + 0.1
    a, b, c, d = scores_of(
        spark, training, ["ccxz left", "ccxz right", "ddxz left", "ddxz right"]
    )
    assert a - b > c - d + 0.1


def test_probabilities_of_all_words_add_up_to_one():
    rng = np.random.default_rng(0)
    names = ["left", *(f"w{number}" for number in range(300))]
    plain = ["left", *(f"left {name}" for name in names)]
    plain += [" ".join(rng.choice(names, 20)) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": [*range(len(plain))], "text": plain, "held_out": [False] * len(plain)}
    )
    ((part, data, offsets),) = lm.chunks(batch)
    row = lm._block(0, part, data, offsets, lm.SHARED)
    block = lm.Block(next(lm._rows(row)))
    left = block.vocabulary[block.tokens[0]]
    frequent = np.sort(np.array([lm.END, left]))
    classes, n = block.classes(frequent), np.bincount(block.tokens)
    size = len(frequent) + lm.SHARED
    class_n = np.bincount(classes, n, size)
    model = lm.Model((class_n + 1) / (class_n + 1).sum())
    follow = np.zeros((size + 1, size), int)
    np.add.at(follow, (block.contexts(classes, size)[:, 0], classes[block.tokens]), 1)
    distinct = np.bincount(classes, minlength=size)
    words_model = lm.WordModel(model, 2, follow, class_n[2:], distinct[2:])
    told, weights = [], 0
    asked = pa.Table.from_batches(lm._asked(frequent, size, 3)([row]))
    for bucket in range(3):
        some = asked.filter(pc.equal(asked["bucket"], bucket))
        answer = lm._answered(words_model, 2)(some).to_pylist()
        told.append(lm._inflated(answer[0]["answer"], lm._ANSWER))
        weights = weights + np.frombuffer(answer[1]["weights"]).reshape(lm.SHARED, size + 1)
    answers = np.concatenate(told)
    shared = classes >= 2
    assert answers["n"][shared].tolist() == n[shared].tolist()
    assert answers["before"][shared].any() and answers["after"][shared].any()
    logs = lm._of_tokens(block, answers, n, model, words_model, np.log(weights + 1))
    first = np.cumsum(block.n_tokens) - block.n_tokens
    at = first[: len(names) + 1] + 1
    beside = classes[block.tokens[0]]
    contexts = np.repeat(block.contexts(classes, size)[at[:1]], lm.SHARED, axis=0)
    kinds = np.exp(model.log_probabilities(contexts, np.arange(2, size)))
    unseen = (kinds / (weights[:, beside] + 1)).sum()
    assert abs(np.exp(logs[at]).sum() + unseen - 1) < 1e-4
