import numpy as np
import pandas as pd

from caseframe.llm import decontaminate
from caseframe.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, generator, sentence, small, texts

ITEM = "item_id long, text string, doc_id long"


def items(spark, rows):
    return spark.createDataFrame([(*row, 1) for row in rows], ITEM)


def test_finds_all_verbatim_passages_and_nothing_else(spark):
    found = QUERIES["op4_benchmark_decontamination"](spark, SMALL).collect()
    passages = texts(small(spark, "benchmark").withColumnRenamed("item_id", "doc_id"))
    expected = {
        (doc_id, item_id)
        for doc_id, text in texts(small(spark, "documents"))
        for item_id, passage in passages
        if passage in text
    }
    assert {(row["doc_id"], row["item_id"]) for row in found} == expected


def changed(rng, text, share):
    return " ".join(f"new{rng.randrange(9)}" if rng.random() < share else word for word in text.split())


def planted(n=120):
    rng = generator(3)
    bench = [(at, sentence(rng, 14 + at % 50)) for at in range(30)]
    docs, expected = [], set()
    for at in range(n):
        before, after = sentence(rng, rng.randrange(200)), sentence(rng, rng.randrange(200))
        if at % 4 == 0:
            item = bench[at % len(bench)]
            docs.append((at, f"{before} {changed(rng, item[1], 0.08)} {after}"))
            expected.add((at, item[0]))
        else:
            docs.append((at, f"{before} {after}"))
    return docs, bench, expected


def test_finds_passages_with_changed_words(spark):
    docs, bench, expected = planted()
    found = decontaminate.contaminated(documents(spark, docs), items(spark, bench))
    pairs = {(row["doc_id"], row["item_id"]) for row in found.collect()}
    assert len(pairs & expected) >= 0.9 * len(expected)
    assert not pairs - expected


def test_without_contaminated_keeps_all_columns_and_clean_rows(spark):
    docs, bench, expected = planted(40)
    df = documents(spark, [*docs, (None, "x"), (900, None)], extra=True)
    kept = decontaminate.without_contaminated(df, items(spark, bench))
    assert kept.schema == df.schema
    ids = {row["doc_id"] for row in kept.collect()}
    assert ids >= {at for at, _ in docs if at % 4} | {None, 900}


def test_common_subsequence_equals_brute_force():
    rng = generator(8)
    for _ in range(200):
        own = [rng.randrange(6) for _ in range(rng.randrange(1, 20))]
        other = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        table = [[0] * (len(other) + 1) for _ in range(len(own) + 1)]
        for i, a in enumerate(own):
            for j, b in enumerate(other):
                table[i + 1][j + 1] = table[i][j] + 1 if a == b else max(table[i][j + 1], table[i + 1][j])
        masks = decontaminate._masks(own)
        assert decontaminate.common_subsequence(masks, len(own), other) == table[-1][-1]


def test_edges(spark):
    bench = [(1, sentence(generator(1), 20)), (2, None), (3, ""), (4, "..."), (None, "a b c d")]
    passage = bench[0][1]
    rows = [(1, None), (2, ""), (3, "..."), (None, passage), (4, passage.upper()), (4, passage), (5, "one")]
    rows += [(6, "z " * 60_000 + passage)]
    found = decontaminate.contaminated(documents(spark, rows, extra=True), items(spark, bench))
    assert {(row["doc_id"], row["item_id"]) for row in found.collect()} == {(None, 1), (4, 1), (6, 1)}
    assert decontaminate.contaminated(documents(spark, []), items(spark, bench)).count() == 0
    assert decontaminate.contaminated(documents(spark, rows), items(spark, [])).count() == 0


def test_gate_finds_what_the_common_subsequence_finds(spark):
    rng = generator(12)

    def common(n):
        return [f"w{int(3000 ** rng.random())}" for _ in range(n)]

    bench, docs = [], []
    for length in (15, 24, 40, 64, 96, 250, 600, 1000):
        for percent in (60, 80, 100):
            for insert in (0, 1):
                item = common(length)
                kept = set(rng.sample(range(length), -(-length * percent // 100)))
                # The answer stays, so that 60 percent are enough.
                words = [
                    word
                    for at, own in enumerate(item)
                    for word in ([own] if at in kept or at >= length - 3 else common(insert))
                ]
                at = len(bench)
                bench.append((at, " ".join(item[:-3]) + ". " + " ".join(item[-3:])))
                docs.append((at, " ".join([*common(rng.randrange(90)), *words, *common(rng.randrange(90))])))
    docs += [(1000 + at, " ".join(common(200))) for at in range(300)]
    found = decontaminate.contaminated(documents(spark, docs), items(spark, bench)).collect()
    own = {row["doc_id"] for row in found if row["doc_id"] == row["item_id"]}
    assert own == set(range(len(bench)))
    assert all(row["lcs_ratio"] >= decontaminate.WEAK for row in found)


def test_space_is_fitted_on_all_rows(spark, monkeypatch):
    seen = []
    fit = decontaminate.latent_space
    monkeypatch.setattr(
        decontaminate, "latent_space", lambda rows, idf: seen.append(rows.count()) or fit(rows, idf)
    )
    df = documents(spark, []).unionByName(
        spark.range(30_000).selectExpr(
            "id doc_id", "'a b' text", "'en' lang", "'s' source", "3L n_chars"
        )
    )
    decontaminate.contaminated(df, items(spark, [(1, "a b c d")]))
    assert seen == [30_001]


def test_texts_are_split_once_for_the_space_and_the_counts(spark, monkeypatch):
    rng = generator(5)
    rows = [(at, sentence(rng, rng.randrange(40))) for at in range(50)] + [(50, None), (51, "a " * 400)]
    df = decontaminate.texts(documents(spark, rows))
    split = df.select("text").mapInArrow(decontaminate._split, decontaminate._SPLIT).collect()
    expected = [
        decontaminate._features(decontaminate._word_hashes(text or "")).tolist() for _, text in rows
    ]
    assert [np.frombuffer(row["features"], np.uint16).tolist() for row in split] == expected


def test_sums_equal_plain_ones():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 100, (500, 3)).astype(np.float32)
    places = rng.integers(0, 500, 9000)
    # Stretches of one place, of a piece, of more and of several rounds of pieces.
    for first in ([0, 1, 2, 34, 67, 70, 5000], [0], list(range(0, 9000, 8))):
        expected = np.add.reduceat(rows[places], first, axis=0)
        assert (decontaminate._sums(rows, places, np.array(first)) == expected).all()


def test_no_common_subsequence_is_longer_than_the_bound():
    rng = np.random.default_rng(0)
    for _ in range(500):
        own, other = (rng.integers(0, 8, rng.integers(1, 12)).tolist() for _ in range(2))
        masks = decontaminate._masks(own)
        found = decontaminate.common_subsequence(masks, len(own), other)
        assert found <= decontaminate.most_in_common(masks, len(own), other) <= len(own)


def test_null_and_repeated_ids(spark):
    bench = [(None, sentence(generator(1), 20)), (2**53 + 1, sentence(generator(2), 20))]
    rows = [(None, bench[0][1]), (None, "clean"), (4, bench[1][1]), (4, "clean too"), (5, None)]
    df = documents(spark, rows)
    found = decontaminate.contaminated(df, items(spark, bench)).collect()
    assert {(row["doc_id"], row["item_id"]) for row in found} == {(None, None), (4, 2**53 + 1)}
    kept = decontaminate.without_contaminated(df, items(spark, bench)).collect()
    assert {(row["doc_id"], row["text"]) for row in kept} == {(None, "clean"), (4, "clean too"), (5, None)}


def test_a_rare_word_that_repeats_stands_for_one_word_of_the_item():
    text = " ".join(f"word{number}" for number in range(20))
    rng = np.random.default_rng(0)
    space = rng.normal(size=(decontaminate.FEATURES, 4)).astype(np.float32)
    table = pd.DataFrame({"item_id": ["1"], "text": [text]})
    items = decontaminate.Items(table, space, np.ones(decontaminate.FEATURES))
    whole = decontaminate._word_hashes(text)
    for passage, expected in ((whole, [0]), (np.repeat(whole[:1], 20), []), (whole[:0], [])):
        where, which = items.places(passage, decontaminate._features(passage))(0)
        bounds = np.array([0]), np.array([len(where)])
        assert items.enough(0, which, *bounds).tolist() == expected
