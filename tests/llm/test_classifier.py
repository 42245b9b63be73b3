from caseframe.llm import classifier
from caseframe.llm.words import byte_arrays
from tests.conftest import TESTDATA
from tests.llm.helpers import documents, generator, sentence

LABEL = "doc_id long, quality int, toxic int, kept boolean"


def labels(spark, rows):
    return spark.createDataFrame([(*row, True) for row in rows], LABEL)


def test_held_out_accuracy(spark):
    folder = f"{TESTDATA}/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = spark.read.parquet(f"{folder}/labels.parquet")
    learn, held = known.filter("doc_id % 3 <> 0"), known.filter("doc_id % 3 = 0")
    scored = classifier.score_documents(docs, learn).join(held, "doc_id").collect()
    good = [row["kept"] for row in scored if row["quality"] == 1 and row["toxic"] == 0]
    bad = [not row["kept"] for row in scored if row["quality"] == 0 or row["toxic"] == 1]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) > 0.97


def made(spark):
    rng = generator(2)
    rows, known = [], []
    for at in range(600):
        kind = at % 10
        text = sentence(rng, 30)
        if kind == 0:
            text = " | ".join(text.split())
        if kind == 1:
            text += " vileword"
        rows.append((at, text))
        if at < 500:
            known.append((at, int(kind != 0), int(kind == 1)))
    return rows, known


def test_rejects_what_it_learnt_and_keeps_the_rest(spark):
    rows, known = made(spark)
    df = documents(spark, rows, extra=True)
    kept = classifier.keep_good(df, labels(spark, known))
    assert kept.schema == df.schema
    assert {row["doc_id"] for row in kept.collect()} == {at for at, _ in rows if at % 10 > 1}


def test_edges(spark):
    rows, known = made(spark)
    odd = [(None, "a b"), (700, None), (701, ""), (702, "w1 " * 100_000), (0, rows[0][1])]
    known += [(0, None, 1), (None, 1, 0), (9999, 0, 1), (5, 0, 0)]
    scored = classifier.score_documents(documents(spark, rows + odd), labels(spark, known)).collect()
    assert len(scored) == len(rows + odd)
    assert all(0 <= row["bad_score"] <= 1 and 0 <= row["toxic_score"] <= 1 for row in scored)
    nothing = classifier.score_documents(documents(spark, rows + odd), labels(spark, []))
    assert nothing.filter("not kept").count() == 0
    assert classifier.score_documents(documents(spark, []), labels(spark, known)).count() == 0


def test_views_exchange_sure_labels():
    import numpy as np

    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.5).astype(float)
    docs = [np.sort(np.array([1 + int(yes), 10 + i], np.uint64)) for i, yes in enumerate(y)]
    meta = np.column_stack([y, 1 - y, rng.random(400)])
    model = classifier.co_train(docs[:300], meta[:300], y[:300], docs[300:], meta[300:])
    text = classifier._presence(docs[300:], model.features) @ model.text.weights + model.text.bias
    both = model.combined(model.text.slope * text + model.text.shift, model.meta.score(meta[300:]))
    assert ((both > 0.5) == (y[300:] > 0.5)).mean() > 0.98


def test_fit_over_a_table_equals_co_training_at_hand(spark):
    """The sums of the tasks give the weights that all rows at hand give."""
    import numpy as np
    import pyarrow as pa

    rows, known = made(spark)
    df = documents(spark, rows).repartition(7)
    models = classifier.fit(df, labels(spark, known))
    plain = sorted(tuple(row) for row in df.select("doc_id", "text", "source", "lang").collect())
    text = pa.array([row[1] for row in plain])
    data, offsets = byte_arrays(text)
    hashes, first = classifier.text_features(data, offsets)
    docs = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
    part = pa.RecordBatch.from_pydict({"source": [r[2] for r in plain], "lang": [r[3] for r in plain]})
    meta = classifier.metadata_features(part, np.diff(offsets))
    by_id = {doc_id: (quality, toxic) for doc_id, quality, toxic in known}
    has = np.array([row[0] in by_id for row in plain])
    pick = [doc for doc, own in zip(docs, has, strict=True) if own]
    rest = [doc for doc, own in zip(docs, has, strict=True) if not own]
    told = np.array([by_id[row[0]] for row in plain if row[0] in by_id])
    for model, y in zip(models, ((told[:, 0] == 0), (told[:, 1] == 1)), strict=True):
        expected = classifier.co_train(pick, meta[has], y.astype(float), rest, meta[~has])
        assert (model.features == expected.features).all() and len(model.features)
        for own, other in ((model.text, expected.text), (model.meta, expected.meta)):
            assert np.allclose(own.weights, other.weights, atol=1e-6)
            assert np.allclose([own.bias, own.slope, own.shift], [other.bias, other.slope, other.shift], atol=1e-6)
        assert np.allclose(model.mix, expected.mix)


def test_both_views_always_count_and_unlabelled_documents_change_the_fit(spark):
    import numpy as np

    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    known = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    models = classifier.fit(docs, known)
    alone = classifier.fit(docs.join(known.select("doc_id"), "doc_id", "left_semi"), known)
    for model, other in zip(models, alone, strict=True):
        assert (model.mix[:2] == 1).all()
        assert (model.features == other.features).all()
        assert np.abs(model.meta.weights - other.meta.weights).max() > 0.01


def test_more_labels_than_are_learnt_from(spark):
    rows, known = made(spark)
    kept = classifier.keep_good(documents(spark, rows), labels(spark, known), labelled=300)
    assert {row["doc_id"] for row in kept.collect()} == {at for at, _ in rows if at % 10 > 1}
