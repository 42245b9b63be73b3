"""The stages against plain versions of them, each on its own input."""

import corpus_pipeline
from caseframe.llm.queries import ORACLES, QUERIES
from checks.compare import differences, duck
from tests.llm.helpers import SMALL, documents, generator, near_components, sentence, small, texts
from tests.llm.test_packing import check_packing


def test_queries_equal_their_sql(spark):
    connection = duck(SMALL)
    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, SMALL), connection, sql) == [], name


def test_stages(spark):
    docs = small(spark, "documents")
    schema = docs.schema
    states = [texts(docs)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL))
        assert docs.schema == schema
        states.append(texts(docs))
    start, good, exact, near, clean = states
    assert set(good) <= set(start)
    largest = {}
    for doc_id, text in good:
        largest[text] = max(doc_id, largest.get(text, doc_id))
    assert sorted(exact) == sorted((doc_id, text) for text, doc_id in largest.items())
    roots = {root for _, root in near_components(exact, 80).values()}
    assert sorted(near) == sorted(row for row in exact if row[0] in roots)
    passages = [text for _, text in texts(small(spark, "benchmark").selectExpr("item_id doc_id", "text"))]
    assert sorted(clean) == sorted(
        row for row in near if not any(passage in row[1] for passage in passages)
    )
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packing(pieces, clean, 2048)
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pieces))


RESERVED = ["_row_id", "_row_digest", "_keep_id", "_keep_digest", "_gone", "_found", "__row_id", "kept"]


def test_edge_cases_through_all_stages(spark, tmp_path):
    rng = generator(8)
    long, other = sentence(rng, 30_000), sentence(rng, 40)
    near = other.split()
    near[20] = "changed"
    passage = small(spark, "benchmark").filter("length(text) > 200").first()["text"]
    rows = [
        (None, None), (None, ""), (None, "a text without an id"), (None, "a text without an id"),
        (1, ""), (2, None), (3, long), (3, long), (4, long), (5, other), (6, " ".join(near * 4)),
        (7, " ".join(other.split() * 4)), (8, "one"), (9, f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}"),
    ]
    docs = documents(spark, rows).selectExpr("*", *(f"'mine' AS {name}" for name in RESERVED))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    small(spark, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], small(spark, "labels").schema).write.parquet(f"{tmp_path}/labels.parquet")
    state = spark.read.parquet(f"{tmp_path}/documents.parquet")
    schema = state.schema
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = corpus_pipeline.written(stage(spark, state, str(tmp_path)))
        assert state.schema == schema, name
        assert {row[at] for row in state.select(*RESERVED).collect() for at in range(len(RESERVED))} == {"mine"}
    left = {(row["doc_id"], row["text"] or "") for row in state.collect()}
    assert left == {
        (2, ""), (None, "a text without an id"), (4, long), (5, other), (6, " ".join(near * 4)),
        (8, "one"),
    }
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_packing(pieces, sorted(left, key=str), 2048)


def test_empty_table_through_all_stages(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.createDataFrame([], small(spark, name).schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
