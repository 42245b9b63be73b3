"""Exact duplicates by skew-safe combining, in DataFrame functions only.

Three stages, each of which compares full content:

1. local: Spark's partial aggregate merges equal texts within a task;
2. salted: what is left meets by digest, salt and text. A group that holds a
   third of all rows is spread over ``SALTS`` reducers, and a row's salt depends
   on its id alone;
3. global: one winner per salt and text meets by digest and text, and gets the
   group's largest id, its size and the salts in which it occurs.

Every row then finds its group by digest, length and salt, without its text. A
digest is the SHA-256 of the whole text.

Null text counts as empty. Of equal texts the row with the largest id stays;
null ids lose against any id, and a group of null ids only keeps a null one.
Rows that repeat both id and text are one row told twice: both are marked kept,
and :func:`distinct_documents` leaves one. Extra columns are ignored; an empty
table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.work import free_names, texts, written

SALTS = 64


def _digested(documents: DataFrame, salts: int) -> DataFrame:
    return texts(documents).select(
        "doc_id",
        "text",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.octet_length("text").alias("n_bytes"),
        F.expr(f"cast(pmod(xxhash64(doc_id), {salts}) as int)").alias("salt"),
    )


def exact_duplicates(documents: DataFrame, salts: int = SALTS) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of each row."""
    rows = _digested(documents, salts)
    salted = rows.groupBy("digest", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("n_rows")
    )
    winners = salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("n_rows").alias("group_size"),
        F.collect_list("salt").alias("salts"),
    )
    # A written table has no partitioning of its own, so the join shuffles both
    # sides anew and adaptive execution may split a key.
    labels = written(
        winners.select(
            "digest", F.octet_length("text").alias("n_bytes"), "keep_id", "group_size", "salts"
        )
    ).withColumn("salt", F.explode("salts"))
    return (
        rows.drop("text")
        .join(labels.drop("salts"), ["digest", "n_bytes", "salt"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def distinct_documents(documents: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row of ``documents`` for each text, the one with the largest id, all columns."""
    row_id, row_digest, keep_id, keep_digest = free_names(
        documents, "row_id", "row_digest", "keep_id", "keep_digest"
    )
    kept = (
        exact_duplicates(documents, salts)
        .filter("kept")
        .select(F.col("doc_id").alias(keep_id), F.unhex("text_sha256").alias(keep_digest))
        .distinct()
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = documents.withColumns(
        {
            row_id: F.col("doc_id").cast("long"),
            row_digest: F.unhex(F.sha2(text.cast("binary"), 256)),
        }
    )
    same = F.col(row_id).eqNullSafe(F.col(keep_id)) & (F.col(row_digest) == F.col(keep_digest))
    columns = [F.col(f"`{name}`") for name in documents.columns]
    return marked.join(kept, same).dropDuplicates([row_id, row_digest]).select(*columns)
