"""A training corpus from the documents table, in five stages.

Each stage works on all rows that the one before it kept. All but the last
return the columns of ``documents``, further ones and those with clashing names
included; the last returns the packed pieces.

A document without a text has none and packs as a separator. Documents without an
id stay where no text equals theirs: nothing is near to them, and no group is named
by them. Rows that repeat are exact copies, of which one stays, with the largest
id; a text of any length is read whole. Without labels nothing is rejected, without
benchmark items nothing is contaminated, and an empty table gives no pieces.
"""

from pyspark.sql import DataFrame, SparkSession

from caseframe.llm.classifier import keep_good
from caseframe.llm.decontaminate import without_contaminated
from caseframe.llm.exact_dedup import distinct_documents
from caseframe.llm.near_dedup import keep_one_of_each
from caseframe.llm.packing import pack
from caseframe.llm.queries import TOKENIZER
from caseframe.llm.work import bound_batches, written

#: Whether two documents are near-duplicates: words of a shingle, percent in common.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of low quality or with toxic text go."""
    bound_batches(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one_of_each(docs, PERCENT, SHINGLE)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    bound_batches(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    return pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminated),
    ("pack", packed),
]

#: A trained classifier, sketches and a packing heuristic are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
