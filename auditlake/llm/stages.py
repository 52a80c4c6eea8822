"""Pipeline stages over documents.

Each takes (spark, docs, sf_dir), works on all of `docs` and returns its columns, but for the last.
Where a stage changes a text, `n_chars` becomes its new length. Null texts pass all stages.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_templates, packing, secrets, simhash, toxicity
from .common import new_name, read_table, shared_folder

Stage = tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType),
                                                 F.col("n_chars")))


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the rejected severity stay; the model learns from these documents' labels."""
    named = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    model = toxicity.fit(named, toxicity.grades_of(read_table(spark, sf_dir, "labels")))
    scored = new_name(docs, "toxicity")
    return (docs.withColumn(scored, toxicity.severity_column(spark, F.col("text"), model))
            .filter(F.col(f"{scored}.severity") < toxicity.REJECT).select(*docs.columns))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, without the lines whose template another document had first."""
    return _measured(line_templates.drop_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with the name of its kind in place of each secret."""
    return _measured(docs.withColumn("text", secrets.redact_column(F.col("text"))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences."""
    return packing.packed_documents(docs)


STAGES: list[Stage] = [
    ("toxicity", clean_of_toxicity),
    ("line_dedup", without_recurring_lines),
    ("near_duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str, stages: list[Stage]) -> DataFrame:
    """Each stage's rows are written as Parquet to the shared folder and read by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(stages):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(stages):
            path = shared_folder(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
