"""What the operators share: cutting lineage in the shared folder, and bounded Arrow batches."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

WORD_SPACE = r"[\x20\x09-\x0D]+"


def _shared(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="auditlake-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` computed once and read back from the shared folder."""
    _shared(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{_shared(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of `df` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file on the machine that runs the task."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path
