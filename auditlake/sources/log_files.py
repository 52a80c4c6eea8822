"""Log files: gzip of one JSON value `{"Records": [...]}`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import decoded
from ..schemas import LOG_FILE, LOG_SUFFIX
from ..session import java_paths, list_in_few_tasks

# U+0001 cannot occur raw in JSON, so a file is one "line" and each record keeps
# its exact text (other ways of reading re-serialize numbers and escapes).
READ_OPTIONS = {
    "lineSep": "\u0001",
    "columnNameOfCorruptRecord": "_corrupt",
    "ignoreCorruptFiles": "true",
    "ignoreMissingFiles": "true",
    "recursiveFileLookup": "true",
    "pathGlobFilter": f"*{LOG_SUFFIX}",
}


def corrupt() -> Column:
    """`_corrupt`, tied to `Records`: the reader refuses to read the former alone."""
    bad = F.col("_corrupt")
    return F.when(F.col("Records").isNull() | bad.isNotNull(), bad).alias("_corrupt")


def read_log_files(spark: SparkSession, paths) -> DataFrame:
    """`(path, Records, _corrupt)`.

    A good file is one row. A bad one is rows with `_corrupt` set, or no row at
    all, which only shows against the listing.
    """
    list_in_few_tasks(spark)
    reader = spark.read.schema(LOG_FILE).options(**READ_OPTIONS)
    files = DataFrame(reader._jreader.json(java_paths(spark, paths)), spark) if isinstance(paths, list) else reader.json(paths)
    return files.select(decoded("_metadata.file_path").alias("path"), "Records", corrupt())


def explode_records(files: DataFrame, file_rows: bool = False) -> DataFrame:
    """One row per record: `ordinal`, `raw`.

    With `file_rows`, every input row also gives one row of ordinal -1, so that
    the same pass over the data tells which files were read.
    """
    others = [c for c in files.columns if c != "Records"]
    # Not the bare column: a filter on it that reaches the JSON parser makes files
    # with a repeated "Records" key look bad.
    records = F.coalesce("Records", F.array().cast("array<string>"))
    if not file_rows:
        return files.select(*others, F.posexplode(records).alias("ordinal", "raw"))
    marked = files.select(*others, F.posexplode(F.array_prepend(records, F.lit(None).cast("string")))
                          .alias("ordinal", "raw"))
    return marked.withColumn("ordinal", F.col("ordinal") - 1)
