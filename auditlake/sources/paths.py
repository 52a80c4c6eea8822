from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_or_empty(spark: SparkSession, schema: StructType, load) -> DataFrame:
    """Run a load; a folder that is not there yet is an empty table.

    Anything else that is wrong with it must fail: an id table that is silently
    taken as empty would let every old event through again.
    """
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
