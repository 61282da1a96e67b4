"""Tables a job writes and reads again."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from docquarry.settings import shuffles_dropped


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``; no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the file.

    Cuts the lineage, so a lost executor costs no more than the step at hand, and gives the
    optimizer the real size: a small table is broadcast by it, a large one is not. Its shuffle files go with the write.
    """
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
