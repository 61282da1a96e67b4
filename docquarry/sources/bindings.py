"""Landed metadata result files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.schemas import BINDING_VARIABLES, RESULT_FILE_SCHEMA


def binding_rows(results: DataFrame, *carry: str) -> DataFrame:
    """One row per binding, a string column per variable; an absent variable is null."""
    rows = results.select(*carry, F.explode("results.bindings").alias("b"))
    return rows.select(*carry, *[F.col("b")[v]["value"].alias(v) for v in BINDING_VARIABLES])


def read_bindings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Bindings of result files: one JSON document per file, or with ``multi_line=False`` one per
    line, which Spark can also split."""
    reader = spark.read.schema(RESULT_FILE_SCHEMA).option("multiLine", multi_line)
    return binding_rows(reader.json(path))


def stream_bindings(spark: SparkSession, path: str, multi_line: bool = True, files_per_batch: int = 1000) -> DataFrame:
    """The same as a stream of newly landed files."""
    reader = spark.readStream.schema(RESULT_FILE_SCHEMA).option("multiLine", multi_line)
    return binding_rows(reader.option("maxFilesPerTrigger", files_per_batch).json(path))
