"""Taxonomy entries from an XML schema file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_TAG = "xs:enumeration"

# One entry: <xs:enumeration value="..."><xs:annotation><xs:documentation>...
ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("_value", T.StringType()),
        T.StructField("xs:annotation", T.StructType([T.StructField("xs:documentation", T.StringType())])),
    ]
)


def read_taxonomy_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(value, documentation, ord)``; ``ord`` follows the order of the entries in the files."""
    entries = spark.read.format("xml").option("rowTag", ROW_TAG).schema(ENTRY_SCHEMA).load(path)
    position = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())
    return entries.select(
        F.col("_value").alias("value"),
        F.col("`xs:annotation`.`xs:documentation`").alias("documentation"),
        position.alias("ord"),
    )


def write_taxonomy_entries(entries: DataFrame, path: str) -> None:
    """The inverse, from ``(value, documentation)``."""
    annotation = F.struct(F.col("documentation").alias("xs:documentation"))
    rows = entries.select(F.col("value").alias("_value"), annotation.alias("xs:annotation"))
    writer = rows.write.format("xml").option("rootTag", "schema").option("rowTag", ROW_TAG)
    writer.option("validateName", False).save(path)
