"""Changed-partition detection: what has to be published again."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row digest that tells null from absent and keeps list borders apart."""
    parts: list[Column] = []
    for name in columns:
        col = F.col(f"`{name}`")
        parts += [col.isNull(), col]
        if df.schema[name].dataType.typeName() == "array":
            parts.append(F.size(col))
    return F.xxhash64(*parts)


def partition_digests(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Per partition: row count and two order-free sums over row digests."""
    columns = [c for c in sorted(df.columns) if c not in partition_by]
    hashed = df.select(*partition_by, _row_hash(df, columns).alias("_h"))
    return hashed.groupBy(*partition_by).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("_h").cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor("_h").alias("hash_xor"),
    )


def changed_partitions(current: DataFrame, previous: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Partition -> ``new``, ``changed``, ``unchanged`` or ``gone``."""
    digest = ["n_rows", "hash_sum", "hash_xor"]
    cur = current.select(*partition_by, F.struct(*digest).alias("cur"))
    prev = previous.select(*partition_by, F.struct(*digest).alias("prev"))
    status = (
        F.when(F.col("prev").isNull(), "new")
        .when(F.col("cur").isNull(), "gone")
        .when(F.col("cur") == F.col("prev"), "unchanged")
        .otherwise("changed")
    )
    joined = cur.join(prev, list(partition_by), "full_outer")
    return joined.select(*partition_by, status.alias("status"))
