"""Quads stored by predicate, so that a triple pattern reads its own partition only; optionally in buckets of the subject."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.schemas import QUAD_SCHEMA
from docquarry.settings import narrow_partitions, shuffles_dropped

#: Parts in which the quads of one predicate travel.
PARTS = 32


def write_quads(quads: DataFrame, path: str) -> None:
    """Partition by predicate, each sorted by object: date ranges then skip row groups.

    Rebalancing splits a predicate that holds much of the data over several tasks and files, each small
    enough to be sorted in memory. What one task of the source sends for one key stays together, hence
    the parts of a predicate, by subject.
    """
    narrow_partitions(quads.sparkSession)
    part = F.pmod(F.xxhash64("s"), F.lit(PARTS)).alias("_part")
    rebalanced = quads.select(*QUAD_SCHEMA.fieldNames(), part).hint("rebalance", "p", "_part").drop("_part")
    with shuffles_dropped(quads.sparkSession):
        rebalanced.sortWithinPartitions("p", "o").write.mode("overwrite").partitionBy("p").parquet(path)


def read_quads(spark: SparkSession, path: str) -> DataFrame:
    """Stored quads; what is shuffled of them is dealt in partitions that sort in memory."""
    narrow_partitions(spark)
    return spark.read.schema(QUAD_SCHEMA).parquet(path)


#: Quads of an average bucket of subjects: what one task can gather in memory.
BUCKET_ROWS = 4_000_000
_MOST_COUNTED = 1 << 14


def _bucket_rows(quads: DataFrame, buckets: int) -> dict[int, int]:
    """Rows by bucket; the shuffle files of the count go with it."""
    with shuffles_dropped(quads.sparkSession):
        sizes = quads.groupBy(F.pmod(F.hash("s"), F.lit(buckets)).alias("b")).agg(F.count("*").alias("n"))
        return {r.b: r.n for r in sizes.collect()}


def _heaviest(rows: dict[int, int], buckets: int) -> float:
    """From rows by a multiple of so many buckets."""
    together: dict[int, int] = {}
    for bucket, n in rows.items():
        together[bucket % buckets] = together.get(bucket % buckets, 0) + n
    return max(together.values()) * buckets / sum(together.values()) if together else 0.0


def heaviest_bucket(quads: DataFrame, buckets: int) -> float:
    """Rows of the fullest of so many buckets over those of an average one; 0 without quads."""
    return _heaviest(_bucket_rows(quads, buckets), buckets)


def write_quads_by_subject(quads: DataFrame, table: str, path: str, buckets: int, most: float = 4.0, rows: int = BUCKET_ROWS) -> int:
    """``write_quads`` with each predicate in buckets of the subject, as the catalog's ``table`` at ``path``; the number of buckets.

    All that is grouped or joined by subject is then where it is needed, for every predicate alike. One task
    reads one bucket, and adaptive execution can't split it: ``buckets`` are doubled while an average one has over
    ``rows`` quads, up to some thousands. A subject that holds much of the data makes a bucket that does: they are not
    doubled where the fullest would then have over ``most`` times the average, and if it has so already, nothing is written
    and it is an error; ``write_quads`` has no such limit.
    """
    fine = buckets
    while fine * 2 <= _MOST_COUNTED:
        fine *= 2
    counted = _bucket_rows(quads, fine)
    if (heaviest := _heaviest(counted, buckets)) > most:
        raise ValueError(f"the fullest bucket of subjects has {heaviest:.1f} times the average: store these quads by predicate only")
    while sum(counted.values()) > rows * buckets and buckets * 2 <= fine and _heaviest(counted, buckets * 2) <= most:
        buckets *= 2
    narrow_partitions(quads.sparkSession)
    placed = quads.select(*QUAD_SCHEMA.fieldNames()).hint("rebalance", buckets, "s")
    with shuffles_dropped(quads.sparkSession):
        placed.write.mode("overwrite").option("path", path).partitionBy("p").bucketBy(buckets, "s").sortBy("o").saveAsTable(table)
    return buckets


def attach_quads_by_subject(spark: SparkSession, table: str, path: str, buckets: int) -> DataFrame:
    """Name stored subject buckets in a catalog that does not know them, as that of another application."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUAD_SCHEMA)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (p) CLUSTERED BY (s) SORTED BY (o) INTO {buckets} BUCKETS LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)
