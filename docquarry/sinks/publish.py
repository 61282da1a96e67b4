"""Publishing: export the partitions whose content changed since the last time."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.operators.changes import changed_partitions, partition_digests
from docquarry.sources.tables import read_or_empty, stored

# What the log adds to a partition's digest. ``seq`` comes from the folder's name.
_LOG = (T.StructField("gone", T.BooleanType()), T.StructField("run", T.StringType()), T.StructField("seq", T.IntegerType()))


def publish_changes(
    df: DataFrame,
    target: str,
    digest_path: str,
    run_id: str,
    partition_by: Sequence[str] = ("year", "day"),
    touched: DataFrame | None = None,
) -> DataFrame:
    """Write new and changed partitions to ``target``, in the layout of the source.

    Digests of the published state are kept under ``digest_path``, one folder per publish, numbered in
    order; ``run_id`` is a label, its text decides nothing. A partition that is gone leaves a tombstone
    there, so that a state without any partition is a state too. ``touched`` names the partitions that
    were written since (the manifest knows them): only these are read, and the digests of the others
    carried over. Returns the status of every partition; if nothing changed, nothing is written to ``target``.
    """
    spark = df.sparkSession
    keys = list(partition_by)
    candidates = df if touched is None else df.join(touched.select(*keys), keys, "left_semi")
    digests = partition_digests(candidates, keys)
    log = T.StructType([*digests.schema, *_LOG])
    earlier = read_or_empty(spark, digest_path, log)
    last = earlier.agg(F.max("seq")).first()[0] or 0
    previous = earlier.filter((F.col("seq") == last) & ~F.col("gone")).drop(*[f.name for f in _LOG])
    if touched is not None:
        digests = digests.unionByName(previous.join(touched.select(*keys), keys, "left_anti"))
    digests = stored(digests, f"{digest_path}-work/seq={last + 1}/digests")
    status = stored(changed_partitions(digests, previous, keys), f"{digest_path}-work/seq={last + 1}/status")
    to_write = status.filter(F.col("status").isin("new", "changed")).select(*keys)
    changed = candidates.join(to_write, keys, "left_semi").hint("rebalance", *keys)
    writer = changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(target)
    # The digests say what is published, so they come last: a run that dies before them is done again.
    tombstones = status.filter("status = 'gone'").select(*keys).withColumn("gone", F.lit(True))
    state = digests.withColumn("gone", F.lit(False)).unionByName(tombstones, allowMissingColumns=True)
    state.withColumn("run", F.lit(run_id)).write.mode("overwrite").parquet(f"{digest_path}/seq={last + 1}")
    return status


def published_partitions(spark: SparkSession, digest_path: str, partition_by: Sequence[str] = ("year", "day")) -> DataFrame:
    """Publish log: for each partition the number and label of the publish that last changed it, and whether it is gone."""
    digest = [T.StructField(c, t) for c, t in (("n_rows", T.LongType()), ("hash_sum", T.DecimalType(38, 0)), ("hash_xor", T.LongType()))]
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in partition_by], *digest, *_LOG])
    log = read_or_empty(spark, digest_path, schema)
    order = Window.partitionBy(*partition_by).orderBy("seq")
    before = [F.lag(c).over(order).eqNullSafe(F.col(c)) for c in ("n_rows", "hash_sum", "hash_xor", "gone")]
    changed = log.withColumn("same", before[0] & before[1] & before[2] & before[3]).filter("NOT same")
    return changed.groupBy(*partition_by).agg(F.max(F.struct("seq", "run", "gone")).alias("last")).select(*partition_by, "last.seq", "last.run", "last.gone")
