"""Clean-up of a corpus: files that no manifest entry points to, and manifests of very many small files.

Both are writers, so no other writer may run beside them. Readers that began earlier may still
want the files of the attempts they saw; ``keep`` leaves those of the latest attempts alone.
"""

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.ranking import keep_first
from docquarry.schemas import MANIFEST_SCHEMA, RANGE_MANIFEST_SCHEMA
from docquarry.sinks.daily import RUN, Corpus, current_manifest, read_manifest, superseded
from docquarry.sources.tables import read_or_empty, stored


def _delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    """Delete a folder or file on whichever store it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, recursive)


def droppable(spark: SparkSession, corpus: Corpus, keep: int = 0) -> DataFrame:
    """(day, scope, _run) of stored days that are superseded, but for those whose valid entry is among the last
    ``keep`` attempts: a reader of these days may have begun before the entry came."""
    old = superseded(spark, corpus)
    if not keep:
        return old
    valid = current_manifest(spark, corpus).select("day", "scope", "seq")
    last = valid.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("last"))
    recent = valid.join(F.broadcast(last)).filter(F.col("seq") > F.col("last") - keep)  # One row.
    return old.join(recent, ["day", "scope"], "left_anti")


def drop_superseded(spark: SparkSession, corpus: Corpus, work: str, keep: int = 0) -> DataFrame:
    """Delete the files of superseded days; returns what went, a table stored under ``work``.

    What is to go is written down before anything is deleted. A clean-up that dies is begun anew: what is
    left is still superseded. Folder names pass through the driver one after the other, files do not.
    """
    gone = stored(droppable(spark, corpus, keep), work)
    for part in gone.toLocalIterator():
        place = f"year={part['day'][:4]}/day={part['day']}/scope={part['scope']}/{RUN}={part[RUN]}"
        _delete(spark, posixpath.join(corpus.files, place))
    return gone


def compact_manifest(spark: SparkSession, corpus: Corpus) -> tuple[int, int]:
    """Put the entries of all attempts into one file each for days and ranges; returns files before and after.

    Every attempt adds a small file, a stream one per batch. The new file is written before the old ones
    go: where that is interrupted, entries stand twice, which changes nothing for readers. Of a replayed
    run the last entries are kept, and the latest number, so that attempts go on counting.
    """
    before = after = 0
    tables = (
        (corpus.manifest, MANIFEST_SCHEMA, lambda: read_manifest(spark, corpus)),
        (
            corpus.range_manifest,
            RANGE_MANIFEST_SCHEMA,
            # Of ranges every attempt counts: a later one may cover part of a window only.
            lambda: keep_first(read_or_empty(spark, corpus.range_manifest, RANGE_MANIFEST_SCHEMA), ["window_start", "window_end", "scope", "attempt"], [F.desc("seq")]),
        ),
    )
    for path, schema, entries in tables:
        old = read_or_empty(spark, path, schema).inputFiles()
        if len(old) > 1:
            entries().select(*schema.fieldNames()).coalesce(1).write.mode("append").parquet(path)
            for file in old:
                _delete(spark, file, False)
        before += len(old)
        after += min(len(old), 1)
    return before, after
