"""File listings, inventory of written days, payload files, and SQL over written documents."""

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquarry.functions.dates import date_in_name, day_of_file
from docquarry.operators.ranking import keep_first
from docquarry.settings import shared_dir
from docquarry.sources.tables import stored


def _listing(spark: SparkSession, root: str, glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", glob).load(root).select("path", F.col("_metadata.file_path").alias("file"))


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Paths below ``root``, zero-row files included. Only names are listed, no content is read."""
    return _listing(spark, root, glob).select("path")


def _valid_without_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "valid": [_has_footer(c) for c in batch["content"]]})


def _has_footer(content: bytes) -> bool:
    try:
        return pyarrow.parquet.ParquetFile(pyarrow.BufferReader(content)).metadata.num_rows == 0
    except (pyarrow.ArrowInvalid, EOFError):  # a broken footer is reported, not fatal
        return False


#: A file without rows is little more than its footer.
_MOST_EMPTY_BYTES = 16 << 20


def row_counts(spark: SparkSession, root: str, glob: str = "*.parquet", only: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(path, num_rows)`` of the Parquet files below ``root``; null for one that cannot be read as such.

    Spark's reader counts by file, from the footers alone, so any store will do that Spark reads. It
    passes over broken files, and one without rows gives none: the files left over are told apart by
    their content, of which only small ones can be sound. Their names pass through the driver, as those of
    any files that are read do. ``only`` is a condition on the path. A store that cannot be reached, or a lost
    connection, is an error: it must not make files look unreadable, and so due to be fetched again.
    """
    listed = _listing(spark, root, glob)
    reader = spark.read.schema(T.StructType([])).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
    rows = reader.option("pathGlobFilter", glob).parquet(root).select(F.col("_metadata.file_path").alias("file"))
    if only is not None:
        listed, rows = listed.filter(only(F.col("path"))), rows.filter(only(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))))
    counted = listed.join(rows.groupBy("file").agg(F.count("*").alias("num_rows")), "file", "left").select("path", "num_rows")
    counted = stored(counted, shared_dir(spark, "row-counts"))
    others = [row.path for row in counted.filter("num_rows IS NULL").collect()]
    if not others:
        return counted
    small = spark.read.format("binaryFile").load(others).filter(F.col("length") <= _MOST_EMPTY_BYTES).select("path", "content")
    sound = small.mapInPandas(_valid_without_rows, "path string, valid boolean").filter("valid").select("path", F.lit(0).cast("long").alias("_none"))
    return counted.join(sound, "path", "left").select("path", F.coalesce("num_rows", "_none").alias("num_rows"))


def daily_inventory(files: DataFrame, prefix: str, suffix: str = "") -> DataFrame:
    """``(date, path, num_rows)`` from ``(path, num_rows)``: one file per day.

    Only ``{prefix}{date}{suffix}.parquet`` counts. Of several files for a day the one with most
    rows wins, a known count beats an unknown one, and equals are settled by path.
    """
    dated = files.select(day_of_file(F.col("path"), prefix, suffix).alias("date"), "path", "num_rows")
    return keep_first(dated.filter("date IS NOT NULL"), ["date"], [F.desc_nulls_last("num_rows"), F.asc("path")])


def scan_inventory(spark: SparkSession, root: str, prefix: str, suffix: str = "") -> DataFrame:
    """Inventory of the daily files below ``root``; footers of matching files only are read."""
    only = lambda path: day_of_file(path, prefix, suffix).isNotNull()
    return daily_inventory(row_counts(spark, root, only=only), prefix, suffix)


def scan_partitions(spark: SparkSession, root: str, scope: str = "all", current: DataFrame | None = None) -> DataFrame:
    """Inventory of the day partitions ``day=.../scope=.../_run=...`` that jobs wrote.

    ``current`` (attempt) restricts it to the attempts that count; without it all files are counted.

    A partition may have many files: their counts add up, and one unreadable file makes the count
    unknown.
    """
    day = F.regexp_extract("path", r"/day=(\d{4}-\d{2}-\d{2})/", 1)
    in_scope = lambda path: path.contains(f"/scope={scope}/") & path.rlike(r"/day=\d{4}-\d{2}-\d{2}/")
    counted = row_counts(spark, root, only=in_scope)
    if current is not None:
        attempt = F.url_decode(F.regexp_extract("path", r"/_run=([^/]+)/", 1))
        valid = current.select("day", "attempt")
        counted = counted.withColumns({"day": day, "attempt": attempt}).join(valid, ["day", "attempt"], "left_semi").select("path", "num_rows")
    total = F.when(F.count("num_rows") == F.count("*"), F.sum("num_rows"))
    return (
        counted.groupBy(day.alias("date"))
        .agg(F.min("path").alias("path"), total.alias("num_rows"))
        .select("date", "path", "num_rows")
    )


def dates_in_names(names: DataFrame, prefix: str = "dataset_") -> DataFrame:
    """Dates of file names, ``prefix`` anywhere in the name; a range file gives its first date."""
    return names.select(date_in_name(F.col("name"), prefix).alias("date")).filter("date IS NOT NULL")


def read_payload_files(spark: SparkSession, root: str) -> DataFrame:
    """Payload files ``{key}.{lang}.{format}`` as ``(url, format, lang, content)``.

    The part of the name before the language is the payload's url, percent-encoded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    base = F.element_at(F.split("path", "/"), -1)
    # The listing percent-encodes the path once more, hence the two decodings.
    part = [F.regexp_extract(F.url_decode(base), r"\A(.+)\.([^.]+)\.([^.]+)\z", i) for i in (1, 2, 3)]
    named = files.select(
        F.url_decode(part[0]).alias("url"), part[2].alias("format"), part[1].alias("lang"), "content"
    )
    return named.filter("format <> ''")


def read_documents(spark: SparkSession, root: str, merge_schema: bool = True) -> DataFrame:
    """All parquet files below ``root``, at any depth.

    Every footer is read for its columns, as files may be written with different keywords. Where all
    files are known to share theirs, ``merge_schema=False`` spares that. It knows no manifest: for a corpus
    use ``sql_over_days`` or ``read_days``.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge_schema)
    return reader.parquet(root)


def sql_over_files(spark: SparkSession, root: str, query: str, view: str = "documents") -> DataFrame:
    """Run ``query`` over the parquet files below ``root``, seen as the view ``view``."""
    read_documents(spark, root).createOrReplaceTempView(view)
    return spark.sql(query)
