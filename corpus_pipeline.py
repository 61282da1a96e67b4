"""The corpus pipeline: documents in, packed sequences out, each stage written and read again.

Stages other than the last return the columns of documents. Null texts and ids pass through where a
stage says nothing else; an empty table passes all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch
from docquarry.llm.decontaminate import contamination
from docquarry.llm.ngram_join import ngram_join
from docquarry.llm.packing import pack
from docquarry.llm.secret_scan import mask_secrets
from docquarry.llm.toxicity import toxicity

MARK = "[secret]"
ROW = "_row"


def _numbered(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and that column's name: ids may be null or repeat.

    The number is the row's place: the place in its file, above it a hash of the file's name, with a
    salt that gives every file another. So it is the same whenever a row is read, also after an
    executor is lost, and no document is written again. Rows that do not come from files are written
    with a number.
    """
    row = ROW
    while row in docs.columns:
        row += "_"
    try:
        place = docs.select("*", docs.metadataColumn("_metadata")["file_path"].alias(f"{row}file"), docs.metadataColumn("_metadata")["row_index"].alias(f"{row}at"))
    except AnalysisException:
        place = None
    if place is not None:
        files, last = place.agg(F.count_distinct(f"{row}file"), F.max(f"{row}at")).first()
        bits = int(last or 0).bit_length()
        for salt in range(16):
            name = F.pmod(F.xxhash64(F.lit(salt), f"{row}file"), F.lit(1 << (62 - bits)))
            if place.agg(F.count_distinct(name)).first()[0] == files:
                return place.withColumn(row, F.shiftleft(name, bits) + F.col(f"{row}at")).drop(f"{row}file", f"{row}at"), row
    return scratch.keep(docs.withColumn(row, F.monotonically_increasing_id())), row


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is predicted toxic go, whatever their id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scratch = Scratch(spark, "pipeline-toxic")
    rows, row = _numbered(docs, scratch)
    leave = scratch.keep(toxicity(rows.select("doc_id", "text", row), labels, row=row).where("predicted = 1").select(row))
    return rows.join(leave, row, "left_anti").drop(row)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, the one with the least id, one without an id only if none has any.

    Rows are compared by their texts alone: those that repeat an id with different texts all stay.
    """
    scratch, join = Scratch(spark, "pipeline-copies"), Scratch(spark, "pipeline-copies-join")
    rows, row = _numbered(docs, scratch)
    linked = ngram_join(rows.select(F.col(row).alias("doc_id"), "text"), size=5, num=8, den=10, scratch=join)
    linked = join.keep(linked.select(F.col("doc_id").alias(row), "component_id"))
    groups = linked.groupBy("component_id").count().where("count > 1").select("component_id")
    members = join.keep(linked.join(groups, "component_id").join(rows.select(row, "doc_id"), row))
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("first")).select(F.col(f"first.{row}").alias(row))
    leave = scratch.keep(members.join(first, row, "left_anti").select(row))
    join.drop()
    return rows.join(leave, row, "left_anti").drop(row)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a benchmark item go, whatever their id."""
    scratch = Scratch(spark, "pipeline-benchmark")
    rows, row = _numbered(docs, scratch)
    found = contamination(rows.select(F.col(row).alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leave = scratch.keep(found.select(F.col("doc_id").alias(row)).distinct())
    return rows.join(leave, row, "left_anti").drop(row)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by ``MARK``; the document stays, its number of characters is counted anew."""
    return mask_secrets(docs, MARK)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 ids, with their ids."""
    return pack(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=1024)


STAGES = [
    ("toxicity", toxic_out),
    ("near_copies", near_copies_out),
    ("benchmark", benchmark_out),
    ("secrets", secrets_masked),
    ("packing", packed),
]

#: Trained models and tokenizers are beyond SQL; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        scratch = Scratch(spark, f"pipeline-{name}")
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if before:
            before.drop()
        before = scratch
    return docs
