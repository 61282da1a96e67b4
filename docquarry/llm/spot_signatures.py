"""Document fingerprints from spot signatures.

All of it is DataFrame operations. An anchor is a very common word; its signature is the anchor
with the next content words, those that are no anchors. The set of a text's signatures is its
fingerprint, and the Jaccard similarity of two sets their likeness. Sets are compared only within
reach of their lengths: length classes part the sets so that a set meets its own class and the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import Scratch


@dataclass(frozen=True)
class SpotParams:
    """``anchors``: common words of the languages at hand. ``chain``: content words of a signature."""

    anchors: tuple[str, ...] = ("the", "is", "was", "to", "der", "das", "ist", "le", "la", "est", "el", "las", "es")
    chain: int = 2


def signatures(text: Column, params: SpotParams = SpotParams()) -> Column:
    """The ascending distinct signature hashes of ``text``; of a text without one, a hash of the text alone."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        is_anchor = lambda x: x.isin(*params.anchors)
        content = F.filter(w, lambda x: ~is_anchor(x))
        # The j-th anchor, the i-th word, has i - j content words before it.
        numbered = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))), lambda x: is_anchor(x["w"]))

        def chained(c: Column) -> Column:
            spots = F.transform(numbered, lambda x, j: F.struct(x["w"].alias("w"), (x["i"] - j).alias("at")))
            whole = F.filter(spots, lambda s: s["at"] + params.chain <= F.size(c))
            return F.transform(whole, lambda s: F.xxhash64(s["w"], *[F.get(c, s["at"] + k) for k in range(params.chain)]))

        return F.transform(F.array(content), chained)[0]

    found = F.array_sort(F.array_distinct(F.transform(F.array(words), of)[0]))
    return F.transform(F.array(found), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.xxhash64(text))))[0]


def fingerprint(spots: Column) -> Column:
    """The signatures as text: 16 hex digits each, joined by blanks."""
    return F.array_join(F.transform(spots, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature arrays."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def spot_duplicates(docs: DataFrame, threshold: float = 0.8, params: SpotParams = SpotParams()) -> DataFrame:
    """Pairs (a, b, likeness) of representatives, and of documents with their representative (likeness 1).

    Documents with equal fingerprints form a class, whose least doc_id stands for it. Two classes are
    compared if they share one of the first signatures by hash that a set of this threshold must
    share, and their sizes lie within reach: a class of lengths meets itself and the next. Null ids
    are left out.
    """
    scratch = Scratch(docs.sparkSession, "spots")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sets = scratch.keep(docs.where("doc_id IS NOT NULL").select("doc_id", signatures(text, params).alias("spots")))
    classes = sets.groupBy("spots").agg(F.min("doc_id").alias("a"))
    members = sets.join(classes, "spots").where("doc_id <> a").select("a", F.col("doc_id").alias("b"), F.lit(1.0).alias("likeness"))
    size = F.size("spots")
    lengths = F.floor(F.log(size) / -F.log(F.lit(threshold)))
    first = size - F.ceil(size * threshold - 1e-9) + 1
    classes = classes.select("a", "spots", lengths.alias("lengths"), F.slice("spots", F.lit(1), first.cast("int")).alias("prefix"))
    keys = classes.select("a", F.col("lengths"), F.explode("prefix").alias("spot"))
    other = keys.select(F.col("a").alias("b"), F.col("lengths").alias("b_lengths"), "spot")
    met = keys.join(other, "spot").where((F.col("a") < F.col("b")) & (F.abs(F.col("lengths") - F.col("b_lengths")) <= 1)).select("a", "b").distinct()
    x, y = classes.select("a", F.col("spots").alias("x")), classes.select(F.col("a").alias("b"), F.col("spots").alias("y"))
    pairs = met.join(x, "a").join(y, "b").select("a", "b", likeness(F.col("x"), F.col("y")).alias("likeness")).where(F.col("likeness") >= threshold)
    return pairs.unionByName(members)


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``next_text``, the text of the row after it by doc_id and text; after the last, of the first.

    Rows are dealt into ranges of ids. The first row of the range after it is added to the end of
    each, so no window looks across ranges and no range is larger than its share of the rows.
    """
    scratch = Scratch(docs.sparkSession, "next")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.withColumn("order", F.coalesce("doc_id", F.lit(-(1 << 63))))
    bounds = docs.agg(F.percentile_approx("order", [i / n for i in range(1, n)] or [0.5], 100 * n).alias("x")).first().x or []
    borders = F.array(*[F.lit(x).cast("long") for x in sorted(set(bounds))]).cast("array<bigint>")
    docs = docs.withColumn("range", F.size(F.filter(borders, lambda x: x < F.col("order"))))
    least = scratch.keep(docs.groupBy("range").agg(F.min("order").alias("order")))
    # Rows that repeat a first id share it; the least text is the first.
    firsts = scratch.keep(docs.join(least, ["range", "order"], "left_semi").groupBy("range", "order", "doc_id").agg(F.min(F.struct(F.col("text").isNotNull().alias("some"), "text")).alias("t")))
    in_order = Window.orderBy("range")
    last_range = firsts.agg(F.max("range")).first()[0]
    # One row a range.
    sentinels = firsts.withColumn("range", F.coalesce(F.lag("range").over(in_order), F.lit(last_range if last_range is not None else 0)))
    rows = docs.select("range", "order", "doc_id", "text", F.lit(False).alias("added"))
    rows = rows.unionByName(sentinels.select("range", "order", "doc_id", F.col("t.text").alias("text"), F.lit(True).alias("added")))
    after = Window.partitionBy("range").orderBy("added", "order", F.col("text").isNotNull(), "text")
    return rows.withColumn("next_text", F.lead("text").over(after)).where("NOT added").select("doc_id", "text", "next_text")


def spot_fingerprints(docs: DataFrame, params: SpotParams = SpotParams()) -> DataFrame:
    """Fingerprints of every whole text of ``docs`` (doc_id, text), and how they hold against edits.

    One row per input row: ``doc_id``, ``text``, ``edited_text`` (the last half of the code points,
    rounded down, replaced by the first as many of the next document), ``spots`` and ``edited_spots``
    (signature arrays), ``next_spots`` of the next document.

    Defined cases: a null text is empty; an empty one has the hash of the empty text for its only
    signature. A null id comes first in the order. Rows that repeat an id stand in the order of their
    texts. A single row is its own next. An empty table gives an empty result. Other columns are ignored.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(read).select("doc_id", "text", "next_text", edited.alias("edited_text"))
    spots = [signatures(F.col(c), params).alias(out) for c, out in (("text", "spots"), ("edited_text", "edited_spots"), ("next_text", "next_spots"))]
    return rows.select("doc_id", "text", "edited_text", *spots)
