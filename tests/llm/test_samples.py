"""Training samples are bounded in rows, whatever number of rows repeat an id, and whichever task holds them."""

from pyspark.sql import functions as F

from docquarry.llm import language_id, toxicity
from docquarry.llm.common import fold


def _documents(spark, n=3000, hot=1500):
    """Three languages of unlike size, and one chosen id that holds a third of all rows."""
    rows = [(i, f"text number {i} of letters {chr(97 + i % 26) * 5}", ("aa", "bb", "cc")[min(i % 10, 2)]) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = docs.where(fold("doc_id", 12) == 0).orderBy(F.xxhash64("doc_id")).first()  # Neither of the operators holds it out.
    more = spark.createDataFrame([(first.doc_id, f"another text {i} of that id", first.lang) for i in range(hot)], docs.schema)
    return docs.unionByName(more), first.doc_id


def test_language_sample_is_the_least_hashes_of_each_language(spark):
    docs, hot = _documents(spark)
    params = language_id.LanguageParams(most_per_language=50)
    sample = language_id._sample(docs.repartition(16), params)
    learn = docs.where((fold("doc_id", params.folds) != params.held_out) & F.col("lang").isNotNull()).select("doc_id", "lang").distinct()
    ranked = sorted((r.lang, r.h, r.doc_id) for r in learn.withColumn("h", F.xxhash64("doc_id")).collect())
    wanted = {(lang, i) for lang in ("aa", "bb", "cc") for _, _, i in [r for r in ranked if r[0] == lang][:50]}
    assert {(r.lang, r.at) for r in sample} == wanted and len(sample) == len(wanted) == 150
    assert [tuple(r) for r in language_id._sample(docs.repartition(3), params)] == [tuple(r) for r in sample]


def test_a_repeated_id_is_one_row_of_the_samples(spark):
    docs, hot = _documents(spark)
    sample = language_id._sample(docs, language_id.LanguageParams(most_per_language=3000))
    learnt = [r for r in sample if r.at == hot]
    assert len(learnt) == 1 and len(sample) == len({(r.lang, r.at) for r in sample}) > 1500
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")).distinct()
    rows, _ = toxicity._sample(docs, labels, toxicity.ToxicityParams())
    assert len(rows) == len({r.doc_id for r in rows}) > 1500


def test_samples_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id._sample(docs, language_id.LanguageParams()) == []
    unknown = spark.createDataFrame([(1, "words", None), (None, "words", "aa")], docs.schema)
    assert language_id._sample(unknown, language_id.LanguageParams()) == []
