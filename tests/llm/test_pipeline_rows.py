import random

import corpus_pipeline


def test_rows_are_judged_by_their_own_texts(spark, tmp_path):
    """Null and repeated ids: clean and different rows stay, copies and rejected rows go."""
    rng = random.Random(2)
    text = lambda n=30: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    vile, item, copied = "vile awful nasty ", text(20), text()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    learn = [(i, (vile if i % 3 == 0 else "") + text(), i % 3 == 0) for i in range(1000, 1200)]
    clean = [(None, text()) for _ in range(5)] + [(7, text()) for _ in range(5)] + [(None, None), (7, None)]
    bad = [(i, vile + text()) for i in (None, 7)]
    held = [(i, f"{text()} {item} {text()}") for i in (None, 7)]
    copies = [(None, copied), (7, copied), (3, copied), (None, copied)]
    learned = [(i, t) for i, t, _ in learn]
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema).repartition(3)
    spark.createDataFrame([(i, int(y)) for i, _, y in learn], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def after(stage, rows):
        key = lambda r: (str(r[0]), str(r[1]))
        return sorted(((r.doc_id, r.text) for r in stage(spark, frame(rows), str(tmp_path)).collect()), key=key), lambda rows: sorted(rows, key=key)

    got, ordered = after(corpus_pipeline.toxic_out, learned + clean + bad)
    assert got == ordered([(i, t) for i, t, y in learn if not y] + clean)
    got, ordered = after(corpus_pipeline.near_copies_out, clean + copies)
    assert got == ordered([*clean, (3, copied)])
    got, ordered = after(corpus_pipeline.benchmark_out, clean + held)
    assert got == ordered(clean)


def test_rows_are_numbered_by_their_place_in_files(spark, tmp_path):
    """Every row has its own number, the same at each reading and partitioning; columns of clashing names stay."""
    for k in range(3):
        spark.range(5).selectExpr("id AS doc_id", "'x' AS text", "7 AS _row", "8 AS _metadata").coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    rows, row = corpus_pipeline._numbered(docs, None)
    assert row == "_row_" and rows.columns == [*docs.columns, row]
    first = sorted(r[row] for r in rows.collect())
    assert len(set(first)) == 15 and first == sorted(r[row] for r in rows.repartition(4).collect())
    for stage in (corpus_pipeline.near_copies_out, corpus_pipeline.secrets_masked):
        assert sorted(stage(spark, docs, "").columns) == sorted(docs.columns)


def test_stages_of_an_empty_table_and_a_very_long_text(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int"
    spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = " ".join(f"w{i}" for i in range(200_000))
    for rows in ([], [(3, long, "en", "s", len(long), 1), (4, "", None, None, 0, None)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            got = stage(spark, docs, str(tmp_path))
            assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(rows), name
        packed = corpus_pipeline.packed(spark, docs, str(tmp_path))
        assert {r.doc_id for r in packed.select("doc_id").collect()} == {r[0] for r in rows}
