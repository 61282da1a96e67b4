"""Sources, sinks and whole jobs on small stored inputs."""

import datetime
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docquarry.operators import graph
from docquarry.operators.gaps import run_summary
from docquarry.plans import mine as plans
from docquarry.plans.backfill import BackfillParams, run_backfill
from docquarry.plans.mine import MineParams, mine, run_lookback
from docquarry.schemas import DOCUMENT_SCHEMA, PAYLOAD_SCHEMA, QUAD_SCHEMA
from docquarry.sinks.daily import Corpus, current_manifest, planned_days, range_entries, read_days, read_manifest, read_ranges, scope_of, sql_over_days, superseded, write_days, write_ranges
from docquarry.sinks.publish import publish_changes, published_partitions
from docquarry.sources.bindings import read_bindings
from docquarry.sources.files import read_documents, row_counts, scan_inventory, scan_partitions
from docquarry.sources.taxonomy_xml import read_taxonomy_entries
from docquarry.streaming.ingest import merge_days

V = graph.VOCABULARY
TODAY = datetime.date(2024, 1, 6)


def test_daily_files_are_found_by_name_with_footer_counts(spark, tmp_path):
    def put(name, n):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"x": list(range(n))}), path)

    put("2024/dataset_2024-01-01_eng.parquet", 3)
    put("dataset_2024-01-01_eng.parquet", 1)
    put("2024/dataset_2024-01-02_eng.parquet", 0)
    put("2024/dataset_2024-01-03_fra.parquet", 2)
    put("2024/dataset_2024-01-03_to_2024-01-05_eng.parquet", 2)
    (tmp_path / "2024/dataset_2024-01-04_eng.parquet").write_bytes(b"not parquet")
    got = {r.date: r.num_rows for r in scan_inventory(spark, str(tmp_path), "dataset_", "_eng").collect()}
    assert got == {"2024-01-01": 3, "2024-01-02": 0, "2024-01-04": None}


def test_result_files_with_absent_variables(spark, tmp_path):
    value = lambda v: {"type": "literal", "value": v}
    doc = {"head": {"vars": []}, "results": {"bindings": [{"title": value("a|||b"), "date": value("2024-01-01")}, {"title": value("c")}]}}
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"results": {"bindings": []}}, indent=1))
    rows = read_bindings(spark, str(tmp_path)).orderBy("title").select("title", "date", "subjects").collect()
    assert [tuple(r) for r in rows] == [("a|||b", "2024-01-01", None), ("c", None, None)]


@pytest.mark.parametrize("n", [1, 3])
def test_taxonomy_files_of_one_and_more_entries(spark, tmp_path, n):
    entries = "".join(
        f'<xs:enumeration value="x:{i}"><xs:annotation><xs:documentation>l{i} / m</xs:documentation></xs:annotation></xs:enumeration>' for i in range(n)
    )
    text = f'<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:simpleType><xs:restriction>{entries}</xs:restriction></xs:simpleType></xs:schema>'
    (tmp_path / "t.xml").write_text(text)
    rows = read_taxonomy_entries(spark, str(tmp_path / "t.xml")).orderBy("ord").collect()
    assert [(r.value, r.documentation) for r in rows] == [(f"x:{i}", f"l{i} / m") for i in range(n)]


def _docs(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, date string, lang string, text string, day string")


def test_a_day_that_became_empty_or_failed(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    first = _docs(spark, ("u1", "d", "eng", "x", "2024-01-01"), ("u2", "d", "eng", "x", "2024-01-02"), ("u3", "d", "eng", "x", "2024-01-03"))
    days = first.select("day")
    write_days(first, planned_days(days), corpus, "1")
    errors = spark.createDataFrame([("2024-01-03", "down")], "day string, error string")
    discovered = spark.createDataFrame([("2024-01-02", 4)], "day string, discovered long")
    second = _docs(spark, ("v1", "d", "eng", "y", "2024-01-04"))
    entries = write_days(second, planned_days(days.union(second.select("day")), discovered, errors), corpus, "2")
    got = {r.day: (r.status, r.n_rows, r.error) for r in entries.collect()}
    assert got == {
        "2024-01-01": ("empty", 0, None),
        "2024-01-02": ("rows", 0, None),  # found, but none left after the filter
        "2024-01-03": ("errors", None, "down"),
        "2024-01-04": ("rows", 1, None),
    }
    assert {r.url for r in read_days(spark, corpus, first.schema).collect()} == {"u3", "v1"}
    assert read_manifest(spark, corpus).count() == 7 and current_manifest(spark, corpus).count() == 4


def test_a_run_without_manifest_entry_is_not_read(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    docs = _docs(spark, ("u1", "d", "eng", "x", "2024-01-01"))
    write_days(docs, planned_days(docs.select("day")), corpus, "1")
    died = docs.withColumns({"url": F.lit("u2"), "scope": F.lit("all"), "_run": F.lit("2"), "year": F.lit("2024")})
    died.write.mode("append").partitionBy("year", "day", "scope", "_run").parquet(corpus.files)
    assert [r.url for r in read_days(spark, corpus, docs.schema).collect()] == ["u1"]
    assert [r["_run"] for r in superseded(spark, corpus).collect()] == ["2"]


def test_the_last_attempt_counts_whatever_its_run_is_called(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    for url, run in (("u1", "stream-0"), ("u2", "2024-01-28T06"), ("u3", "2024-01-28T06")):
        docs = _docs(spark, (url, "d", "eng", "x", "2024-01-01"))
        assert write_days(docs, planned_days(docs.select("day")), corpus, run).count() == 1
        assert [r.url for r in read_days(spark, corpus).collect()] == [url]
    assert read_manifest(spark, corpus).count() == 2
    gone = docs.limit(0)
    write_days(gone, planned_days(docs.select("day")), corpus, "2024-01-28T06")
    assert sql_over_days(spark, corpus, "SELECT count(*) AS n FROM documents").first().n == 0


def test_ranges_that_became_empty_or_moved(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    columns = "url string, date string, window_start string, window_end string"
    frame = lambda *rows: spark.createDataFrame(list(rows), columns)
    spans = lambda *rows: spark.createDataFrame(list(rows), "start string, end string")
    write_ranges(frame(("u1", "2024-01-01", "2024-01-01", "2024-01-07"), ("u2", "2024-01-05", "2024-01-01", "2024-01-07"), ("u3", "2024-01-09", "2024-01-08", "2024-01-14")), corpus, "1")
    assert {r.url for r in read_ranges(spark, corpus).collect()} == {"u1", "u2", "u3"}
    # Shifted by a day: the day before the new windows keeps its documents, and nothing is doubled.
    write_ranges(frame(("u2", "2024-01-05", "2024-01-02", "2024-01-08")), corpus, "2", spans(("2024-01-02", "2024-01-08"), ("2024-01-09", "2024-01-15")))
    assert sorted(r.url for r in read_ranges(spark, corpus).collect()) == ["u1", "u2"]


def test_a_stream_row_keeps_the_text_of_a_mined_day(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    mined = _docs(spark, ("u1", "d", "eng", "one", "2024-01-01"), ("u2", "d", "eng", "two", "2024-01-01")).withColumn("match_x", F.lit(True))
    write_days(mined, planned_days(mined.select("day").distinct()), corpus, "1")
    batch = _docs(spark, ("u2", "d", "eng", "", "2024-01-01"), ("u3", "d", "eng", "", "2024-01-01")).drop("text").withColumn("title", F.lit("t"))
    merge_days(batch, corpus, "stream-1")
    got = {(r.url, r.text, r.match_x, r.title) for r in read_days(spark, corpus).collect()}
    assert got == {("u1", "one", True, None), ("u2", "two", True, "t"), ("u3", None, None, "t")}


def test_an_interrupted_publish_is_done_again(spark, tmp_path, monkeypatch):
    docs = _docs(spark, ("u1", "d", "eng", "x", "2024-01-01")).withColumn("year", F.lit("2024"))
    target, digests = str(tmp_path / "tree"), str(tmp_path / "digests")
    publish_changes(docs, target, digests, "1")
    changed = docs.withColumn("text", F.lit("new"))
    # The run dies while it writes the data: its target is a file.
    (tmp_path / "blocked").write_text("")
    with pytest.raises(Exception):
        publish_changes(changed, str(tmp_path / "blocked"), digests, "2")
    assert [r.status for r in publish_changes(changed, target, digests, "3").collect()] == ["changed"]
    assert [r.text for r in spark.read.parquet(target).collect()] == ["new"]


def test_an_unknown_store_is_an_error_and_a_broken_file_is_not(spark, tmp_path):
    odd = tmp_path / "a b%20c" / "run=2024-01-28T06%3A00+1"
    odd.mkdir(parents=True)
    (odd / "bad.parquet").write_bytes(b"no parquet at all")
    (odd / "huge.parquet").write_bytes(bytes(17 << 20))
    pq.write_table(pa.table({"x": [1, 2, 3]}), odd / "some.parquet")
    pq.write_table(pa.table({"y": pa.array([], pa.string())}), odd / "none.parquet")
    got = {r.path.split("/")[-1]: r.num_rows for r in row_counts(spark, str(tmp_path)).collect()}
    assert got == {"bad.parquet": None, "huge.parquet": None, "some.parquet": 3, "none.parquet": 0}
    only = row_counts(spark, str(tmp_path), only=lambda path: path.contains("%3A00+1/") & path.endswith("me.parquet"))
    assert [r.num_rows for r in only.collect()] == [3]
    with pytest.raises(Exception):
        row_counts(spark, "nowhere9://b/").collect()


def test_a_day_with_most_rows_is_split_over_files(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    docs = spark.range(60_000).select(
        F.concat(F.lit("u"), "id").alias("url"), F.lit("d").alias("date"), F.lit("eng").alias("lang"), F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 9 + 1).cast("string"), 2, "0"))).otherwise("2024-02-01").alias("day"),
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
        write_days(docs, planned_days(docs.select("day").distinct()), corpus, "1")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    hot = [f for _, _, names in os.walk(f"{corpus.files}/year=2024/day=2024-02-01/scope=all") for f in names if f.endswith(".parquet")]
    assert len(hot) > 1
    counts = {r.date: r.num_rows for r in scan_partitions(spark, corpus.files).collect()}
    assert counts["2024-02-01"] == 40_000 and sum(counts.values()) == 60_000


def test_publishing_unchanged_days_writes_nothing(spark, tmp_path):
    docs = _docs(spark, ("u1", "d", "eng", "x", "2024-01-01"), ("u2", "d", None, "x", "2024-01-02")).withColumn("year", F.lit("2024"))
    target = str(tmp_path / "tree")
    publish = lambda df, run: {r.day: r.status for r in publish_changes(df, target, str(tmp_path / "digests"), run).collect()}
    assert set(publish(docs, "1").values()) == {"new"}
    before = sorted((r, f) for r, _, fs in os.walk(target) for f in fs if f.endswith(".parquet"))
    assert set(publish(docs, "2").values()) == {"unchanged"}
    assert before == sorted((r, f) for r, _, fs in os.walk(target) for f in fs if f.endswith(".parquet"))
    changed = docs.withColumn("lang", F.when(F.col("lang").isNull(), "x").otherwise(F.col("lang")))
    # The text of a run's label decides nothing: these sort against the order of time.
    assert publish(changed.filter("day > '2024-01-01'"), "2-stream") == {"2024-01-01": "gone", "2024-01-02": "changed"}
    assert publish(docs.limit(0), "1") == {"2024-01-02": "gone"}
    assert publish(docs.limit(0), "0") == {}
    assert publish(docs.filter("day = '2024-01-01'"), "stream-9") == {"2024-01-01": "new"}
    assert publish(docs.filter("day = '2024-01-01'"), "2024-01") == {"2024-01-01": "unchanged"}
    log = {r.day: (r.seq, r.run, r.gone) for r in published_partitions(spark, str(tmp_path / "digests")).collect()}
    assert log == {"2024-01-01": (5, "stream-9", False), "2024-01-02": (4, "1", True)}


def test_publishing_touched_days_leaves_the_others_as_they_were(spark, tmp_path):
    docs = _docs(spark, *[(f"u{i}", "d", "eng", "x", f"2024-01-0{i}") for i in (1, 2, 3)]).withColumn("year", F.lit("2024"))
    target, digests = str(tmp_path / "tree"), str(tmp_path / "digests")
    publish_changes(docs, target, digests, "1")
    newer = docs.withColumn("text", F.lit("y"))
    touched = docs.filter("day <> '2024-01-01'").select("year", "day")
    gone = newer.filter("day <> '2024-01-03'")
    got = {r.day: r.status for r in publish_changes(gone, target, digests, "2", touched=touched).collect()}
    assert got == {"2024-01-01": "unchanged", "2024-01-02": "changed", "2024-01-03": "gone"}
    assert {(r.url, r.text) for r in spark.read.parquet(target).collect()} == {("u1", "x"), ("u2", "y"), ("u3", "x")}
    assert {r.day: r.status for r in publish_changes(gone, target, digests, "3").collect()} == {"2024-01-01": "changed", "2024-01-02": "unchanged"}


def _corpus_inputs(spark, tmp_path, n=12):
    """Works on days 1..6 of January (none on day 4), with one HTML payload each."""
    quads, payloads = [], []
    for i in range(n):
        work, day = f"w{i}", f"2024-01-0{[1, 2, 3, 5, 6, 6][i % 6]}"
        quads += [("g", work, V.type, "t"), ("g", work, V.work_id, "i"), ("g", work, V.date, day), ("g", work, V.subject, "s0"),
                  ("g", work, V.celex_1, f"C{i % 4}"), ("e", f"x{i}", V.expression_work, work), ("e", f"x{i}", V.title, f"T{i}"),
                  ("e", f"x{i}", V.language, "l"), ("m", f"m{i}", V.manifestation_expression, f"x{i}"), ("m", f"m{i}", V.manifestation_type, "html")]
        if i != 7:  # one payload has not landed
            payloads.append((work, "html", "eng", f"<p>text {i} {'fish' if i % 2 else 'meat'}</p>".encode()))
    quads = [(*q, None) for q in [*quads, ("l", "l", V.identifier, "ENG")]] + [("gs", "s0", V.label, "Fishing", "en")]
    taxonomy = spark.createDataFrame([("fishing", "77")], "term_key string, concept_id string")
    return spark.createDataFrame(quads, QUAD_SCHEMA), taxonomy, spark.createDataFrame(payloads, PAYLOAD_SCHEMA)


def _stored_docs(spark, corpus):
    schema = DOCUMENT_SCHEMA
    return {(r.day, r.url, r.text) for r in read_days(spark, corpus, schema).collect()}


def test_lookback_then_rerun_then_backfill(spark, tmp_path):
    quads, taxonomy, payloads = _corpus_inputs(spark, tmp_path)
    corpus = Corpus(str(tmp_path / "corpus"))
    params = MineParams(today=TODAY, lookback=3, lang="eng", keywords=["fish"])
    mined = run_lookback(quads, taxonomy, payloads, params, corpus, "run-1")
    assert {(r.url, r.error) for r in mined.errors.collect()} == set()
    first = _stored_docs(spark, corpus)
    assert {(d, u) for d, u, _ in first} == {("2024-01-05", "w3"), ("2024-01-05", "w9"), *[("2024-01-06", f"w{i}") for i in (4, 5, 10, 11)]}
    status = {r.day: r.status for r in current_manifest(spark, corpus).collect()}
    assert status == {"2024-01-04": "empty", "2024-01-05": "rows", "2024-01-06": "rows"}

    # Running again extracts nothing anew and leaves the same documents.
    extracted = spark.read.parquet(corpus.extracted).count()
    run_lookback(quads, taxonomy, payloads, params, corpus, "run-2")
    assert _stored_docs(spark, corpus) == first
    assert spark.read.parquet(corpus.extracted).count() == extracted

    # Backfill: days 1 to 3 are missing, day 4 is known to be empty.
    plan = run_backfill(quads, taxonomy, payloads, params, BackfillParams("2024-01-01", dry_run=True), corpus, "x")
    assert [tuple(r) for r in plan.collect()] == [(f"2024-01-0{d}", "missing") for d in (1, 2, 3)]
    log = run_backfill(quads, taxonomy, payloads, params, BackfillParams("2023-12-31", retry_empty=True), corpus, "run-3")
    summary = run_summary(log).first()
    assert (summary.attempted, summary.with_rows, summary.empty_dates) == (5, 3, ["2023-12-31", "2024-01-04"])
    everything = _stored_docs(spark, corpus)
    assert {u for _, u, _ in everything} == {f"w{i}" for i in range(12)} - {"w7"}
    assert {r.error for r in spark.read.parquet(corpus.extracted).filter("error IS NOT NULL").collect()} == {"no payload"}
    again = run_backfill(quads, taxonomy, payloads, params, BackfillParams("2024-01-01", dry_run=True), corpus, "x")
    assert again.count() == 0

    # The written files carry the keyword column and can be queried as they are.
    assert "match_fish" in read_documents(spark, corpus.files).columns
    assert sql_over_days(spark, corpus, "SELECT count(*) AS n FROM documents WHERE match_fish").first().n == 5
    assert scope_of("ENG") == "eng" and os.path.isdir(f"{corpus.files}/year=2024/day=2024-01-05/scope=eng")


@pytest.mark.parametrize("width", [1, 4, 30])
def test_window_width_does_not_change_the_documents(spark, tmp_path, width):
    quads, taxonomy, payloads = _corpus_inputs(spark, tmp_path)
    params = MineParams(today=TODAY, days=10, window_days=width)
    docs = mine(quads, taxonomy, payloads, params, Corpus(str(tmp_path / "c")), "r").documents
    assert sorted(r.url for r in docs.collect()) == sorted(f"w{i}" for i in range(12) if i != 7)


def test_ranges_are_written_by_window(spark, tmp_path):
    quads, taxonomy, payloads = _corpus_inputs(spark, tmp_path)
    corpus = Corpus(str(tmp_path / "c"))
    params = MineParams(today=TODAY, days=6, window_days=4, unique_on="celex", keywords=["fish"], only_matches=True)
    run_lookback(quads, taxonomy, payloads, params, corpus, "r")
    rows = {(r.window_start, r.window_end, r.url, r.celex) for r in read_ranges(spark, corpus).collect()}
    # Last of each CELEX per window by (date, url, lang): w8 and w11, w10 and w9 in the newer
    # window, w0, w1 and w6 in the older one; of these the odd ones mention fish.
    assert rows == {("2024-01-03", "2024-01-06", "w11", "C3"), ("2024-01-03", "2024-01-06", "w5", "C1"), ("2024-01-01", "2024-01-02", "w1", "C1")}


def test_groups_of_windows_are_discovered_in_one_pass(spark, tmp_path, monkeypatch):
    quads, taxonomy, payloads = _corpus_inputs(spark, tmp_path)
    spans, gather = [], plans.metadata_by_window

    def counted(quads, today, total_days, *rest):
        spans.append(total_days)
        return gather(quads, today, total_days, *rest)

    def only_narrow(quads, today, total_days, *rest):
        if total_days > 4:
            raise RuntimeError("too wide")
        return counted(quads, today, total_days, *rest)

    def ranges(name, **changes):
        corpus = Corpus(str(tmp_path / name))
        # The oldest of the three windows is short.
        run_lookback(quads, taxonomy, payloads, MineParams(today=TODAY, days=10, window_days=4, unique_on="celex", **changes), corpus, "r")
        entries = {(r.window_start, r.window_end, r.status, r.n_rows) for r in range_entries(spark, corpus).collect()}
        return entries, {(r.window_start, r.window_end, r.url, r.text) for r in read_ranges(spark, corpus).collect()}

    whole = ranges("whole")
    assert len(whole[0]) == 3 and len(whole[1]) > 4
    monkeypatch.setattr(plans, "metadata_by_window", counted)
    assert ranges("grouped", group_windows=1) == whole and spans == [10]
    # What fails for all windows together is tried for each group by itself.
    monkeypatch.setattr(plans, "metadata_by_window", only_narrow)
    assert ranges("alone", group_windows=1) == whole and spans == [10, 4, 4, 2]


def test_merging_twice_changes_nothing_and_newer_rows_win(spark, tmp_path):
    corpus = Corpus(str(tmp_path))
    merge_days(_docs(spark, ("u1", "d", "eng", "old", "2024-01-01"), ("u2", "d", "eng", "kept", "2024-01-01")), corpus, "1")
    new = _docs(spark, ("u1", "d", "eng", "new", "2024-01-01"), ("u3", "d", "eng", "x", "2024-01-02"))
    for run in ("2", "3"):
        merge_days(new, corpus, run)
        got = {(r.url, r.text, r.day) for r in read_days(spark, corpus, new.schema).collect()}
        assert got == {("u1", "new", "2024-01-01"), ("u2", "kept", "2024-01-01"), ("u3", "x", "2024-01-02")}



def test_parameters():
    assert MineParams(today=TODAY, days=3).total_days == 3
    assert MineParams(today=TODAY, days=3, lookback=0).total_days == 0
    assert MineParams(today=TODAY, lang="fra").lang_filter == "FRA"
    with pytest.raises(ValueError):
        MineParams(today=TODAY, keywords=["a b", "a-b"])


def test_ranges_are_read_without_a_shuffle_of_their_documents(spark, plan_of, tmp_path):
    """A window's documents are not brought into one task to be compared with the few entries."""
    corpus = Corpus(str(tmp_path))
    rows = [(f"u{i}", "2024-01-03", "x" * 50, "2024-01-01", "2024-01-07") for i in range(200)]
    docs = spark.createDataFrame(rows, "url string, date string, text string, window_start string, window_end string")
    windows = spark.createDataFrame([(f"2024-{m:02}-01", f"2024-{m:02}-07") for m in range(1, 13)], "start string, end string")
    for run in ("run-1", "run-2"):
        write_ranges(docs, corpus, run, windows)
    read = read_ranges(spark, corpus)
    plan = plan_of(read)
    assert "Exchange hashpartitioning" not in plan and "hashpartitioning(" not in plan
    assert read.count() == 200
