"""Rows counted as they are written, and the clean-up of what readers no longer see."""

import os

import pytest
from pyspark.sql import functions as F

import docquarry.sinks.daily as daily
from docquarry.sinks.daily import Corpus, current_manifest, planned_days, read_days, read_manifest, read_ranges, superseded, write_days, write_ranges
from docquarry.sinks.upkeep import compact_manifest, drop_superseded, droppable

DAYS = [f"2024-01-0{d}" for d in range(1, 6)]


def _docs(spark, version, days=DAYS, n=4):
    return spark.createDataFrame([(f"{d}-{i}", d, version) for d in days for i in range(n)], "url string, day string, text string")


def _files(path):
    return sorted(os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def _three_runs(spark, corpus):
    planned = planned_days(_docs(spark, "").select("day").distinct())
    write_days(_docs(spark, "a"), planned, corpus, "1")
    write_days(_docs(spark, "b", DAYS[:3], 7), planned, corpus, "2")
    write_days(_docs(spark, "c", DAYS[:1], 2), planned.filter(F.col("day") == DAYS[0]), corpus, "3")


def test_a_write_counts_its_rows_without_listing_the_corpus(spark, tmp_path, monkeypatch):
    corpus = Corpus(str(tmp_path / "c"))
    listed = []
    real = daily.read_or_empty
    monkeypatch.setattr(daily, "read_or_empty", lambda s, path, schema: (listed.append(path), real(s, path, schema))[1])
    docs = _docs(spark, "a").unionByName(_docs(spark, "b", DAYS[:1], 3000))
    planned = planned_days(_docs(spark, "", [*DAYS, "2024-02-01"]).select("day").distinct())
    entries = {r.day: (r.status, r.n_rows) for r in write_days(docs, planned, corpus, "1").collect()}
    assert entries == {DAYS[0]: ("rows", 3004), **{d: ("rows", 4) for d in DAYS[1:]}, "2024-02-01": ("empty", 0)}
    ranges = docs.withColumns({"window_start": F.lit(DAYS[0]), "window_end": F.lit(DAYS[4]), "date": F.col("day")}).drop("day")
    assert [(r.window_start, r.window_end, r.n_rows) for r in write_ranges(ranges, corpus, "1").collect()] == [(DAYS[0], DAYS[4], 3020)]
    assert corpus.files not in listed and corpus.ranges not in listed


def test_more_partitions_than_the_sketch_holds_are_counted_from_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(daily, "COUNTED", 3)
    corpus = Corpus(str(tmp_path / "c"))
    entries = write_days(_docs(spark, "a"), planned_days(_docs(spark, "").select("day").distinct()), corpus, "1")
    assert {r.day: r.n_rows for r in entries.collect()} == dict.fromkeys(DAYS, 4)


def test_clean_up_changes_nothing_for_readers(spark, tmp_path):
    corpus = Corpus(str(tmp_path / "c"))
    _three_runs(spark, corpus)
    rows = sorted(map(tuple, read_days(spark, corpus).collect()))
    before = len(_files(corpus.files))
    # The days of the last two attempts are left to readers that began earlier.
    assert droppable(spark, corpus, keep=2).count() == 0 and droppable(spark, corpus, keep=1).count() < droppable(spark, corpus).count()
    gone = drop_superseded(spark, corpus, str(tmp_path / "work"))
    # Run 2 planned all days, so all of run 1 is superseded, and of run 2 the first day.
    assert sorted((r.day, r["_run"].split("~")[0]) for r in gone.collect()) == sorted([*[(d, "1") for d in DAYS], (DAYS[0], "2")])
    assert superseded(spark, corpus).count() == 0 and len(_files(corpus.files)) == before - 6
    assert sorted(map(tuple, read_days(spark, corpus).collect())) == rows and len(rows) == 2 + 7 + 7
    # Nothing is left for a second clean-up, and a corpus without any day has nothing to drop.
    assert drop_superseded(spark, corpus, str(tmp_path / "work2")).count() == 0
    assert drop_superseded(spark, Corpus(str(tmp_path / "none")), str(tmp_path / "work3")).count() == 0


@pytest.mark.parametrize("interrupted", [False, True])
def test_a_compacted_manifest_says_the_same(spark, tmp_path, interrupted, monkeypatch):
    corpus = Corpus(str(tmp_path / "c"))
    _three_runs(spark, corpus)
    for run, n in (("1", 3), ("2", 2)):
        docs = _docs(spark, run, DAYS[:n]).withColumns({"window_start": F.lit(DAYS[0]), "window_end": F.lit(DAYS[n]), "date": F.col("day")}).drop("day")
        write_ranges(docs, corpus, run)

    def seen():
        frames = (read_manifest(spark, corpus), current_manifest(spark, corpus, with_errors=True), read_days(spark, corpus), read_ranges(spark, corpus))
        return [sorted(map(repr, f.collect())) for f in frames]

    before = seen()
    if interrupted:
        monkeypatch.setattr("docquarry.sinks.upkeep._delete", lambda *a: False)
    old = _files(corpus.manifest) + _files(corpus.range_manifest)
    n_before, n_after = compact_manifest(spark, corpus)
    assert (n_before, n_after) == (len(old), 2)
    assert len(_files(corpus.manifest) + _files(corpus.range_manifest)) == (len(old) + 2 if interrupted else 2)
    assert seen() == before
    # Attempts go on counting, and a replayed run still counts by its last attempt.
    write_days(_docs(spark, "d", DAYS[:1], 1), planned_days(_docs(spark, "", DAYS[:1]).select("day").distinct()), corpus, "1")
    assert current_manifest(spark, corpus).agg(F.max("seq")).first()[0] == 4
    assert [r.text for r in read_days(spark, corpus).filter(F.col("day") == DAYS[0]).collect()] == ["d"]
