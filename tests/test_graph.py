"""Assembly against the full join of all properties, on messy random quads."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from docquarry.operators import graph
from docquarry.schemas import QUAD_SCHEMA
from docquarry.settings import NARROW_PARTITION
from docquarry.sources.quads import attach_quads_by_subject, heaviest_bucket, read_quads, write_quads, write_quads_by_subject
from docquarry.sources.tables import stored
from queries.graph_queries import _ASSEMBLED_SQL
from tests.compare import _rows, difference, spark_rows

V = graph.VOCABULARY


def random_quads(seed, n_works=12):
    rng = random.Random(seed)
    quads = set()

    def add(g, s, p, o, lang=None):
        quads.add((g, s, p, o, lang))

    graphs = ["g1", "g2", "g3"]
    some = lambda values, k: rng.sample(values, rng.randint(0, k))
    dates = ["2024-01-01", "2024-01-02", "2024-01-03", "2023-12-31"]
    for node in [f"{kind}{i}" for kind in ("rt", "dc", "sub", "ag") for i in range(4)]:
        for g in some(graphs, 3):
            for lang in some(["en", "fr", "en-GB"], 3):
                add(g, node, V.label, f"{node} in {g} {lang}"[: rng.choice([5, 30])], lang)
    for i in range(3):
        add("gl", f"lang{i}", V.identifier, ["ENG", "FRA", "DEU"][i])
    for w in range(n_works):
        work = f"w{w}"
        for g in rng.sample(graphs, rng.randint(1, 2)):
            for predicate, values, k in (
                (V.type, ["t1", "t2"], 2),
                (V.work_id, ["id1", "id2"], 2),
                (V.date, dates, 2),
                (V.celex_1, [f"a{w}", "a"], 1),
                (V.celex_2, [f"b{w}", "b"], 2),
                (V.celex_3, [f"c{w}"], 1),
                (V.eli, ["e1", "e2"], 2),
                (V.procedure, ["p1", "p2"], 2),
                (V.resource_type, [f"rt{i}" for i in range(4)], 3),
                (V.directory_code, [f"dc{i}" for i in range(4)], 3),
                (V.subject, [f"sub{i}" for i in range(4)], 4),
            ):
                for value in some(values, k):
                    add(g, work, predicate, value)
        for predicate in V.agents:
            for agent in some([f"ag{i}" for i in range(4)], 2):
                add(rng.choice(graphs), work, predicate, agent)
    for e in range(n_works * 2):
        exp = f"e{e}"
        for g in rng.sample(graphs, rng.randint(1, 2)):
            for predicate, values in (
                (V.expression_work, [f"w{i}" for i in range(n_works)]),
                (V.title, [f"t{e}", f"u{e}"]),
                (V.language, ["lang0", "lang1", "lang2"]),
            ):
                for value in rng.sample(values, rng.randint(0 if g == "g3" else 1, 2)):
                    add(g, exp, predicate, value)
        for m in range(rng.randint(0, 2)):
            for g in rng.sample(graphs, 2):
                add(g, f"m{e}-{m}", V.manifestation_expression, exp)
                for value in some(["pdf", "html", "docx"], 2):
                    add(g, f"m{e}-{m}", V.manifestation_type, value)
    return sorted(quads, key=str)


def expected(rows, where=""):
    con = duckdb.connect()
    con.execute("CREATE TABLE quads (g VARCHAR, s VARCHAR, p VARCHAR, o VARCHAR, o_lang VARCHAR)")
    con.executemany("INSERT INTO quads VALUES (?, ?, ?, ?, ?)", rows)
    result = con.execute(_ASSEMBLED_SQL.format(start="2024-01-01", end="2024-01-03", where=where))
    return _rows([d[0] for d in result.description], result.fetchall())


def test_assembly_equals_the_full_join(spark):
    total = 0
    for seed in range(4):
        rows = random_quads(seed)
        quads = spark.createDataFrame(rows, QUAD_SCHEMA)
        got = spark_rows(graph.as_bindings(graph.assemble_metadata(quads, "2024-01-01", "2024-01-03")))
        assert difference(got, expected(rows)) == "", f"seed {seed}"
        total += sum(got[1].values())
    assert total > 20


def test_assembly_is_the_same_without_broadcasts(spark, plan_of):
    """What a large window runs: every join shuffles, and none turns into a nested loop."""
    rows = random_quads(5)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        quads = spark.createDataFrame(rows, QUAD_SCHEMA)
        assembled = graph.as_bindings(graph.assemble_metadata(quads, "2024-01-01", "2024-01-03"))
        plan = plan_of(assembled)
        assert "Broadcast" not in plan and "Cartesian" not in plan
        assert difference(spark_rows(assembled), expected(rows)) == ""
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_language_filter_equals_the_filtered_full_join(spark):
    rows = random_quads(7)
    quads = spark.createDataFrame(rows, QUAD_SCHEMA)
    got = spark_rows(graph.as_bindings(graph.assemble_metadata(quads, "2024-01-01", "2024-01-03", lang="ENG")))
    assert difference(got, expected(rows, "WHERE lang_id = 'ENG'")) == ""


def test_stored_quads_prune_partitions_and_never_cross_join(spark, plan_of, tmp_path):
    quads = spark.createDataFrame(random_quads(1), QUAD_SCHEMA)
    write_quads(quads, str(tmp_path / "quads"))
    stored = read_quads(spark, str(tmp_path / "quads"))
    assert stored.count() == quads.count()
    plan = plan_of(graph.assemble_metadata(stored, "2024-01-01", "2024-01-03"))
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "PushedFilters: [IsNotNull(o), GreaterThanOrEqual(o,2024-01-01), LessThan(o,2024-01-03)" in plan
    scans = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert scans and all("(p#" in line or "p#" in line for line in scans)


def test_works_limit_and_offset(spark):
    quads = spark.createDataFrame(
        [("g", f"w{i}", p, o, None) for i in range(5) for p, o in ((V.type, "t"), (V.work_id, "i"), (V.date, "2024-01-01"))], QUAD_SCHEMA
    )
    works = graph.window_works(quads, "2024-01-01", "2024-01-02", limit=2, offset=1)
    assert sorted(r.work for r in works.collect()) == ["w1", "w2"]


def test_a_work_is_mined_in_every_window_it_has_a_date_in(spark):
    import datetime

    base = [("g", "w", V.type, "t"), ("g", "w", V.work_id, "i"), ("g", "w", V.subject, "s"), ("g", "w", V.date, "2024-01-01"),
            ("g", "w", V.date, "2024-01-03"), ("g", "w", V.date, "2030-01-01"), ("e", "x", V.expression_work, "w"),
            ("e", "x", V.title, "T"), ("e", "x", V.language, "l"), ("l", "l", V.identifier, "ENG"),
            ("m", "m", V.manifestation_expression, "x"), ("m", "m", V.manifestation_type, "pdf")]
    quads = spark.createDataFrame([(*q, None) for q in base] + [("gs", "s", V.label, "S", "en")], QUAD_SCHEMA)
    rows = graph.metadata_by_window(quads, datetime.date(2024, 1, 3), 3).select("window_start", "date").collect()
    all_dates = {"2024-01-01", "2024-01-03", "2030-01-01"}
    assert {tuple(r) for r in rows} == {(w, d) for w in ("2024-01-01", "2024-01-03") for d in all_dates}


def test_full_names_of_predicates():
    full = V.with_prefixes(cdm="c#", skos="s#", dc="d#", rdf="r#")
    assert (full.date, full.label, full.identifier, full.type) == ("c#work_date_document", "s#prefLabel", "d#identifier", "r#type")


def test_repeated_quads_of_one_work_change_nothing(spark):
    """A third of all quads are copies of one work's: the sets absorb them before the shuffle."""
    rows = random_quads(3)
    quads = spark.createDataFrame(rows, QUAD_SCHEMA)
    copies = quads.filter(F.col("s") == "w1").crossJoin(spark.range(500).select()).select(*quads.columns)
    plain = spark_rows(graph.as_bindings(graph.assemble_metadata(quads, "2024-01-01", "2024-01-03")))
    skewed = spark_rows(graph.as_bindings(graph.assemble_metadata(quads.unionByName(copies), "2024-01-01", "2024-01-03")))
    assert difference(skewed, plain) == ""


@pytest.mark.parametrize("broadcast", [True, False])
def test_subject_buckets_give_the_same_with_fewer_shuffles(spark, plan_of, tmp_path, broadcast):
    rows = [r for seed in (2, 8) for r in random_quads(seed, 30)]
    rows = list(dict.fromkeys(rows))
    quads = spark.createDataFrame(rows, QUAD_SCHEMA)
    name = f"subject_quads_{broadcast}".lower()
    write_quads_by_subject(quads, name, str(tmp_path / "by_subject"), 4)
    write_quads(quads, str(tmp_path / "by_predicate"))
    attached = attach_quads_by_subject(spark, f"{name}_again", str(tmp_path / "by_subject"), 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if not broadcast:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        shuffles = {}
        for lang, where in ((None, ""), ("FRA", "WHERE lang_id = 'FRA'")):
            for layout, source in (("subject", spark.table(name)), ("attached", attached), ("predicate", read_quads(spark, str(tmp_path / "by_predicate")))):
                works = stored(graph.dated_works(source, "2024-01-01", "2024-01-03"), str(tmp_path / f"{layout}-{lang}-works"))
                if lang:
                    works = stored(graph.works_in_language(source, works, lang), str(tmp_path / f"{layout}-spoken"))
                made = graph.as_bindings(graph.assemble_metadata(source, "2024-01-01", "2024-01-03", lang, works=works))
                assert difference(spark_rows(made), expected(rows, where)) == "", (layout, lang)
                shuffles[layout, lang] = sum("hashpartitioning(" in line for line in plan_of(made).splitlines())
        for lang in (None, "FRA"):
            assert shuffles["subject", lang] == shuffles["attached", lang] < shuffles["predicate", lang] * (0.4 if broadcast else 0.8), shuffles
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"DROP TABLE {name}_again")


def test_works_without_the_language_are_left_out_early(spark):
    rows = random_quads(9, 20)
    quads = spark.createDataFrame(rows, QUAD_SCHEMA)
    works = graph.dated_works(quads, "2024-01-01", "2024-01-03")
    spoken = {r.work for r in graph.works_in_language(quads, works, "DEU").collect()}
    exps = {(g, s) for g, s, p, o, _ in rows if p == V.language and o == "lang2"}
    of = {o for g, s, p, o, _ in rows if p == V.expression_work and (g, s) in exps}
    assert spoken == of & {r.work for r in works.collect()} and graph.works_in_language(quads, works, "XXX").count() == 0


def test_a_subject_with_a_third_of_all_quads_gets_no_buckets(spark, tmp_path):
    rows = random_quads(2, 40)
    hot = rows + [("g1", "w1", V.subject, f"sub{i}", None) for i in range(len(rows) // 2)]
    quads = spark.createDataFrame(hot, QUAD_SCHEMA)
    assert heaviest_bucket(spark.createDataFrame(rows, QUAD_SCHEMA), 16) < 4 < heaviest_bucket(quads, 16)
    with pytest.raises(ValueError, match="by predicate"):
        write_quads_by_subject(quads, "hot_quads", str(tmp_path / "hot"), 16)
    assert heaviest_bucket(quads.limit(0), 16) == 0


@pytest.mark.parametrize(("setting", "kept"), [("64MB", False), (str(1 << 30), False), ("8m", True), ("4096k", True)])
def test_quads_are_dealt_in_partitions_that_sort_in_memory(spark, tmp_path, setting, kept):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, setting)
        write_quads(spark.createDataFrame(random_quads(1), QUAD_SCHEMA), str(tmp_path / "quads"))
        assert spark.conf.get(key) == (setting if kept else str(NARROW_PARTITION))
    finally:
        spark.conf.set(key, before)


def test_a_large_predicate_is_sorted_in_small_parts(spark, tmp_path):
    """Also where one task of the source holds all of it."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64MB")
        rows = spark.range(0, 1_000_000, 1, 1).select(F.lit("g").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit("p").alias("p"), F.lit("o").alias("o"), F.lit(None).cast("string").alias("o_lang"))
        write_quads(rows, str(tmp_path / "quads"))
        assert len(list((tmp_path / "quads" / "p=p").glob("*.parquet"))) >= 3
        assert read_quads(spark, str(tmp_path / "quads")).count() == 1_000_000
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("broadcast", [True, False])
def test_every_quad_is_shuffled_once_at_most_to_be_gathered(spark, plan_of, tmp_path, broadcast):
    """With works too many to be broadcast, and with labels and names as written tables; the rows are the same."""
    rows = random_quads(11, 25)
    write_quads(spark.createDataFrame(rows, QUAD_SCHEMA), str(tmp_path / "quads"))
    quads = read_quads(spark, str(tmp_path / "quads"))
    names = graph.stored_names(quads, str(tmp_path / "names"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        # Names have some kB and are broadcast; the works are estimated by the size of all quads.
        spark.conf.set(threshold, str(sum(f.stat().st_size for f in (tmp_path / "names").rglob("*.parquet")) if broadcast else -1))
        made = graph.as_bindings(graph.assemble_metadata(quads, "2024-01-01", "2024-01-03", names=names))
        shuffles = [line for line in plan_of(made).splitlines() if "hashpartitioning(" in line]
        assert difference(spark_rows(made), expected(rows)) == ""
        by_window = graph.metadata_by_window(quads, datetime.date(2024, 1, 2), 3, names=names).drop("window_start", "window_end")
        plain = graph.metadata_by_window(spark.createDataFrame(rows, QUAD_SCHEMA), datetime.date(2024, 1, 2), 3).drop("window_start", "window_end")
        assert difference(spark_rows(by_window), spark_rows(plain)) == ""
    finally:
        spark.conf.set(threshold, before)
    assert len(shuffles) <= (13 if broadcast else 19), shuffles


@pytest.mark.parametrize(("setting", "kept"), [("128MB", False), ("8m", True)])
def test_quads_are_scanned_in_splits_whose_sets_fit_in_memory(spark, tmp_path, setting, kept):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        write_quads(spark.createDataFrame(random_quads(1), QUAD_SCHEMA), str(tmp_path / "quads"))
        spark.conf.set(key, setting)
        read_quads(spark, str(tmp_path / "quads"))
        assert spark.conf.get(key) == (setting if kept else str(NARROW_PARTITION))
    finally:
        spark.conf.set(key, before)


def test_buckets_of_subjects_are_doubled_until_a_task_can_gather_one(spark, tmp_path):
    rows = random_quads(12, 60)
    quads = spark.createDataFrame(rows, QUAD_SCHEMA)
    few = write_quads_by_subject(quads, "few_buckets", str(tmp_path / "few"), 2)
    many = write_quads_by_subject(quads, "many_buckets", str(tmp_path / "many"), 2, rows=len(rows) // 7)
    try:
        assert (few, many) == (2, 8)
        got = [spark_rows(graph.as_bindings(graph.assemble_metadata(spark.table(t), "2024-01-01", "2024-01-03"))) for t in ("few_buckets", "many_buckets")]
        assert difference(got[0], expected(rows)) == "" == difference(got[1], got[0])
        # One subject has half of the quads: two buckets are uneven by at most two, four by more.
        hot = quads.unionByName(spark.range(len(rows)).select(F.lit("g1").alias("g"), F.lit("w1").alias("s"), F.lit(V.subject).alias("p"), F.col("id").cast("string").alias("o"), F.lit(None).cast("string").alias("o_lang")))
        assert write_quads_by_subject(hot, "hot_buckets", str(tmp_path / "hot"), 2, most=2.0, rows=10) == 2
    finally:
        for t in ("few_buckets", "many_buckets", "hot_buckets"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
